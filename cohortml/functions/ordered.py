"""Running totals, row numbers and mid-ranks that never put a whole group in one task.

A plain ``Window.partitionBy(key).orderBy(x)`` ships every row of a key to a
single task; a key holding a third of the data then runs on one core. Here
rows are range-partitioned on ``(keys, order)`` instead, so one key spreads
over many blocks. Each block computes local running sums with a window over
``(block, keys)``; the per-block totals (one row per key and block) get their
own small prefix sum, which is added back as an offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortml.session import ensure_checkpoint_dir

_BLK = "_blk"


def _as_cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence, sums: dict,
                   inclusive: bool = True, peers: bool = False, peer_totals: bool = False,
                   n_blocks: int | None = None) -> DataFrame:
    """Add ``name = running sum of expr`` within ``keys`` along ``order``.

    * ``peers=False``: ``order`` should be strict within the keys (add a unique
      tie-break column); ``inclusive=False`` leaves the current row out.
    * ``peers=True``: rows with equal ``order`` values are peers; every peer
      gets the total up to and including its whole peer group. Range
      partitioning on exactly ``keys + order`` keeps a peer group in one block.
      ``peer_totals=True`` also adds ``name_grp``, the sum within the peer group.
    """
    keys = list(keys)
    order_cols = _as_cols(order)
    tmp = {name: f"_v_{name}" for name in sums}
    base = df.select("*", *[(e if isinstance(e, Column) else F.col(e)).alias(tmp[n])
                           for n, e in sums.items()])
    # The range bounds come from a sample drawn per execution, so the block
    # assignment is materialised once (reliable checkpoint in the shared
    # checkpoint folder): both branches below, and any recomputation after an
    # executor loss, then see the same blocks.
    ensure_checkpoint_dir(df.sparkSession)
    # Without an explicit count, adaptive execution sizes the blocks by bytes
    # (coalescing merges neighbouring ranges, so block ids stay in order).
    ranged = (base.repartitionByRange(int(n_blocks), *_as_cols(keys), *order_cols) if n_blocks
              else base.repartitionByRange(*_as_cols(keys), *order_cols))
    blocks = (ranged
              .withColumn(_BLK, F.spark_partition_id())
              .checkpoint(eager=True))
    w = Window.partitionBy(_BLK, *keys).orderBy(*order_cols)
    if peers:
        w_local = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        w_local = w.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    extra = []
    if peers and peer_totals:
        order_names = [o if isinstance(o, str) else None for o in order]
        if any(o is None for o in order_names):
            raise ValueError("peer_totals needs column names in `order`")
        w_grp = Window.partitionBy(_BLK, *keys, *order_names)
        extra = [F.sum(tmp[n]).over(w_grp).alias(f"{n}_grp") for n in sums]
    local = blocks.select("*", *[F.coalesce(F.sum(tmp[n]).over(w_local), F.lit(0)).alias(f"_loc_{n}")
                                 for n in sums], *extra)
    totals = blocks.groupBy(*keys, _BLK).agg(*[F.sum(tmp[n]).alias(f"_tot_{n}") for n in sums])
    w_prev = Window.partitionBy(*keys).orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, _BLK, *[F.coalesce(F.sum(f"_tot_{n}").over(w_prev), F.lit(0))
                                           .alias(f"_off_{n}") for n in sums])
    out = local.join(offsets, on=keys + [_BLK], how="inner")
    out = out.select("*", *[(F.col(f"_loc_{n}") + F.col(f"_off_{n}")).alias(n) for n in sums])
    drop = [_BLK] + [f"_loc_{n}" for n in sums] + [f"_off_{n}" for n in sums] + list(tmp.values())
    return out.drop(*drop)


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence, name: str = "rn",
                n_blocks: int | None = None) -> DataFrame:
    """1-based position within ``keys`` along a strict ``order`` (bigint)."""
    out = running_totals(df, keys, order, {name: F.lit(1).cast("bigint")}, n_blocks=n_blocks)
    return out.withColumn(name, F.col(name).cast("bigint"))


def mid_ranks(counts: DataFrame, keys: Sequence[str], value: str, count: str = "cnt",
              name: str = "rank", n_blocks: int | None = None) -> DataFrame:
    """Mid-rank of each value, given rows ``(keys, value, count, ...)``.

    Several rows may share a value (for example one per class); all of them
    get the mean of the positions the tied rows occupy:
    ``rank = count_le - (ties - 1) / 2``. Also returns ``ties``.
    """
    out = running_totals(counts, keys, [value], {"_cum": F.col(count).cast("double")},
                         peers=True, peer_totals=True, n_blocks=n_blocks)
    return (out.withColumn(name, F.col("_cum") - (F.col("_cum_grp") - F.lit(1)) / F.lit(2.0))
            .withColumnRenamed("_cum_grp", "ties").drop("_cum"))
