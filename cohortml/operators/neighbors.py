"""Exact k-nearest-neighbour join without forming all pairs, and the resamplers built on it.

Vectors are ``array<double>`` columns. The reference side is split into
Voronoi cells around ``P`` pivots (reference rows drawn in hash order; ``P``
is bounded, and so is what is broadcast: ``P x d`` pivot coordinates plus
``P x P`` pivot distances). Once a cell has more than ``ROWS_PER_LEAF`` rows, cells are split again
around pivots of their own (up to ``P`` each, a table that travels with the cell's rows and
queries in chunks), so that the parts stay small while the rows grow. A query is paired only with the parts that can
hold one of its ``k`` nearest neighbours:

* an upper bound ``r_q`` of the k-th neighbour distance is the k-th
  smallest distance to the pivots, then to the pivots of the query's own cell (pivots are reference rows; one more when
  the query itself may be a pivot);
* a part ``c`` is skipped when a lower bound of the distance from ``q`` to
  any of its rows exceeds ``r_q``: ``d(q, p_c) - radius_c`` (triangle
  inequality) or the distance to the bisecting hyperplane between the pivot closest to ``q``
  and ``p_c`` (every row of ``c`` lies beyond it).

Pairs are scored with NumPy in groups of at most ``QUERY_CHUNK`` queries and about ``ROW_CHUNK`` rows, portions
of bounded size at a time; the top ``k`` is
kept first per group and then per query. Ties go to the smaller
reference key. The result is exact, whatever the number of levels.

Where the bounds rule out little (many dimensions), a query would be sent to most cells. Then both sides are
dealt into blocks of ``ROW_CHUNK`` to ``4 * ROW_CHUNK`` rows instead, and a group is a pair of blocks: a query goes
once to every block of rows, not once to every cell.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Tp
from pyspark.sql.pandas.types import to_arrow_schema

from cohortml.functions.arrays import list_matrix
from cohortml.functions.hashing import hash_int, hash_uniform

MAX_PIVOTS = 1024
ROWS_PER_CELL = 64
#: Rows of a cell over which cells are split again, and the rows aimed at per part then.
ROWS_PER_LEAF = 2048
ROWS_PER_PART = 256
#: Rows of a cell that meet its pivots, or queries of a part, in one group.
ROW_CHUNK = 4096


def sq_dist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two equal-length arrays (JVM-side)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def choose_pivots(ref: DataFrame, key: str, vec: str, n_pivots: int | None = None, seed=7) -> np.ndarray:
    n = ref.count()
    p = n_pivots or max(1, min(MAX_PIVOTS, math.ceil(n / ROWS_PER_CELL)))
    rows = ref.orderBy(hash_int(seed, key), F.col(key)).limit(int(p)).select(vec).collect()
    return np.array([r[0] for r in rows], dtype=float)


def _pivot_distances(x: np.ndarray, pivots: np.ndarray, values: int = 1 << 22) -> np.ndarray:
    """Rows x pivots Euclidean distances, row portions at a time: rows x pivots x dimensions never
    exist at once beyond about ``values`` numbers. Differences, not dot products: the bounds that
    are built on these must not lose digits."""
    step = max(1, values // max(1, pivots.size))
    return np.concatenate([np.sqrt(((x[i:i + step, None, :] - pivots[None, :, :]) ** 2).sum(-1))
                           for i in range(0, len(x), step)]) if len(x) else np.zeros((0, len(pivots)))


def _assign_cells(ref: DataFrame, vec: str, pivots_b) -> DataFrame:
    """Nearest pivot (cell) and the distance to it, per reference row."""
    out_schema = Tp.StructType(ref.schema.fields + [Tp.StructField("cell", Tp.IntegerType()),
                                                    Tp.StructField("dpiv", Tp.DoubleType())])

    def fn(batches):
        piv = pivots_b.value
        for pdf in _slices(batches, len(piv)):
            d = _pivot_distances(_vectors(pdf[vec]), piv)
            cell = d.argmin(axis=1)
            yield pdf.assign(cell=cell.astype("int32"), dpiv=d[np.arange(len(d)), cell])
    return ref.mapInPandas(fn, out_schema)


def _slices(batches, width: int):
    """The batches in slices whose rows times ``width`` stay under a quarter of ``PORTION``."""
    step = max(1, PORTION // 4 // max(1, width))
    for pdf in batches:
        for i in range(0, len(pdf), step):
            yield pdf.iloc[i:i + step]


def _kth(d: np.ndarray, k: int) -> np.ndarray:
    """The k-th smallest value of every row, infinite where there are fewer."""
    return np.partition(d, k - 1, axis=1)[:, k - 1] if k <= d.shape[1] else np.full(len(d), np.inf)


def _reachable(dq: np.ndarray, between: np.ndarray, radius: np.ndarray, rq: np.ndarray) -> np.ndarray:
    """Which parts (columns: distances to their pivots) may hold a row within ``rq`` of a query."""
    i = np.arange(len(dq))
    own = dq.argmin(axis=1)
    sep = between[own]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.where(sep > 0, (dq ** 2 - dq[i, own][:, None] ** 2) / (2.0 * sep), 0.0)
    low = np.maximum(np.maximum(plane, dq - radius[None, :]), 0.0)
    slack = rq * 1e-9 + 1e-12  # bounds are only used to skip; err on keeping parts
    return (low <= (rq + slack)[:, None]) & (radius > -np.inf)[None, :]


def _vectors(column) -> np.ndarray:
    return np.array(column.tolist(), dtype=float).reshape(len(column), -1)


def _own_cell(query: DataFrame, vec: str, pivots_b, radii_b, k_bound: int) -> DataFrame:
    """``cell``: the cell of the closest pivot; ``_rq``: the k-th smallest distance to a pivot; ``_reach``: the number
    of cells within it."""
    schema = Tp.StructType(query.schema.fields + [Tp.StructField("cell", Tp.IntegerType()), Tp.StructField("_rq", Tp.DoubleType()),
                                                  Tp.StructField("_reach", Tp.IntegerType())])

    def fn(batches):
        piv = pivots_b.value
        between = _pivot_distances(piv, piv)
        for pdf in _slices(batches, len(piv)):
            dq = _pivot_distances(_vectors(pdf[vec]), piv)
            rq = _kth(dq, k_bound)
            reach = _reachable(dq, between, radii_b.value, rq).sum(axis=1)
            yield pdf.assign(cell=dq.argmin(axis=1).astype("int32"), _rq=rq, _reach=reach.astype("int32"))
    return query.mapInPandas(fn, schema)


def _lists(keep: np.ndarray, numbers: np.ndarray) -> list:
    """``numbers`` of the columns that a row keeps, per row."""
    rows, at = np.nonzero(keep)
    return np.split(numbers[at], np.searchsorted(rows, np.arange(1, len(keep))))


def _candidate_cells(query: DataFrame, vec: str, pivots_b, radii_b) -> DataFrame:
    """Each query (with its ``_rq``) once per cell that may hold one of its neighbours.

    A task gives a row's cells as one list; the copies are made where they are streamed."""
    schema = Tp.StructType(query.schema.fields + [Tp.StructField("_cells", Tp.ArrayType(Tp.IntegerType()))])

    def fn(batches):
        piv = pivots_b.value
        between = _pivot_distances(piv, piv)
        numbers = np.arange(len(piv), dtype="int32")
        for pdf in _slices(batches, len(piv)):
            keep = _reachable(_pivot_distances(_vectors(pdf[vec]), piv), between, radii_b.value, pdf["_rq"].to_numpy())
            yield pdf.assign(_cells=_lists(keep, numbers))
    return query.mapInPandas(fn, schema).withColumn("cell", F.explode("_cells")).drop("_cells")


# ------------------------------------------------------------ the second level
def _by_chunk(rows: DataFrame, key: str, pivots: DataFrame):
    """Rows of a cell in chunks of about ``ROW_CHUNK``, cogrouped with a copy of the cell's pivots each."""
    sizes = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(ROW_CHUNK))).cast("int").alias("_chunks"))
    sizes = F.broadcast(sizes)  # one row per cell: at most MAX_PIVOTS
    dealt = rows.join(sizes, "cell").withColumn("_chunk", F.pmod(hash_int("chunk", key), F.col("_chunks").cast("long"))).drop("_chunks")
    copies = pivots.join(sizes, "cell").withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks").cast("long") - 1))).drop("_chunks")
    return dealt.groupBy("cell", "_chunk").cogroup(copies.groupBy("cell", "_chunk"))


def _split_cells(cells: DataFrame, pivots: np.ndarray, sizes: dict):
    """``(rows with their part ``sub``, pivots (cell, sub, _pv, radius))``; parts are numbered within the cell."""
    spark = cells.sparkSession
    share = spark.createDataFrame([(int(c), min(MAX_PIVOTS, math.ceil(n / ROWS_PER_PART)) / n) for c, n in sizes.items()],
                                  "cell int, share double")
    first = spark.createDataFrame([(int(c), [float(v) for v in pivots[c]], None) for c in sizes], "cell int, _pv array<double>, _k string")
    # the cell's own pivot is one; rows equal to it are not drawn again, so no reference row is counted twice
    drawn = (cells.where("dpiv > 0").join(F.broadcast(share), "cell").where(hash_uniform("sub", "nn_key") < F.col("share"))
             .select("cell", F.col("_rx").cast("array<double>").alias("_pv"), F.col("nn_key").cast("string").alias("_k")))
    table = first.unionByName(drawn).withColumn(
        "sub", F.row_number().over(Window.partitionBy("cell").orderBy("_k"))).drop("_k").checkpoint(eager=True)
    schema = Tp.StructType([f for f in cells.schema.fields if f.name != "dpiv"]
                           + [Tp.StructField("sub", Tp.IntegerType()), Tp.StructField("dsub", Tp.DoubleType())])

    def assign(rows: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({f.name: [] for f in schema.fields})
        d = _pivot_distances(_vectors(rows["_rx"]), _vectors(near["_pv"]))
        at = d.argmin(axis=1)
        return rows.assign(sub=near["sub"].to_numpy()[at].astype("int32"), dsub=d[np.arange(len(d)), at])[[f.name for f in schema.fields]]

    parts = _by_chunk(cells, "nn_key", table).applyInPandas(assign, schema).checkpoint(eager=True)
    radius = parts.groupBy("cell", "sub").agg(F.max("dsub").alias("radius"))
    return parts, table.join(radius, ["cell", "sub"], "left").checkpoint(eager=True)


def _tighten(query: DataFrame, key: str, vec: str, table: DataFrame, k_bound: int) -> DataFrame:
    """``_rq`` no larger than the k-th smallest distance to a pivot of the query's own cell."""
    schema = Tp.StructType([f for f in query.schema.fields if f.name != "cell"])

    def fn(q: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if len(q) and len(near):
            q = q.assign(_rq=np.minimum(q["_rq"].to_numpy(), _kth(_pivot_distances(_vectors(q[vec]), _vectors(near["_pv"])), k_bound)))
        return q[[f.name for f in schema.fields]]

    return _by_chunk(query, key, table.select("cell", "_pv")).applyInPandas(fn, schema)


def _candidate_parts(cand: DataFrame, key: str, vec: str, table: DataFrame) -> DataFrame:
    """Each (query, cell) once per part of the cell that may hold a neighbour."""
    schema = Tp.StructType([cand.schema[key], cand.schema[vec], cand.schema["cell"], Tp.StructField("_subs", Tp.ArrayType(Tp.IntegerType()))])
    names = [f.name for f in schema.fields]

    def fn(q: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(near):
            return pd.DataFrame({n: [] for n in names})
        piv = _vectors(near["_pv"])
        radius = near["radius"].to_numpy(dtype=float, na_value=-np.inf)  # a part without rows is never a candidate
        radius = np.where(np.isnan(radius), -np.inf, radius)
        between = _pivot_distances(piv, piv)
        numbers = near["sub"].to_numpy().astype("int32")
        found = []
        for part in _slices([q], len(piv)):
            found += _lists(_reachable(_pivot_distances(_vectors(part[vec]), piv), between, radius, part["_rq"].to_numpy()), numbers)
        return q.assign(_subs=found)[names]

    return _by_chunk(cand, key, table).applyInPandas(fn, schema).withColumn("sub", F.explode("_subs")).drop("_subs")


# ------------------------------------------------------------ scoring
QUERY_CHUNK = 256
#: Numbers that a portion of pairwise differences holds.
PORTION = 1 << 22


def _topk(k: int, key: str, vec: str, ref_cols: list[str], exclude_self: bool):
    """Per (part, query chunk, row chunk): exact distances and the k nearest rows of every query."""
    def fn(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        cols = [key, "nn_key", "_d2", *ref_cols]
        if not len(q) or not len(r):
            return pd.DataFrame({c: [] for c in cols})
        xq, xr = _vectors(q[vec]), _vectors(r["_rx"])
        qk, rk = q[key].to_numpy(), r["nn_key"].to_numpy()
        place = np.argsort(np.argsort(rk, kind="stable"), kind="stable")  # ties go to the smaller key
        step = max(1, PORTION // max(1, xr.size))
        found = []
        for i in range(0, len(xq), step):
            d2 = ((xq[i:i + step, None, :] - xr[None, :, :]) ** 2).sum(-1)
            if exclude_self:
                d2 = np.where(qk[i:i + step, None] == rk[None, :], np.inf, d2)
            rows, at = np.nonzero((d2 <= _kth(d2, min(k, d2.shape[1]))[:, None]) & np.isfinite(d2))
            order = np.lexsort((place[at], d2[rows, at], rows))
            rows, at = rows[order], at[order]
            begin = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, int)
            rank = np.arange(len(rows)) - np.repeat(begin, np.diff(np.append(begin, len(rows))))
            best = rank < k
            found.append((rows[best] + i, at[best], d2[rows[best], at[best]]))
        qi, ri, dd = (np.concatenate(x) for x in zip(*found))
        return pd.DataFrame({key: qk[qi], "nn_key": rk[ri], "_d2": dd, **{c: r[c].to_numpy()[ri] for c in ref_cols}})
    return fn


def _blocks(n: int) -> int:
    """Blocks of ``ROW_CHUNK`` to ``4 * ROW_CHUNK`` rows."""
    return max(1, math.ceil(n / max(ROW_CHUNK, min(4 * ROW_CHUNK, math.ceil(n / 8)))))


#: Rounding of a squared distance by a dot product, as a share of the squared lengths; it only widens what is scored.
ROUNDING = 1e-12


def _topk_block(k: int, key: str, vec: str, ref_cols: list[str], exclude_self: bool, schema):
    """Per (query block, row block): the k nearest rows of every query.

    A dot product tells which rows can be among them; these are scored by differences, as in :func:`_topk`."""
    def fn(q, r):
        import pyarrow as pa
        if not q.num_rows or not r.num_rows:
            return to_arrow_schema(schema).empty_table()
        xq, xr = list_matrix(q.column(vec).combine_chunks()), list_matrix(r.column("_rx").combine_chunks())
        qk, rk = q.column(key).to_pandas().to_numpy(), r.column("nn_key").to_pandas().to_numpy()
        # only distances enter: lengths taken from the block's centre lose fewer digits
        whole = np.isfinite(xr).all(axis=1)
        centre = xr[whole].mean(axis=0) if whole.any() else 0.0
        cq, cr = xq - centre, xr - centre
        lq, lr = (cq ** 2).sum(-1), (cr ** 2).sum(-1)
        order = np.argsort(rk, kind="stable")
        place = np.empty(len(rk), np.int64)
        place[order] = np.arange(len(rk))
        low, high = (np.searchsorted(rk, qk, side, sorter=order) for side in ("left", "right"))
        error = ROUNDING * (xq.shape[1] + 16) * (lq + lr[whole].max(initial=0.0))
        step = max(1, PORTION // 4 // len(xr))
        found = []
        for i in range(0, len(xq), step):
            near = cq[i:i + step] @ cr.T
            near *= -2.0
            near += lr
            near += lq[i:i + step, None]
            if exclude_self:
                for j in np.flatnonzero(low[i:i + step] < high[i:i + step]):
                    near[j, order[low[i + j]:high[i + j]]] = np.inf
            most = _kth(near, min(k, near.shape[1])) + 2.0 * error[i:i + step]
            rows, at = np.nonzero((near <= most[:, None]) & np.isfinite(near))
            d2 = np.concatenate([((xq[rows[j:j + ROW_CHUNK] + i] - xr[at[j:j + ROW_CHUNK]]) ** 2).sum(-1)
                                 for j in range(0, max(1, len(rows)), ROW_CHUNK)])
            by = np.lexsort((place[at], d2, rows))
            rows, at, d2 = rows[by], at[by], d2[by]
            begin = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, int)
            best = np.arange(len(rows)) - np.repeat(begin, np.diff(np.append(begin, len(rows)))) < k
            found.append((rows[best] + i, at[best], d2[best]))
        qi, ri, dd = (np.concatenate(x) for x in zip(*found))
        return pa.Table.from_arrays([q.column(key).take(pa.array(qi)), r.column("nn_key").take(pa.array(ri)), pa.array(dd),
                                     *[r.column(c).take(pa.array(ri)) for c in ref_cols]], names=schema.names)
    return fn


def knn_join(query: DataFrame, ref: DataFrame, k: int, key: str = "row_id", vec: str = "x",
             exclude_self: bool = False, ref_cols=(), n_pivots: int | None = None) -> DataFrame:
    """Exact k nearest reference rows of every query row.

    Returns ``(key, nn_key, dist, nn_rank, *ref_cols)``; ``nn_key`` and
    ``ref_cols`` come from the reference side. With ``exclude_self`` a query
    row never matches the reference row with the same key.

    Candidate (query, part) pairs come from the pivot bounds, over one or two levels of cells; queries of a
    part are dealt into chunks of about ``QUERY_CHUNK`` and its rows into chunks of about ``ROW_CHUNK`` by key hash, and
    every pair of chunks is scored by itself. The final top-k per query runs over at most
    k rows per candidate chunk.
    """
    spark = query.sparkSession
    r = ref.select(F.col(key).alias("nn_key"), F.col(vec).alias("_rx"), *ref_cols)
    ref_cols = r.columns[2:]  # names of the carried reference columns
    # Exact duplicates cannot be split by pivots; only the k (+1 for self) smallest keys of a
    # repeated vector can ever be chosen, so the rest are dropped (block-wise numbering,
    # safe when one vector holds a large share of the rows).
    from cohortml.functions.ordered import row_numbers
    keep = int(k) + (1 if exclude_self else 0)
    r = r.checkpoint(eager=True)  # several passes below read the reference rows
    reps = r.groupBy("_rx").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > keep)
    if reps.limit(1).count() > 0:  # trim only when some vector repeats more than k+1 times
        hot = r.join(reps.select("_rx"), "_rx", "left_semi")
        trimmed = row_numbers(hot, ["_rx"], ["nn_key"], "_dup").where(F.col("_dup") <= keep).drop("_dup")
        r = r.join(reps.select("_rx"), "_rx", "left_anti").unionByName(trimmed.select(*r.columns))
    pivots = choose_pivots(r.select(F.col("nn_key").alias(key), F.col("_rx").alias(vec)), key, vec, n_pivots)
    pivots_b = spark.sparkContext.broadcast(pivots)
    cells = _assign_cells(r, "_rx", pivots_b)
    radii = np.full(len(pivots), -np.inf)  # an empty cell keeps -inf and is never a candidate
    sizes = {}
    for row in cells.groupBy("cell").agg(F.max("dpiv").alias("rad"), F.count(F.lit(1)).alias("n")).collect():  # one row per pivot
        radii[row["cell"]], sizes[row["cell"]] = row["rad"], row["n"]
    radii_b = spark.sparkContext.broadcast(radii)
    asked = _own_cell(query.select(key, vec), vec, pivots_b, radii_b, keep).checkpoint(eager=True)
    out_fields = [query.schema[key], Tp.StructField("nn_key", ref.schema[key].dataType),
                  Tp.StructField("_d2", Tp.DoubleType())] + [r.schema[c] for c in ref_cols]
    w = Window.partitionBy(key).orderBy("_d2", "nn_key")  # at most k rows per candidate chunk
    total = asked.agg(F.count(F.lit(1)).alias("n"), F.sum("_reach").alias("reach")).first()
    n_rows = sum(sizes.values())
    q_blocks, r_blocks = _blocks(total["n"]), _blocks(n_rows)
    if (total["reach"] or 0) > total["n"] * r_blocks + n_rows * q_blocks:
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        left = (asked.select(key, vec).withColumn("_qb", F.pmod(hash_int("qc", key), F.lit(q_blocks).cast("long")))
                .withColumn("_rb", every(r_blocks)))
        right = r.withColumn("_rb", F.pmod(hash_int("rc", "nn_key"), F.lit(r_blocks).cast("long"))).withColumn("_qb", every(q_blocks))
        schema = Tp.StructType(out_fields)
        top_block = (left.groupBy("_qb", "_rb").cogroup(right.groupBy("_qb", "_rb"))
                     .applyInArrow(_topk_block(int(k), key, vec, ref_cols, exclude_self, schema), schema))
        top = top_block.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)
        return top.select(key, "nn_key", F.sqrt("_d2").alias("dist"), "nn_rank", *ref_cols)
    asked = asked.drop("_reach")
    if max(sizes.values(), default=0) > ROWS_PER_LEAF:
        cells = cells.checkpoint(eager=True)
        parts, table = _split_cells(cells, pivots, sizes)
        cand = _candidate_cells(_tighten(asked, key, vec, table, keep), vec, pivots_b, radii_b)
        cand = _candidate_parts(cand.select(key, vec, "_rq", "cell"), key, vec, table)
        part = ["cell", "sub"]
        refs = parts.drop("dsub")
    else:
        cand = _candidate_cells(asked.drop("cell"), vec, pivots_b, radii_b).drop("_rq")
        part, refs = ["cell"], cells.drop("dpiv")

    def chunks(rows, most, name):
        return rows.groupBy(*part).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(float(most)))).cast("long").alias(name))

    plan = chunks(cand, QUERY_CHUNK, "_nq").join(chunks(refs, ROW_CHUNK, "_nr"), part)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    cand = (cand.join(plan, part).withColumn("_qc", F.pmod(hash_int("qc", key), F.col("_nq"))).withColumn("_rc", every("_nr")).drop("_nq", "_nr"))
    refs = (refs.join(plan, part).withColumn("_rc", F.pmod(hash_int("rc", "nn_key"), F.col("_nr"))).withColumn("_qc", every("_nq")).drop("_nq", "_nr"))
    group = [*part, "_qc", "_rc"]
    top_part = (cand.groupBy(*group).cogroup(refs.groupBy(*group))
                .applyInPandas(_topk(int(k), key, vec, ref_cols, exclude_self), Tp.StructType(out_fields)))
    top = top_part.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)
    return top.select(key, "nn_key", F.sqrt("_d2").alias("dist"), "nn_rank", *ref_cols)


# ------------------------------------------------------------ resamplers
SMOTE_K = 5
BORDERLINE_M = 10


def _counts(df: DataFrame, label: str):
    c = {r[0]: r[1] for r in df.groupBy(label).count().collect()}  # one row per class
    if len(c) < 2:
        raise ValueError("resampling needs at least two classes")
    minority = min(c, key=lambda v: (c[v], v))
    majority = max(c, key=lambda v: (c[v], v))  # another class than the minority, equal sizes too
    return c, minority, majority


def _synthesize(base: DataFrame, pool: DataFrame, n_new: int, k: int, key: str, vec: str, label: str,
                minority, seed) -> DataFrame:
    """SMOTE interpolation: ``n_new`` rows spread evenly over the ``base`` rows.

    Base row i (in hash order) makes ``floor(n_new / n_b) + [i < n_new mod n_b]``
    samples; sample r goes towards neighbour ``hash(seed, key, r) mod k`` of
    its k nearest ``pool`` rows, at a hashed gap u in [0, 1).
    """
    from cohortml.functions.ordered import row_numbers
    nb = base.count()
    if n_new <= 0 or nb == 0:
        return base.sparkSession.createDataFrame([], f"{key} long, replica int, {label} int, {vec} array<double>")
    if pool.count() <= int(k):
        raise ValueError(f"SMOTE with k={k} needs more than {k} minority rows")
    nn = knn_join(base, pool, k, key, vec, exclude_self=True, ref_cols=[F.col(vec).alias("_nx")])
    pos = row_numbers(base.select(key, vec).withColumn("_h", hash_int(seed, key)), [], ["_h", key], "_pos")
    # synthetic sample s belongs to base position (s mod n_b) + 1 as replica s div n_b: the
    # samples are generated in parallel by a range, and a base row with many replicas is a
    # hot join key that adaptive skew handling splits
    synth = base.sparkSession.range(int(n_new)).select(
        ((F.col("id") % F.lit(int(nb))) + F.lit(1)).alias("_pos"),
        (F.col("id") / F.lit(int(nb))).cast("int").alias("replica"))
    reps = synth.join(pos.select(key, vec, "_pos"), "_pos", "inner").drop("_pos")
    reps = reps.withColumn("nn_rank", (F.pmod(hash_int(seed, key, "replica"), F.lit(int(k))) + F.lit(1)).cast("int"))
    j = reps.join(nn.select(key, "nn_rank", "_nx"), [key, "nn_rank"], "inner")
    u = hash_uniform(f"{seed}:gap", key, "replica")
    new = F.zip_with(F.col(vec), F.col("_nx"), lambda a, b: a + u * (b - a))
    return j.select(key, F.col("replica").cast("int"), F.lit(minority).cast("int").alias(label), new.alias(vec))


def rs_smote(df: DataFrame, key="row_id", vec="x", label="label", k: int = SMOTE_K, seed=42) -> DataFrame:
    """Originals plus SMOTE samples of the minority class until the two classes are equal.

    Output ``(key, replica, label, x)``: originals have ``replica = -1``,
    synthetic rows carry the key of their base row.
    """
    df = df.checkpoint(eager=True)  # multi-pass: read the input once
    c, mino, majo = _counts(df, label)
    minority = df.where(F.col(label) == mino)
    new = _synthesize(minority, minority, c[majo] - c[mino], k, key, vec, label, mino, seed)
    orig = df.select(key, F.lit(-1).alias("replica"), F.col(label).cast("int"), vec)
    return orig.unionByName(new)


def danger_rows(df: DataFrame, key="row_id", vec="x", label="label", m: int = BORDERLINE_M) -> DataFrame:
    """Minority rows with at least half, but not all, of their m neighbours in another class."""
    df = df.checkpoint(eager=True)  # multi-pass: read the input once
    c, mino, _ = _counts(df, label)
    minority = df.where(F.col(label) == mino)
    nn = knn_join(minority, df, m, key, vec, exclude_self=True, ref_cols=[F.col(label).alias("_nl")])
    n_maj = nn.groupBy(key).agg(F.sum((F.col("_nl") != F.lit(mino)).cast("int")).alias("n_maj"))
    danger = n_maj.where((F.col("n_maj") >= F.lit(m / 2.0)) & (F.col("n_maj") < F.lit(m))).select(key)
    return minority.join(danger, key, "left_semi")


def rs_borderline(df: DataFrame, key="row_id", vec="x", label="label", k: int = SMOTE_K,
                  m: int = BORDERLINE_M, seed=42) -> DataFrame:
    """Borderline SMOTE: synthetic rows only from minority rows in danger."""
    df = df.checkpoint(eager=True)  # multi-pass: read the input once
    c, mino, majo = _counts(df, label)
    minority = df.where(F.col(label) == mino)
    base = danger_rows(df, key, vec, label, m)
    new = _synthesize(base, minority, c[majo] - c[mino], k, key, vec, label, mino, seed)
    orig = df.select(key, F.lit(-1).alias("replica"), F.col(label).cast("int"), vec)
    return orig.unionByName(new)


def tomek_links(df: DataFrame, key="row_id", vec="x", label="label") -> DataFrame:
    """Pairs of mutual nearest neighbours with different labels: ``(key, nn_key)`` both ways."""
    nn = knn_join(df, df, 1, key, vec, exclude_self=True, ref_cols=[F.col(label).alias("_nl")])
    nn = nn.join(df.select(key, F.col(label).alias("_l")), key, "inner")
    a = nn.where(F.col("_l") != F.col("_nl")).select(key, "nn_key")
    b = a.select(F.col(key).alias("nn_key"), F.col("nn_key").alias(key))
    return a.join(b, [key, "nn_key"], "inner")


def rs_tomek(df: DataFrame, key="row_id", vec="x", label="label", remove: str = "majority") -> DataFrame:
    """Drop link members: non-minority ones (default) or both (``remove='all'``)."""
    df = df.checkpoint(eager=True)  # multi-pass: read the input once
    links = tomek_links(df, key, vec, label)
    members = df.join(links.select(key).distinct(), key, "left_semi")
    if remove == "all":
        drop = members.select(key)
    else:
        _, mino, _ = _counts(df, label)
        drop = members.where(F.col(label) != F.lit(mino)).select(key)
    return df.join(drop, key, "left_anti")


def rs_smotetomek(df: DataFrame, key="row_id", vec="x", label="label", k: int = SMOTE_K, seed=42) -> DataFrame:
    """SMOTE, then remove both members of every Tomek link."""
    sm = rs_smote(df, key, vec, label, k, seed)
    sm = sm.withColumn("_sid", F.concat_ws(":", F.col(key).cast("string"), F.col("replica").cast("string")))
    kept = rs_tomek(sm, "_sid", vec, label, remove="all")
    return kept.drop("_sid")


#: Centroids up to which Spark's KMeans finds them.
CENTRES = 1 << 14


def rs_centroids(df: DataFrame, key="row_id", vec="x", label="label", seed=42) -> DataFrame:
    """Replace the rows of every class but the smallest by k-means centroids, k = its size.

    A class that is as small as the smallest keeps its rows (each would be its own centroid). The
    centroids are the means of the assigned rows, computed as an aggregate. Up to ``CENTRES`` of them come from Spark's
    KMeans, which keeps them on the driver and may compare every row with all; more of them from :mod:`cohortml.operators.kmeans`,
    where a row meets those near its cell.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    from cohortml.operators.kmeans import cluster_means
    df = df.checkpoint(eager=True)  # multi-pass: read the input once
    c, mino, _ = _counts(df, label)
    k = int(c[mino])
    small = [v for v in c if c[v] == k]
    out = df.where(F.col(label).isin(small)).select(key, F.col(label).cast("int"), vec)
    first = 0
    for v in sorted(x for x in c if x not in small):
        rows = df.where(F.col(label) == F.lit(v))
        if k <= CENTRES:
            rows = rows.select(array_to_vector(vec).alias("features"))
            assigned = KMeans(k=k, seed=seed, featuresCol="features", maxIter=50).fit(rows).transform(rows)
            means = (assigned.groupBy("prediction").agg(Summarizer.mean(F.col("features")).alias("m"))
                     .select(F.col("prediction").alias("number"), vector_to_array("m").alias("mean")))
        else:
            whole = F.forall(vec, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
            rows = rows.select(F.when(whole, F.col(vec)).otherwise(
                F.raise_error(F.lit("vectors must not be null, nor hold null, NaN or infinity"))).alias("x"))
            means = cluster_means(rows, k, seed)
        out = out.unionByName(means.select((-F.col("number") - F.lit(1 + first)).cast("long").alias(key),
                                           F.lit(v).cast("int").alias(label), F.col("mean").alias(vec)))
        first += k
    return out


# ------------------------------------------------------------ kNN classifier
def knn_predict(test: DataFrame, train: DataFrame, k: int = 5, weights: str = "uniform", key="row_id",
                vec="x", label="label") -> DataFrame:
    """Class-1 probability from the k nearest training rows (uniform or 1/distance votes;
    with distance weights an exact match takes all the weight)."""
    nn = knn_join(test, train, k, key, vec, ref_cols=[F.col(label).alias("_nl")])
    if weights == "uniform":
        w = F.lit(1.0)
    elif weights == "distance":
        w = F.when(F.col("dist") == 0, F.lit(1.0)).otherwise(F.lit(1.0) / F.col("dist"))
    else:
        raise ValueError("weights must be 'uniform' or 'distance'")
    nn = nn.withColumn("_w", w)
    if weights == "distance":
        zero = F.max((F.col("dist") == 0).cast("int")).over(Window.partitionBy(key))  # k rows per key
        nn = nn.withColumn("_w", F.when(zero == 1, F.when(F.col("dist") == 0, 1.0).otherwise(0.0))
                           .otherwise(F.col("_w")))
    p = nn.groupBy(key).agg((F.sum(F.col("_w") * (F.col("_nl") == 1).cast("double")) / F.sum("_w")).alias("prob"))
    return test.select(key, label).join(p, key, "inner")
