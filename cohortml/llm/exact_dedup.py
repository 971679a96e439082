"""Exact deduplication: a tree merge of sorted digest runs.

Every input partition makes one sorted run of records (digest, size, second hash, smallest row,
count). The runs then meet in binomial rounds: the partitions are numbered in base ``radix``, and
in round k the ``radix`` partitions whose numbers differ in digit k exchange the records of their
runs, each keeping the part whose digest has its own digit k. A partition merges what it receives
(an external multiway merge by sort) and keeps one record per digest with the smallest row. After
``log_radix(partitions)`` rounds every partition owns one range of digests. No run is ever merged
in one place: a partition holds its share of the records at every level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortml.llm.common import SPACE, materialise, shuffle_width, text_of

KEY = ["digest", "size", "check"]


def normal_text(text: Column) -> Column:
    """Every run of separators as one space."""
    return F.regexp_replace(text, f"{SPACE}+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """``(doc_id, tag, digest, size, check)`` of every row.

    ``digest`` is the SHA-256 of the normalised text, ``size`` and ``check`` (byte length and
    XXH64) verify it, ``tag`` numbers the rows so that repeated rows differ. Written once, so that
    the tags stay the same for all readers.
    """
    t = docs.select("doc_id", normal_text(text_of()).alias("t"), F.monotonically_increasing_id().alias("tag"))
    return materialise(t.select("doc_id", "tag", F.unhex(F.sha2("t", 256)).alias("digest"),
                                F.octet_length("t").alias("size"), F.xxhash64("t").alias("check")))


def _digit(number: Column, k: int, bits: int) -> Column:
    return F.shiftright(number, k * bits).bitwiseAND(F.lit((1 << bits) - 1))


def merge_runs(rows: DataFrame, bits: int = 3, rounds: int | None = None) -> DataFrame:
    """``(digest, size, check, low, n)``: the smallest row and the count of every distinct text.

    ``low`` is ``struct(no_id boolean, doc_id, tag)``. ``bits``: the base-2 logarithm of the radix.
    ``rounds``: by default enough for one range per shuffle partition. Records of equal digest that
    differ in size or second hash are never merged.
    """
    if rounds is None:
        rounds = max(1, -(-max(shuffle_width(rows.sparkSession) - 1, 1).bit_length() // bits))
    width = 1 << (bits * rounds)
    address = F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("long")
    low = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag")
    runs = (rows.withColumn("cell", F.pmod(F.spark_partition_id().cast("long"), F.lit(width)))
            .withColumn("one", F.lit(1).cast("long")).withColumn("low", low)
            .select("cell", *KEY, "low", F.col("one").alias("n")))
    for k in range(rounds):
        here = _digit(F.col("cell"), k, bits)
        there = _digit(address, k, bits)
        runs = (runs.withColumn("cell", F.col("cell") + (there - here) * F.lit(1 << (k * bits)))
                .repartition(width, "cell").sortWithinPartitions("cell", *KEY)
                .groupBy("cell", *KEY).agg(F.min("low").alias("low"), F.sum("n").alias("n")))
    return runs.drop("cell")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after replacing each run of separators by one space. Of equal
    texts the row with the smallest ``doc_id`` stays (null ids last); of repeated rows with that
    id exactly one stays. Null and empty texts form one group. An empty table gives an empty one.
    """
    rows = digests(docs)
    best = merge_runs(rows)
    return (rows.join(best, KEY)
            .select("doc_id", F.col("low.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                    (F.col("tag") == F.col("low.tag")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns."""
    keep = merge_runs(digests(docs)).select(F.col("low.doc_id").alias("_id"),
                                            F.lower(F.hex("digest")).alias("_sha"))
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"),
                       F.sha2(normal_text(text_of()), 256).alias("_sha"))
    on = rows["_id"].eqNullSafe(keep["_id"]) & (rows["_sha"] == keep["_sha"])
    return rows.join(keep, on, "left_semi").dropDuplicates(["_id", "_sha"]).select("_row.*")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
  FROM d"""
