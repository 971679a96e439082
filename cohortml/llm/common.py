"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortml.session import ensure_checkpoint_dir

#: The separators between words, as a Java, RE2 and Python regular expression class.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def text_of(name: str = "text") -> Column:
    """The text column with null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from the written copy.

    This cuts the lineage, keeps non-deterministic tags stable for every later reader, and a lost
    executor costs only the reading of files again.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder of this library through Spark's own file systems."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def worker_state(key, make):
    """``make()`` once per Python worker process and ``key``; later tasks in the same process reuse it.

    Functions are shipped to the workers by value, so a module global would be made anew for every
    task; the state hangs on a module object of the process instead.
    """
    mod = sys.modules.setdefault("_cohortml_llm_worker", types.ModuleType("_cohortml_llm_worker"))
    cache = mod.__dict__.setdefault("state", {})
    if key not in cache:
        cache[key] = make()
    return cache[key]


def vocabulary_path(name: str) -> str:
    """A vocabulary file: a path is taken as it is, a bare name is looked up among the public tokenizers."""
    if os.path.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of an undirected edge list ``(a long, b long)``.

    ``root`` is the smallest node of the component. Alternating large-star and small-star rounds;
    the minimum of a neighbourhood is a partial aggregate, so a node with very many neighbours is
    combined before the shuffle, and the way back to its edges is an equi-join that adaptive
    execution splits. Every round is written to the checkpoint folder. Stops when a round changes
    nothing; raises if that does not happen within ``max_rounds`` (the rounds grow with the
    logarithm of the longest path, so that is a fault and never a cut).
    """
    def both(e):
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def mark(e):
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 30)).alias("h")).first()
        return r["n"], r["h"]

    cur = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .where("a <> b").distinct())
    seen = mark(cur)
    if seen[0] == 0:
        return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node goes to the smallest one in sight
        nb = both(cur)
        low = nb.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (nb.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # small star: a node and its smaller neighbours go to the smallest of them
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small_low, "a")
        small = (joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(small_low.select("a", F.col("m").alias("b"))).distinct())
        cur = materialise(small)
        now = mark(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.groupBy("a").agg(F.min("b").alias("root"))
    return (roots.select(F.col("a").alias("node"), "root")
            .union(roots.select(F.col("root").alias("node"), "root").distinct()))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet at ``path`` and read again; what was written survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
