"""Stratified train/test split and stratified k-fold assignment.

Rows are ordered inside each class by a hash of ``(seed, row_id)``; the
position comes from the block-wise running count, so a class with a third of
all rows is still numbered by many tasks. Membership is reproducible after
recomputation and in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortml.functions import bounded
from cohortml.functions.hashing import hash_int, sql_hash_int
from cohortml.functions.ordered import row_numbers

SEED = 42


def _class_positions(df: DataFrame, label: str, key: str, seed) -> DataFrame:
    h = df.withColumn("_h", hash_int(seed, key))
    ranked = row_numbers(h, [label], ["_h", key], name="_rn")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n_c"))
    return ranked.join(sizes, label, "inner").drop("_h")


def stratified_split(df: DataFrame, label: str = "label", key: str = "row_id",
                     test_size: float = 0.2, seed=SEED) -> DataFrame:
    """Add ``split`` ('train' / 'test'); each class sends ``round(test_size * n_c)`` rows to test."""
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must lie in (0, 1)")
    if label not in df.columns:
        raise ValueError(f"label column {label!r} missing")
    # only keys and labels are ranked; what comes of it is the last test row of each class
    p = _class_positions(df.select(key, label), label, key, seed)
    n_test = F.round(F.lit(float(test_size)) * F.col("_n_c"))
    last = (p.where(F.col("_rn") == n_test)
            .select(F.col(label).alias("_l"), F.struct(hash_int(seed, key).alias("h"), F.col(key).alias("k")).alias("_last")))
    out = df.join(bounded(last), df[label] == F.col("_l"), "left")
    at = F.struct(hash_int(seed, key).alias("h"), F.col(key).alias("k"))
    return (out.withColumn("split", F.when(at <= F.col("_last"), F.lit("test")).otherwise(F.lit("train")))
            .drop("_l", "_last"))


def stratified_kfold(df: DataFrame, k: int = 10, label: str = "label", key: str = "row_id",
                     seed=SEED, name: str = "fold") -> DataFrame:
    """Add ``fold`` in ``0..k-1``; class counts per fold differ by at most one. ``key`` identifies a row."""
    if int(k) != k or k < 2:
        raise ValueError("k must be an integer >= 2")
    # keys and labels alone are ranked; the other columns meet their row's fold in one equi-join
    ranked = row_numbers(df.select(key, label).withColumn("_h", hash_int(seed, key)), [label], ["_h", key], name="_rn")
    fold = ((F.col("_rn") - F.lit(1)) % F.lit(int(k))).cast("int").alias(name)
    return df.join(ranked.select(key, fold), key)


def explode_training_folds(df: DataFrame, k: int, fold: str = "fold", name: str = "train_fold") -> DataFrame:
    """Copy each row into the ``k - 1`` folds whose training part it belongs to.

    Per-fold statistics then become one grouped job keyed by ``train_fold``.
    """
    folds = F.filter(F.sequence(F.lit(0), F.lit(int(k) - 1)), lambda f: f != F.col(fold))
    return df.withColumn(name, F.explode(folds))


def split_sql(table_sql: str, label: str = "label", key: str = "row_id",
              test_size: float = 0.2, seed=SEED) -> str:
    h = sql_hash_int(seed, key)
    return f"""(SELECT * EXCLUDE (_rn, _n_c),
       CASE WHEN _rn <= round({float(test_size)!r} * _n_c) THEN 'test' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {h}, {key}) AS _rn,
               count(*) OVER (PARTITION BY {label}) AS _n_c
          FROM {table_sql} _t) _r)"""


def kfold_sql(table_sql: str, k: int = 10, label: str = "label", key: str = "row_id", seed=SEED) -> str:
    h = sql_hash_int(seed, key)
    return f"""(SELECT * EXCLUDE (_rn), CAST((_rn - 1) % {int(k)} AS INTEGER) AS fold
  FROM (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {h}, {key}) AS _rn
          FROM {table_sql} _t) _r)"""
