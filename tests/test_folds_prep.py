"""Split and folds: partition and stratification properties; scaling and imputation."""

import numpy as np
from pyspark.sql import functions as F

from cohortml.operators import folds, prep
from cohortml.sources import tables as T
from conftest import SF_MID


def test_kfold_partitions_and_balances(spark):
    lab = T.label_five(spark, SF_MID)
    f = folds.stratified_kfold(lab, 10).toPandas()
    assert len(f) == lab.count() and f["row_id"].is_unique
    per = f.groupby(["label", "fold"]).size().unstack(fill_value=0)
    assert (per.max(axis=1) - per.min(axis=1)).max() <= 1


def test_split_proportions(spark):
    lab = T.label_binary(spark, SF_MID)
    s = folds.stratified_split(lab, test_size=0.2).toPandas()
    for _, g in s.groupby("label"):
        assert abs((g["split"] == "test").sum() - round(0.2 * len(g))) == 0


def test_fold_statistics_do_not_leak(spark):
    """Changing a validation-fold row must not change that fold's fitted statistics."""
    long = T.matrix_long(spark, SF_MID)
    lab = folds.stratified_kfold(T.label_five(spark, SF_MID), 5)
    j = long.join(lab, "row_id")
    ex = folds.explode_training_folds(j, 5)
    stats = prep.scaler_stats(ex, ["train_fold", "feature"]).where("train_fold = 0 AND feature = 3").first()
    changed = j.withColumn("value", F.when(F.col("fold") == 0, F.lit(1e6)).otherwise(F.col("value")))
    stats2 = prep.scaler_stats(folds.explode_training_folds(changed, 5), ["train_fold", "feature"]) \
        .where("train_fold = 0 AND feature = 3").first()
    assert stats["mean"] == stats2["mean"] and stats["scale"] == stats2["scale"]


def test_zero_variance_scales_to_zero(spark):
    df = spark.createDataFrame([(i, 0, 5.0) for i in range(6)], "row_id long, feature int, value double")
    out = prep.standard_scale(df).toPandas()
    assert (out["value"] == 0.0).all()


def test_exact_median_even_and_odd(spark):
    for vals in ([1.0, 3.0, 2.0, 10.0], [4.0, 1.0, 7.0]):
        df = spark.createDataFrame([(v,) for v in vals], "x double")
        got = prep.exact_quantile(df, [], "x", 0.5, "m").first()["m"]
        assert got == float(np.median(vals))


def test_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    out = prep.impute_mode(df, ["s"]).toPandas()
    assert out["s"].tolist().count("a") == 3
