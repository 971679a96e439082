"""AUC, curves and metric properties against brute force."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cohortml.operators import evaluate as E


def _scored(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    p = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)  # ties on a 0.01 grid
    pdf = pd.DataFrame({"row_id": np.arange(n), "label": y, "prob": p})
    return pdf, spark.createDataFrame(pdf)


def test_auc_brute_and_antisymmetry(spark):
    pdf, df = _scored(spark)
    pos, neg = pdf[pdf.label == 1].prob.values, pdf[pdf.label == 0].prob.values
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    got = E.m_auc(df).first()["auc"]
    assert abs(got - brute) < 1e-12
    flipped = E.m_auc(df.withColumn("prob", -F.col("prob"))).first()["auc"]
    assert abs(flipped - (1 - got)) < 1e-12


def test_all_equal_probabilities(spark):
    df = spark.createDataFrame([(i, i % 2, 0.3) for i in range(10)], "row_id long, label int, prob double")
    assert E.m_auc(df).first()["auc"] == 0.5
    roc = E.roc_curve(df).toPandas()
    assert len(roc) == 2  # start point and the single distinct score


def test_roc_monotone_and_ends(spark):
    _, df = _scored(spark)
    roc = E.roc_curve(df).toPandas().sort_values(["fpr", "tpr"])
    assert roc.fpr.is_monotonic_increasing and roc.tpr.is_monotonic_increasing
    assert roc.fpr.max() == 1.0 and roc.tpr.max() == 1.0


def test_calibration_edge_goes_to_lower_bin(spark):
    for p, b in [(0.1, 0), (0.2, 1), (0.0, 0), (1.0, 9), (0.15, 1)]:
        df = spark.createDataFrame([(0, 1, p)], "row_id long, label int, prob double")
        assert E.calibration_curve(df).first()["bin"] == b


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0, 1, 1.0), (1, 0, 0.0), (2, 0, 0.5)], "row_id long, label int, prob double")
    h = {r["bin"]: r["count"] for r in E.probability_histogram(df).collect()}
    assert h[9] == 1 and h[0] == 1 and h[5] == 1 and sum(h.values()) == 3


def test_gain_ends_at_one(spark):
    _, df = _scored(spark)
    g = E.gain_curve(df).toPandas()
    assert abs(g.gain.max() - 1.0) < 1e-12 and abs(g.pct_samples.max() - 1.0) < 1e-12
