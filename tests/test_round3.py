"""Steps that read or write each row once, whatever the number of folds, tables or orders."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortml.operators import explain, models
from cohortml.plans import pipeline as P
from cohortml.plans.reports import visual_report


def vectors(spark, n=120, d=4, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    y = (x[:, 0] + 0.3 * rng.normal(size=n) > 0).astype(int)
    df = spark.createDataFrame([(i, [float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))], "row_id long, x array<double>, label int")
    return x, y, df.repartition(3)


@pytest.fixture
def written(spark, monkeypatch):
    calls = []
    frame = type(spark.range(0))
    plain = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda d, *a, **o: calls.append(d.columns) or plain(d, *a, **o))
    return calls


def test_permutation_attributions_need_no_shuffle_per_row_and_order(spark):
    x, _, df = vectors(spark, 30)
    w = [0.5, -1.0, 2.0, 0.25]
    predict = lambda d: d.select("row_id", F.aggregate(F.zip_with("x", F.array(*map(F.lit, w)), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v).alias("prob"))
    phi = explain.permutation_attributions(predict, df, df, n_perm=2, n_background=30)
    assert "Window" not in phi._jdf.queryExecution().executedPlan().toString()
    want = np.array(w) * (x - x.mean(axis=0))
    rows = phi.collect()
    assert len(rows) == 30 * 4
    for r in rows:
        assert abs(r["shap"] - want[r["row_id"], r["feature"]]) < 1e-9 and r["value"] == x[r["row_id"], r["feature"]]


def test_l1_svc_reads_blocks(spark, monkeypatch):
    _, _, df = vectors(spark, 300)
    monkeypatch.setattr(models, "ROWS_PER_BLOCK", 7)
    small = models.embed_l1_svc(df, 0.5)
    monkeypatch.undo()
    monkeypatch.setattr(F, "zip_with", lambda *a: 1 / 0)
    assert np.allclose(models.embed_l1_svc(df, 0.5), small, atol=1e-9) and abs(small[0]) > max(map(abs, small[1:]))


def test_folds_are_not_copied_for_scaling(spark, written):
    _, _, df = vectors(spark)
    res = P.FoldInputs(df, 5, df).evaluate(P.build_pipeline(family="logistic", params={"C": 0.5}))
    assert len(res["val_scores"]) == len(res["test_metrics"]) == 5 and min(res["val_scores"]) > 0.7
    assert sum("x" in columns for columns in written) <= 2


def test_predictions_of_a_report_are_written_once(spark, written):
    _, _, df = vectors(spark)
    fp = P.FittedPipeline(P.build_pipeline(family="logistic", params={"C": 0.5})).fit(df)
    del written[:]
    visual_report(fp, df, df)
    assert sum({"prob", "pred", "split"} <= set(columns) and len(columns) == 5 for columns in written) == 1


def test_copies_of_a_key_share_its_attribution(spark):
    x, _, df = vectors(spark, 10)
    predict = lambda d: d.select("row_id", F.col("x")[0].alias("prob"))
    one = {r["feature"]: r["shap"] for r in explain.permutation_attributions(predict, df.where("row_id = 3"), df, 1, 10).collect()}
    two = explain.permutation_attributions(predict, df.where("row_id = 3").unionByName(df.where("row_id = 3")), df, 1, 10).collect()
    assert len(two) == 8 and all(abs(r["shap"] - one[r["feature"]] / 2) < 1e-12 for r in two) and abs(one[0]) > 1e-3


def test_permutation_attributions_of_trees_equal_the_stream_of_mixes(spark):
    """A booster's mixes are scored in the task of the row, without a call of ``predict`` for them."""
    x = np.random.default_rng(4).normal(size=(120, 6)) * np.arange(1, 7)
    rows = [(i, [float(u) for u in v], int(v[1] + v[2] * v[4] > 0)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows + rows[:1], "row_id long, x array<double>, label int")
    for filters in ({}, {"first_filter": {"function": "kruskal", "mode": "k_best", "param": 4}}):
        fp = P.FittedPipeline(P.build_pipeline(family="gdbt", params={"n_estimators": 4, "max_depth": 3}, **filters)).fit(df)
        some = df.where("row_id < 12")
        at = lambda predict: {(r.row_id, r.feature, round(r.value, 9)): (r.shap, r.base_value) for r in explain.permutation_attributions(predict, some, df, 2, 9).collect()}
        seen, was = [], fp.predict
        want = at(lambda d: was(d))
        fp.model.predict = lambda *a, f=fp.model.predict, **k: (seen.append(1), f(*a, **k))[1]
        got = at(fp.predict)
        assert len(seen) == 1 and got.keys() == want.keys()
        assert max(abs(a - b) for k in want for a, b in zip(want[k], got[k])) < 1e-12
        assert max(abs(v[0]) for v in want.values()) > 1e-3
