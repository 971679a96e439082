"""Whole input and library behaviour: every row counts, errors instead of silent losses."""

import random

import numpy as np
import pytest
from cohortml.operators import hsic, models, neighbors, univariate
from cohortml.operators.boosting import fit_xgboost, split_gain_importance


def vectors(spark, n, d=4, seed=1, minority=None, classes=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = (1 if i < minority else 0) if minority is not None else i % classes
        rows.append((i, [rng.gauss(0, 1) + (1.5 * y if j == 1 else 0.0) for j in range(d)], y))
    return spark.createDataFrame(rows, "row_id long, x array<double>, label int")


def test_hsic_uses_the_last_rows(spark):
    df = vectors(spark, 39)
    one = hsic.hsic_importances(df, 3, B=20)
    flipped = df.selectExpr("row_id", "x", "CASE WHEN row_id >= 20 THEN 1 - label ELSE label END AS label")
    assert one != hsic.hsic_importances(flipped, 3, B=20)
    assert max(one) > 0


@pytest.mark.parametrize("n, B", [(15, 20), (41, 20), (30, 0)])
def test_hsic_takes_any_number_of_rows(spark, n, B):
    assert max(hsic.hsic_importances(vectors(spark, n), 2, B=B)) > 0


def dcor(x, y):
    a, b = np.abs(x[:, None] - x[None, :]), np.abs(y[:, None] - y[None, :])
    A = a - a.mean(0) - a.mean(1)[:, None] + a.mean()
    B = b - b.mean(0) - b.mean(1)[:, None] + b.mean()
    return np.sqrt(max((A * B).mean(), 0) / np.sqrt((A * A).mean() * (B * B).mean()))


@pytest.mark.parametrize("kind", ["continuous", "classes70", "ties"])
def test_distance_correlation_of_any_label(spark, kind):
    rng = np.random.default_rng(3)
    n = 140
    y = {"continuous": rng.normal(size=n), "classes70": np.arange(n) % 70, "ties": np.round(rng.normal(size=n), 1)}[kind]
    x = np.stack([np.round(rng.normal(size=n), 1), y + rng.normal(size=n), np.round(y * y, 1)])
    rows = [(f, float(x[f, i]), float(y[i])) for f in range(3) for i in range(n)]
    df = spark.createDataFrame(rows, "feature int, value double, label double")
    out = {r.feature: (r.score, r.n) for r in univariate.score_distancecorr(df).collect()}
    for f in range(3):
        assert out[f][0] == pytest.approx(dcor(x[f], np.asarray(y, float)), abs=1e-9) and out[f][1] == n


def test_distance_correlation_forms_agree(spark):
    df = vectors(spark, 60, classes=5).selectExpr("row_id", "label", "posexplode(x) AS (feature, value)")
    a = {r.feature: r.score for r in univariate.score_distancecorr(df).collect()}
    b = {r.feature: r.score for r in univariate._distancecorr_any(df, ["feature"], "value", "label").collect()}
    assert all(a[f] == pytest.approx(b[f], abs=1e-9) for f in a)


def test_smote_needs_enough_minority_rows(spark):
    with pytest.raises(ValueError, match="minority"):
        neighbors.rs_smote(vectors(spark, 40, minority=4), k=5)
    out = neighbors.rs_smote(vectors(spark, 40, minority=6), k=5).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in out} == {0: 34, 1: 34}


def test_centroids_of_equal_and_of_three_classes(spark):
    same = neighbors.rs_centroids(vectors(spark, 40)).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in same} == {0: 20, 1: 20}
    rng = random.Random(4)
    rows = [(i, [rng.gauss(5 * y, 1), rng.gauss(0, 1)], y) for i, y in enumerate([0] * 30 + [1] * 20 + [2] * 8)]
    df = spark.createDataFrame(rows, "row_id long, x array<double>, label int")
    out = neighbors.rs_centroids(df)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts[2] == 8 and 1 <= counts[0] <= 8 and 1 <= counts[1] <= 8
    assert out.select("row_id").distinct().count() == sum(counts.values())
    means = {r["label"]: r["m"] for r in out.selectExpr("label", "x[0] AS v").groupBy("label").agg({"v": "avg"})
             .withColumnRenamed("avg(v)", "m").collect()}
    assert abs(means[0]) < 2 and abs(means[1] - 5) < 2


def test_chi2_rejects_negative_values(spark):
    df = spark.createDataFrame([(0, 1.0, 0), (0, -0.25, 1)], "feature int, value double, label int")
    with pytest.raises(Exception, match="non-negative"):
        univariate.score_chi2(df).collect()


def test_svc_is_fitted_on_all_rows(spark):
    df = vectors(spark, 60)
    base = models.fit_svc(df, C=1.0)
    for part in ("row_id % 2 = 0", "row_id % 2 = 1"):  # a change in either half moves the final fit
        moved = df.selectExpr("row_id", f"CASE WHEN {part} THEN transform(x, v -> v * 2) ELSE x END AS x", "label")
        assert not np.allclose(models.fit_svc(moved, C=1.0).model.coefficients.toArray(), base.model.coefficients.toArray())


def test_boosting_child_weight_and_gain(spark):
    df = vectors(spark, 80)
    m = fit_xgboost(df, n_estimators=2, max_depth=3, learning_rate=0.3)
    imp = split_gain_importance(m.model, 4)
    assert sum(imp) == pytest.approx(1.0) and max(imp) == imp[1]
    free = sum(len(t["splits"]) for t in fit_xgboost(df, n_estimators=1, max_depth=4, min_child_weight=0.0).model.trees)
    held = sum(len(t["splits"]) for t in fit_xgboost(df, n_estimators=1, max_depth=4, min_child_weight=6.0).model.trees)
    assert held < free


def test_vote_train_prefers_the_better_model(spark):
    from cohortml.plans import pipeline as P
    df = vectors(spark, 90)
    train, test = df.where("row_id < 60"), df.where("row_id >= 60")
    cfgs = [P.build_pipeline(family="logistic", params={"C": 1.0}),
            P.build_pipeline(family="logistic", params={"C": 1e-4})]
    table, weights = P.vote_train(train, test, cfgs, n_trials=8, cv=3, scoring="accuracy")
    rows = {r["name"]: r for r in table.collect()}
    assert set(rows) == {"voting_0", "voting_1", "voting_2", "voting_mean"} and len(weights) == 2
    assert all(1 <= w <= 100 for w in weights)
    # the weights are those of the trial with the best mean over the held-out folds
    val, _ = P.fold_predictions(train, test, cfgs, 3)
    from cohortml.operators import evaluate as E
    voted = E.vote_soft(val, {0: float(weights[0]), 1: float(weights[1])})
    assert voted.count() == 60
    assert rows["voting_mean"]["val_score"] >= 0.5


def test_run_auto_ranks_votes_stacks_and_writes(spark, tmp_path):
    from cohortml.plans import pipeline as P
    from cohortml.sources import files as FS
    df = vectors(spark, 90)
    train, test = df.where("row_id < 60"), df.where("row_id >= 60")
    out = P.run_auto(train, test, families=("logistic", "knn"), n_trials=1, cv=2, ensemble=True, stack=True, top_n=2,
                     stack_top_n=2, vote_trials=3, path=str(tmp_path))
    names = {r["name"] for r in out["metrics"].collect()}
    assert {"logistic_mean", "knn_0", "voting_0", "voting_mean"} <= names
    assert spark.read.parquet(f"{tmp_path}/metrics").count() == len(names)
    meta = spark.read.parquet(f"{tmp_path}/stacked")
    assert meta.where("is_test = 0").count() == 60 and meta.where("is_test = 1").count() == 30
    manifest = {r["name"]: r["path"] for r in spark.read.json(f"{tmp_path}/manifest").collect()}
    assert len(manifest) == 2
    for name, path in manifest.items():
        family, i = name.rsplit("_", 1)
        before = {r["row_id"]: r["prob"] for r in out["models"][family][int(i)].predict(test).collect()}
        after = {r["row_id"]: r["prob"] for r in FS.load_model(spark, path).predict(test).collect()}
        assert before == pytest.approx(after)


def test_explanations_name_the_selected_features(spark):
    from cohortml.plans import pipeline as P
    from cohortml.plans.reports import retrieve_features
    df = vectors(spark, 80, d=6)
    names = [f"gene{i}" for i in range(6)]
    cfg = P.build_pipeline(family="logistic", first_filter={"function": "f_classif", "mode": "k_best", "param": 3})
    fp = P.FittedPipeline(cfg).fit(df)
    out = retrieve_features(fp, df, df.limit(0), names)
    kept = {names[i] for i in fp.keep1}
    assert {r["feature"] for r in out["shap_mean_abs"].collect()} == kept and "gene1" in kept
    phi = {r["row_id"]: r["s"] for r in out["shap"].groupBy("row_id").agg({"shap": "sum"})
           .withColumnRenamed("sum(shap)", "s").collect()}
    base = out["shap"].first()["base_value"]
    prob = {r["row_id"]: r["prob"] for r in fp.predict(df).collect()}
    assert all(1 / (1 + np.exp(-(base + phi[i]))) == pytest.approx(prob[i], abs=1e-6) for i in prob)


@pytest.mark.parametrize("learner", [None, {"type": "symbolic", "n_components": 2, "population": 12, "generations": 1}])
def test_explanations_of_other_models(spark, learner):
    from cohortml.plans import pipeline as P
    from cohortml.plans.reports import retrieve_features
    df = vectors(spark, 40, d=3)
    fp = P.FittedPipeline(P.build_pipeline(family="rf", params={"n_estimators": 5}, learner=learner)).fit(df)
    out = retrieve_features(fp, df.where("row_id < 6"), df.limit(0), n_perm=1, n_background=5)
    sums = {r["row_id"]: (r["s"], r["b"]) for r in out["shap"].groupBy("row_id").agg({"shap": "sum", "base_value": "max"})
            .withColumnRenamed("sum(shap)", "s").withColumnRenamed("max(base_value)", "b").collect()}
    prob = {r["row_id"]: r["prob"] for r in fp.predict(df.where("row_id < 6")).collect()}
    assert all(s + b == pytest.approx(prob[i], abs=1e-9) for i, (s, b) in sums.items()) and len(sums) == 6
    if learner:
        assert {r["feature"] for r in out["shap"].collect()} == set(fp.pca.names()) and out["learner"].count() == 2
