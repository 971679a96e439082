"""Fused folds and the search over them against one fit per fold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortml.operators import evaluate as E
from cohortml.operators.folds import stratified_kfold
from cohortml.plans import pipeline as P


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(21)
    n = 180
    y = (rng.random(n) < 0.4).astype(int)
    x = rng.normal(size=(n, 8)) * np.array([1, 10, 1, 1, 1, 1, 1e-3, 1])
    x[:, 0] += 1.2 * y
    x[:, 1] -= 9 * y
    x[:, 5] = 3.0
    df = spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))],
                               "row_id long, x array<double>, label int").repartition(4).checkpoint()
    return df.where("row_id % 5 <> 0"), df.where("row_id % 5 = 0"), x


CONFIGS = [dict(family="logistic", params={"C": 0.5}, first_filter={"function": "kruskal", "mode": "k_best", "param": 4}),
           dict(family="logistic", params={"C": 0.5}, first_filter={"function": "mutual_info_classif", "mode": "percentile", "param": 50},
                learner={"type": "pca", "n_components": 2}),
           dict(family="logistic", scaler=False, params={"C": 0.5}, second_filter={"method": "l1_logistic", "threshold": "mean", "C": 1.0})]


@pytest.mark.parametrize("config", CONFIGS)
def test_fused_folds_equal_a_fit_per_fold(rows, config):
    train, test, _ = rows
    cfg = P.build_pipeline(**config)
    got = P.cross_validate(train, cfg, 3, "roc_auc", test)
    folded = stratified_kfold(train, 3).checkpoint()
    for f in range(3):
        alone = P.FittedPipeline(cfg).fit(folded.where(F.col("fold") != f).drop("fold"))
        fused = got["models"][f]
        assert fused.keep1 == alone.keep1 and fused.keep2 == alone.keep2
        if cfg.scaler:
            assert np.allclose(fused.mean, alone.mean) and np.allclose(fused.scale, alone.scale) and fused.scale[5] == 1.0
        held = E.score_on_test(alone.predict(folded.where(F.col("fold") == f).drop("fold"))).first()
        assert got["val_scores"][f] == pytest.approx(held["auc"])
        m = E.score_on_test(alone.predict(test)).first()
        assert got["test_metrics"][f] == pytest.approx((m["accuracy"], m["f1"], m["mcc"], m["auc"]))


def test_scalers_of_all_folds(rows):
    train, _, x = rows
    folded = stratified_kfold(train, 4).checkpoint()
    fold = {r.row_id: r.fold for r in folded.select("row_id", "fold").collect()}
    means, scales = P.fold_scalers(folded, 4)
    for f in range(4):
        part = x[[i for i, g in fold.items() if g != f]]
        sd = part.std(axis=0)
        assert np.allclose(means[f], part.mean(axis=0), rtol=1e-12) and np.allclose(scales[f], np.where(sd > 1e-9, sd, 1.0), rtol=1e-9)


def test_number_of_jobs_does_not_grow_with_the_folds(spark, rows):
    train, _, _ = rows
    cfg = P.build_pipeline(**CONFIGS[0])
    jobs = []
    for cv in (3, 9):
        inputs = P.FoldInputs(train, cv)
        spark.sparkContext.setJobGroup(f"folds-{cv}", "scaler and univariate filter")
        fitted = [P.FittedPipeline(cfg) for _ in range(cv)]
        for fp, m, s in zip(fitted, *P.fold_scalers(inputs.folded, cv)):
            fp.mean, fp.scale = m, s
        found = inputs._filtered(cfg, fitted)
        assert set(found) == set(range(cv)) and all(len(r) == 8 for r in found.values())
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"folds-{cv}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0] + 3  # adaptive execution may cut a stage more or less


def test_trials_share_stages_and_resume(spark, rows, tmp_path, monkeypatch):
    train, test, _ = rows
    ran, fitted = [], []
    evaluate, fit = P.FoldInputs.evaluate, P.FoldInputs._fit
    monkeypatch.setattr(P.FoldInputs, "evaluate", lambda self, cfg, scoring: ran.append(cfg.params) or evaluate(self, cfg, scoring))
    monkeypatch.setattr(P.FoldInputs, "_fit", lambda self, cfg: fitted.append(1) or fit(self, cfg))
    base = {"first_filter": {"function": "pearson", "mode": "k_best", "param": 3}}
    first, models, cfg = P.search_family(train, test, "logistic", 2, 3, base=base, path=str(tmp_path))
    assert len(ran) == 2 and len(fitted) == 1 and len(models) == 3
    again, models, cfg2 = P.search_family(train, test, "logistic", 2, 3, base=base, path=str(tmp_path))
    assert len(ran) == 3 and len(models) == 3 and cfg2 == cfg  # the best one, once more
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in first.collect()]
    more, _, _ = P.search_family(train, test, "logistic", 4, 3, base=base, path=str(tmp_path))
    assert 5 <= len(ran) <= 6
    whole, _, _ = P.search_family(train, test, "logistic", 4, 3, base=base)
    assert [tuple(r) for r in more.collect()] == [tuple(r) for r in whole.collect()]
    with pytest.raises(ValueError):
        P.search_family(train, test, "logistic", 0, 3)
