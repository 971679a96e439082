"""Model sanity: families beat the majority rate on a separable table; pipeline errors."""

import numpy as np
import pandas as pd
import pytest

from cohortml.operators import evaluate as E
from cohortml.plans import pipeline as P


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(0)
    n = 240
    y = (rng.random(n) < 0.35).astype(int)
    x = rng.normal(size=(n, 5))
    x[:, 0] += 2.5 * y
    x[:, 1] -= 1.5 * y
    pdf = pd.DataFrame({"row_id": np.arange(n), "x": [list(map(float, r)) for r in x], "label": y})
    df = spark.createDataFrame(pdf, "row_id long, x array<double>, label int")
    return df.where("row_id % 4 != 0"), df.where("row_id % 4 = 0")


@pytest.mark.parametrize("family,params", [
    ("logistic", {"C": 1.0, "l1_ratio": 0.5}), ("svc", {"C": 1.0}), ("rf", {"n_estimators": 20}), ("et", {"n_estimators": 20}),
    ("gdbt", {"n_estimators": 10}), ("knn", {"k": 5}), ("ada", {"n_estimators": 5, "learning_rate": 0.5}),
    ("xgboost", {"n_estimators": 5, "learning_rate": 0.3}), ("mlp", {"hidden": (4,), "learning_rate": 0.1}),
])
def test_family_beats_majority(spark, separable, family, params):
    tr, te = separable
    fp = P.FittedPipeline(P.build_pipeline(family=family, params=params)).fit(tr)
    acc = E.point_metrics(fp.predict(te)).first()["accuracy"]
    base = max(te.where("label = 1").count(), te.where("label = 0").count()) / te.count()
    assert acc > base


def test_pipeline_errors():
    with pytest.raises(ValueError):
        P.build_pipeline(family="logistic", resampler="kmeans")
    with pytest.raises(ValueError):
        P.build_pipeline(family="logistic", learner={"type": "umapx"})
    with pytest.raises(ValueError):
        P.build_pipeline(family="nope")


def test_stacking_guard(spark, separable):
    tr, te = separable
    with pytest.raises(ValueError):
        P.stack_train(tr, te, [], top_n=5, save_features=10)


def test_label_missing():
    from cohortml.operators.prep import cast_label

    class D:
        columns = ["a"]
    with pytest.raises(ValueError):
        cast_label(D(), None, "y")


def test_permutation_attributions_add_up(spark, separable):
    from pyspark.sql import functions as F

    from cohortml.operators.explain import permutation_attributions
    tr, te = separable
    fp = P.FittedPipeline(P.build_pipeline(family="rf", params={"n_estimators": 10})).fit(tr)
    rows = te.limit(8)
    phi = permutation_attributions(fp.predict, rows, tr, n_perm=2, n_background=6)
    tot = phi.groupBy("row_id").agg((F.first("base_value") + F.sum("shap")).alias("s"))
    got = tot.join(fp.predict(rows).select("row_id", "prob"), "row_id").toPandas()
    assert len(got) == 8 and np.allclose(got["s"], got["prob"], atol=1e-9)
