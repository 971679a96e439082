"""Classifier families on Spark ML, and the embedded selectors built on them.

Data: VECTOR layout ``(row_id, x array<double>, label int[, weight])``; the
array is turned into an ML vector only at fit time. Balanced class weights
go in through ``weightCol``. Library regularisation ``C`` (penalty on the
summed loss) maps to Spark's ``regParam`` (penalty on the mean loss) as
``regParam = 1 / (C * sum(w))``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortml.functions.arrays import MarginTrees, list_matrix
from cohortml.functions.hashing import hash_uniform
from cohortml.operators.prep import balanced_weights

FAMILIES = ("svc", "logistic", "rf", "mlp", "xgboost", "et", "ada", "gdbt", "knn")


def to_ml(df: DataFrame, vec: str = "x") -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(vec)))


def with_weights(df: DataFrame, label: str = "label") -> DataFrame:
    if "weight" in df.columns:
        return df
    return balanced_weights(df, label, "weight")


def n_features(df: DataFrame, vec: str = "x") -> int:
    return int(df.select(F.size(vec)).first()[0])


class FittedModel:
    """A fitted classifier with ``predict(df) -> (row_id, label, prob, pred)``."""

    def __init__(self, family: str, model, params: dict, extra=None):
        self.family, self.model, self.params, self.extra = family, model, params, extra or {}

    def margin_features(self, df: DataFrame, vec: str = "x") -> DataFrame:
        rff = self.extra.get("rff")
        if rff is not None:
            df = rff(df, vec)
        return to_ml(df, vec)

    def predict(self, df: DataFrame, vec: str = "x", key: str = "row_id", label: str = "label") -> DataFrame:
        if self.family == "knn":
            from cohortml.operators.neighbors import knn_predict
            p = knn_predict(df, self.model, self.params["k"], self.params["weights"], key, vec, label)
            return p.withColumn("pred", (F.col("prob") > 0.5).cast("int"))
        if self.family == "ada":
            return _ada_predict(self, df, vec, key, label)
        if self.family in ("xgboost", "rf", "et"):
            return self.model.predict(df, vec, key, label)
        if self.family == "svc":
            scored = self.model.transform(self.margin_features(df, vec))
            m = vector_to_array("rawPrediction")[1]
            a, b = self.extra["platt"]
            prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * m + F.lit(b))))
            return scored.select(key, label, prob.alias("prob")).withColumn("pred", (F.col("prob") > 0.5).cast("int"))
        scored = self.model.transform(to_ml(df, vec))
        prob = vector_to_array("probability")[1]
        return scored.select(key, label, prob.alias("prob")).withColumn("pred", (F.col("prob") > 0.5).cast("int"))


    def scorer(self):
        """``(trees, prepare, places)`` that give in a task what :meth:`predict` gives: trees over the inputs, what maps
        a matrix of rows to the inputs, and the column behind each input (None: the same). None for families without."""
        if self.family != "gdbt":
            return None
        trees = [_splits_and_leaves(t._java_obj.rootNode(), float(w)) for t, w in zip(self.model.trees, self.model.treeWeights)]
        return MarginTrees(trees), None, None


def _splits_and_leaves(root, weight: float) -> tuple[list, list]:
    """Of a fitted tree: ``(feature, threshold)`` of every split, and ``(path, value)`` of every leaf."""
    splits, leaves = [], []

    def walk(node, path):
        if node.subtreeDepth() == 0:
            leaves.append((path, weight * float(node.prediction())))
            return
        at = len(splits)
        splits.append((int(node.split().featureIndex()), float(node.split().threshold())))
        walk(node.leftChild(), [*path, (at, True)])
        walk(node.rightChild(), [*path, (at, False)])

    walk(root, [])
    return splits, leaves


# ------------------------------------------------------------ families
def _sum_w(df: DataFrame) -> float:  # noqa: D103
    return float(df.agg(F.sum("weight")).first()[0])


def fit_logistic(df: DataFrame, C: float = 1.0, l1_ratio: float = 0.5, max_iter: int = 200, **_) -> FittedModel:
    d = with_weights(df)
    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                            regParam=1.0 / (C * _sum_w(d)), elasticNetParam=float(l1_ratio),
                            standardization=False, maxIter=int(max_iter))
    return FittedModel("logistic", lr.fit(to_ml(d)), {"C": C, "l1_ratio": l1_ratio})


def random_fourier(n_in: int, n_out: int, gamma: float, seed=42):
    """z_j = sqrt(2/D) cos(w_j . x + b_j), w ~ N(0, 2 gamma I), b ~ U[0, 2 pi): a column transform, one matrix
    product per Arrow batch."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_out, n_in))
    b = rng.uniform(0.0, 2 * math.pi, size=n_out)
    scale = math.sqrt(2.0 / n_out)

    @F.pandas_udf("array<double>")
    def features(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        return pd.Series(list(scale * np.cos(np.stack(x.to_list()) @ w.T + b)))

    def apply(df: DataFrame, vec: str = "x") -> DataFrame:
        return df.withColumn(vec, features(vec))
    return apply


def fit_svc(df: DataFrame, C: float = 1.0, kernel: str = "linear", n_components: int = 64,
            calibration_folds: int = 3, **_) -> FittedModel:
    """Linear SVC on all rows; rbf through ``n_components`` random Fourier features (gamma = 1/d).

    Probabilities are a logistic fit of the label on out-of-fold margins: ``calibration_folds``
    further fits, each scoring the hash fold that it has not seen."""
    d = with_weights(df)
    extra = {}
    if kernel == "rbf":
        nf = n_features(d)
        extra["rff"] = random_fourier(nf, int(n_components), 1.0 / nf)
        extra["rff_args"] = [nf, int(n_components), 1.0 / nf]
        d = extra["rff"](d, "x")
    d = d.checkpoint(eager=True)  # several fits read the rows (and their random features)
    fold = F.floor(hash_uniform("platt", "row_id") * F.lit(int(calibration_folds)))

    def fit(rows):
        return LinearSVC(featuresCol="features", labelCol="label", weightCol="weight",
                         regParam=1.0 / (C * _sum_w(rows)), maxIter=200).fit(to_ml(rows))

    margins = None
    for k in range(int(calibration_folds)):
        held = d.where(fold == k)
        part = d.where(fold != k)
        if part.select("label").distinct().count() < 2:
            continue  # too few rows to leave a fold out
        m = fit(part).transform(to_ml(held)).select("label", vector_to_array("rawPrediction")[1].alias("m"))
        margins = m if margins is None else margins.unionByName(m)
    model = fit(d)
    if margins is None:
        margins = model.transform(to_ml(d)).select("label", vector_to_array("rawPrediction")[1].alias("m"))
    platt = LogisticRegression(featuresCol="features", labelCol="label", regParam=0.0, maxIter=100).fit(
        margins.withColumn("features", array_to_vector(F.array("m"))))
    extra["platt"] = (float(platt.coefficients[0]), float(platt.intercept))
    return FittedModel("svc", model, {"C": C, "kernel": kernel}, extra)


def fit_rf(df: DataFrame, n_estimators: int = 100, max_depth: int = 4, min_samples_split: int = 5, min_samples_leaf: int = 5,
           max_samples: float = 1.0, seed: int = 42, **_) -> FittedModel:
    """Every tree on a class-balanced bootstrap of ``max_samples`` times the smallest class, from each class."""
    from cohortml.operators.forest import grow_forest
    m = grow_forest(df, n_estimators, max_depth, min_samples_split, min_samples_leaf, max_samples, seed=int(seed))
    return FittedModel("rf", m, {"n_estimators": n_estimators, "max_depth": max_depth})


def fit_et(df: DataFrame, n_estimators: int = 100, max_depth: int = 4, min_samples_split: int = 5, min_samples_leaf: int = 5,
           seed: int = 42, **_) -> FittedModel:
    """Extremely randomised trees: all rows, one uniform cut per node and feature, balanced class weights."""
    from cohortml.operators.forest import grow_forest
    m = grow_forest(df, n_estimators, max_depth, min_samples_split, min_samples_leaf, bootstrap=False, random_cuts=True, seed=int(seed))
    return FittedModel("et", m, {"n_estimators": n_estimators, "max_depth": max_depth})


def fit_mlp(df: DataFrame, hidden=(8,), learning_rate: float = 0.03, batch_size: int = 32, seed: int = 42,
            max_iter: int = 200, **_) -> FittedModel:
    nf = n_features(df)
    mlp = MultilayerPerceptronClassifier(featuresCol="features", labelCol="label",
                                         layers=[nf, *[int(h) for h in hidden], 2], stepSize=float(learning_rate),
                                         blockSize=int(batch_size), seed=int(seed), maxIter=int(max_iter))
    return FittedModel("mlp", mlp.fit(to_ml(df)), {"hidden": list(hidden)})


def fit_gdbt(df: DataFrame, n_estimators: int = 50, learning_rate: float = 0.1, max_depth: int = 3,
             min_samples_leaf: int = 5, subsample: float = 1.0, seed: int = 42, **_) -> FittedModel:
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=int(n_estimators),
                        stepSize=float(learning_rate), maxDepth=int(max_depth),
                        minInstancesPerNode=int(min_samples_leaf), subsamplingRate=float(subsample),
                        seed=int(seed))
    return FittedModel("gdbt", gbt.fit(to_ml(df)), {"n_estimators": n_estimators})


def fit_ada(df: DataFrame, n_estimators: int = 50, learning_rate: float = 0.1, **_) -> FittedModel:
    """Discrete SAMME on decision stumps: one weighted stump fit per round; the
    weights are updated with a column expression (no row leaves Spark)."""
    d = to_ml(df.select("row_id", "x", "label")).withColumn("weight", F.lit(1.0)).checkpoint(eager=True)
    tree = DecisionTreeClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxDepth=1)
    columns = d.columns
    stumps = []
    for _i in range(int(n_estimators)):
        stump = tree.fit(d)
        d2 = stump.transform(d).select(*columns, (F.col("prediction") != F.col("label")).cast("double").alias("wrong"))
        err = float(d2.agg(F.sum(F.col("weight") * F.col("wrong")) / F.sum("weight")).first()[0])
        if err <= 0:
            stumps.append((*_stump(stump), 1.0))
            break
        if err >= 0.5:
            break
        alpha = float(learning_rate) * math.log((1.0 - err) / err)
        stumps.append((*_stump(stump), alpha))
        # divided by the new mean, so that the weights keep their sum
        up = math.exp(alpha)
        d = d2.withColumn("weight", F.col("weight") * F.when(F.col("wrong") > 0, F.lit(up)).otherwise(F.lit(1.0))
                          / F.lit(err * up + 1.0 - err)).drop("wrong")
        d = d.checkpoint(eager=True)  # cut the growing lineage of the weight updates
    return FittedModel("ada", None, {"n_estimators": n_estimators}, {"stumps": stumps})


def _stump(model) -> tuple:
    """``(feature, threshold, class at most, class above)`` of a fitted stump; a leaf has feature -1."""
    root = model._java_obj.rootNode()
    if model.depth == 0:
        return -1, 0.0, float(root.prediction()), float(root.prediction())
    split = root.split()
    return (int(split.featureIndex()), float(split.threshold()), float(root.leftChild().prediction()),
            float(root.rightChild().prediction()))


def _ada_predict(m: FittedModel, df: DataFrame, vec, key, label) -> DataFrame:
    score = F.lit(0.0)
    total = sum(s[4] for s in m.extra["stumps"]) or 1.0
    for feature, threshold, low, high, alpha in m.extra["stumps"]:
        side = F.lit(low) if feature < 0 else F.when(F.element_at(vec, feature + 1) <= threshold, F.lit(low)).otherwise(F.lit(high))
        score = score + F.lit(alpha) * (F.lit(2.0) * side - F.lit(1.0))
    prob = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * score / F.lit(total)))
    return df.select(key, label, prob.alias("prob")).withColumn("pred", (F.col("prob") > 0.5).cast("int"))


def fit_knn(df: DataFrame, k: int = 5, weights: str = "uniform", **_) -> FittedModel:
    return FittedModel("knn", df.select("row_id", "x", "label"), {"k": int(k), "weights": weights})


FITTERS = {
    "svc": fit_svc, "logistic": fit_logistic, "rf": fit_rf, "mlp": fit_mlp, "et": fit_et,
    "ada": fit_ada, "gdbt": fit_gdbt, "knn": fit_knn,
}


def fit_family(family: str, df: DataFrame, **params) -> FittedModel:
    if family == "xgboost":
        from cohortml.operators.boosting import fit_xgboost
        return fit_xgboost(df, **params)
    if family not in FITTERS:
        raise ValueError(f"unknown classifier family {family!r}")
    return FITTERS[family](df, **params)


# ------------------------------------------------------------ search spaces
def _log_uniform(u: float, lo: float, hi: float) -> float:
    return math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo)))


def _step(u: float, lo: int, hi: int, step: int = 1) -> int:
    n = (hi - lo) // step + 1
    return lo + step * min(int(u * n), n - 1)


def draw_params(family: str, trial: int, seed: int = 42) -> dict:
    """Seeded random draw from a family's search space (deterministic per trial)."""
    import random
    r = random.Random(f"{seed}:{family}:{trial}")
    u = r.random
    if family == "svc":
        return {"C": _log_uniform(u(), 1e-3, 1.0), "kernel": r.choice(["linear", "rbf"])}
    if family == "logistic":
        return {"C": _log_uniform(u(), 1e-3, 1.0), "l1_ratio": u()}
    if family in ("rf", "et"):
        p = {"n_estimators": _step(u(), 50, 200, 10), "max_depth": _step(u(), 2, 6),
             "min_samples_split": _step(u(), 5, 20), "min_samples_leaf": _step(u(), 5, 20)}
        if family == "rf":
            p["max_samples"] = 0.5 + 0.5 * u()
        return p
    if family == "mlp":
        layers = _step(u(), 1, 3)
        return {"hidden": tuple(_step(u(), 2, 15, 2) for _ in range(layers)),
                "learning_rate": _log_uniform(u(), 1e-4, 1e-1), "batch_size": r.choice([16, 32])}
    if family == "xgboost":
        return {"max_depth": _step(u(), 2, 6), "learning_rate": _log_uniform(u(), 1e-3, 1e-1),
                "reg_alpha": _log_uniform(u(), 0.1, 10), "reg_lambda": _log_uniform(u(), 0.1, 10),
                "subsample": 0.6 + 0.4 * u(), "n_estimators": _step(u(), 50, 200, 10), "gamma": u()}
    if family == "ada":
        return {"n_estimators": _step(u(), 50, 200, 10), "learning_rate": _log_uniform(u(), 1e-3, 1e-1)}
    if family == "gdbt":
        return {"n_estimators": _step(u(), 50, 200, 10), "learning_rate": _log_uniform(u(), 1e-4, 1e-1),
                "max_depth": _step(u(), 2, 6), "min_samples_leaf": _step(u(), 5, 20),
                "subsample": 0.5 + 0.5 * u()}
    if family == "knn":
        return {"k": _step(u(), 1, 10), "weights": r.choice(["uniform", "distance"])}
    raise ValueError(f"unknown classifier family {family!r}")


# ------------------------------------------------------------ embedded selectors
def embed_l1_logistic(df: DataFrame, C: float = 1.0) -> list[float]:
    """Coefficients of an L1 logistic fit with balanced weights (one per feature)."""
    d = with_weights(df)
    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                            regParam=1.0 / (C * _sum_w(d)), elasticNetParam=1.0, standardization=False,
                            maxIter=200)
    return [float(v) for v in lr.fit(to_ml(d)).coefficients.toArray()]


#: Rows that a block of :func:`embed_l1_svc` holds.
ROWS_PER_BLOCK = 1024


def embed_l1_svc(df: DataFrame, C: float = 1.0, steps: int = 500, tol: float = 1e-4) -> list[float]:
    """L1-penalised squared-hinge linear SVC with balanced weights, by proximal gradient.

    Each step is one distributed pass: the gradient of the weighted mean
    squared hinge loss is an aggregate over rows; the L1 proximal step
    (soft threshold) is applied to the small coefficient vector on the driver, the intercept included. The step is the
    inverse of a bound of the loss's curvature; it ends when no coefficient moves by more than
    ``tol``, and fails if that does not happen within ``steps`` passes.
    """
    d = with_weights(df).select("x", (F.col("label") * 2 - 1).cast("double").alias("y"), "weight").checkpoint(eager=True)
    nf = n_features(df)
    sw = _sum_w(d)
    lam = 1.0 / (C * sw)
    # every pass reads the rows as blocks of numbers: x, the intercept's one, y and the weight
    width = nf + 3

    def block(batches):
        import pyarrow as pa
        for b in batches:
            x = list_matrix(b.column(0)) if b.num_rows else np.zeros((0, nf))
            m = np.column_stack([x, np.ones(len(x)), np.asarray(b.column(1)), np.asarray(b.column(2))])
            for i in range(0, len(m), ROWS_PER_BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([m[i:i + ROWS_PER_BLOCK].tobytes()], pa.binary())], names=["m"])

    blocks = d.where(F.col("x").isNotNull()).select("x", "y", F.col("weight").cast("double")).mapInArrow(block, "m binary").checkpoint(eager=True)

    def gradient(at):
        def run(batches):
            import pyarrow as pa
            total = np.zeros(nf + 1)
            for b in batches:
                for raw in b.column(0):
                    m = np.frombuffer(raw.as_buffer()).reshape(-1, width)
                    x, y, weight = m[:, :nf + 1], m[:, nf + 1], m[:, nf + 2]
                    total += (-2.0 / sw * weight * y * np.maximum(0.0, 1.0 - y * (x @ at))) @ x
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["g"])
        return run

    # the mean squared hinge loss curves by at most 2 mean |(x, 1)|^2; momentum restarts when it overshoots
    norm = F.aggregate("x", F.lit(1.0), lambda acc, v: acc + v * v)
    curve = 2.0 * float(d.agg(F.sum(F.col("weight") * norm)).first()[0]) / sw
    at = now = np.zeros(nf + 1)
    t = 1.0
    for _ in range(int(steps)):
        # one aggregate for weights and intercept
        g = (blocks.mapInArrow(gradient(at), "g array<double>").select(array_to_vector("g").alias("g"))
             .select(Summarizer.sum(F.col("g"))).first()[0].toArray())
        new = at - g / curve
        new = np.sign(new) * np.maximum(np.abs(new) - lam / curve, 0.0)
        if float((at - new) @ (new - now)) > 0:
            t = 1.0
        after = (1.0 + (1.0 + 4.0 * t * t) ** 0.5) / 2.0
        at = new + (t - 1.0) / after * (new - now)
        moved, now, t = float(np.max(np.abs(new - now))), new, after
        if moved < tol:
            return [float(v) for v in now[:nf]]
    raise RuntimeError(f"the L1 SVC moved by {moved:.2g} still after {steps} passes")


def embed_rf(df: DataFrame, n_estimators: int = 100, max_depth: int = 4, seed: int = 42) -> list[float]:
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight", numTrees=int(n_estimators),
                                maxDepth=int(max_depth), minInstancesPerNode=5, seed=int(seed))
    return [float(v) for v in rf.fit(to_ml(with_weights(df))).featureImportances.toArray()]


def embed_gbt(df: DataFrame, n_estimators: int = 50, seed: int = 42, **kw) -> list[float]:
    """Importance from the second-order boosting job: mean gain of a feature's splits, normalised."""
    from cohortml.operators.boosting import fit_xgboost, split_gain_importance
    m = fit_xgboost(df, n_estimators=n_estimators, seed=seed, **kw)
    return split_gain_importance(m.model, n_features(df))


def embed_ada(df: DataFrame, n_estimators: int = 20) -> list[float]:
    m = fit_ada(df, n_estimators=n_estimators)
    nf = n_features(df)
    tot = np.zeros(nf)
    for feature, _, _, _, a in m.extra["stumps"]:
        if feature >= 0:
            tot[feature] += a
    s = tot.sum()
    return [float(v) for v in (tot / s if s > 0 else tot)]


def importance_table(df: DataFrame, values: list[float]) -> DataFrame:
    """Feature index, importance: a table of one row per feature."""
    return df.sparkSession.createDataFrame([(i, float(v)) for i, v in enumerate(values)],
                                           "feature int, importance double")
