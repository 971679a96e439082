"""Pipeline assembly, cross-validation, trial search, ensembles and the one-call driver.

Stages run in a fixed order: scaler, univariate filter, embedded filter,
learner, resampler (fit path only), classifier. Every stage is fitted on the
training rows of its fold only; the fitted state of each stage is small
(per-feature statistics, kept indices, components) and is applied to other
rows as column expressions. Data stays in VECTOR layout
``(row_id, x array<double>, label)``; per-feature statistics go through
LONG (``posexplode``) and grouped aggregates.
"""

from __future__ import annotations

import copy
import json
import random
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortml.functions import bounded
from cohortml.functions.arrays import fold_sum, list_matrix
from cohortml.operators import evaluate as E
from cohortml.operators import models as MD
from cohortml.operators import select as S
from cohortml.operators import univariate as U
from cohortml.operators.folds import explode_training_folds, stratified_kfold


# ------------------------------------------------------------ layout helpers
def to_long(df: DataFrame, vec: str = "x", key: str = "row_id", label: str = "label") -> DataFrame:
    return df.select(key, label, F.posexplode(vec).alias("feature", "value"))


def _lit_array(vals) -> F.Column:
    return F.array(*[F.lit(float(v)) for v in vals])


def take_indices(df: DataFrame, idx, vec: str = "x") -> DataFrame:
    """Keep the listed positions of the feature array."""
    return df.withColumn(vec, F.array(*[F.element_at(vec, int(i) + 1) for i in idx]))


# ------------------------------------------------------------ stages
@dataclass
class PipelineConfig:
    family: str = "logistic"
    params: dict = field(default_factory=dict)
    scaler: bool = True
    first_filter: dict | None = None      # {"function", "mode", "param"}
    second_filter: dict | None = None     # {"method", "threshold", ...}
    learner: dict | None = None           # {"type": "pca"|"kpca", "n_components": k}
    resampler: str | dict | None = None   # smote | borderline | tomek | smotetomek | centroids, or {"type", options}


RESAMPLERS = ("smote", "borderline", "tomek", "smotetomek", "centroids")
LEARNERS = ("pca", "kpca", "symbolic")
SECOND = ("l1_logistic", "l1_svc", "rf", "ada", "xgb", "hsic")


def build_pipeline(**kw) -> PipelineConfig:
    """Validate and assemble a pipeline description (stages in fixed order)."""
    cfg = PipelineConfig(**kw)
    name = cfg.resampler.get("type") if isinstance(cfg.resampler, dict) else cfg.resampler
    if name is not None and name not in RESAMPLERS:
        raise ValueError(f"unknown resampler {name!r}")
    if cfg.learner is not None and cfg.learner.get("type") not in LEARNERS:
        raise ValueError(f"unknown learner {cfg.learner.get('type')!r}")
    if cfg.second_filter is not None and cfg.second_filter.get("method") not in SECOND:
        raise ValueError(f"unknown selection method {cfg.second_filter.get('method')!r}")
    if cfg.family not in MD.FAMILIES:
        raise ValueError(f"unknown classifier family {cfg.family!r}")
    return cfg


class FittedPipeline:
    def __init__(self, cfg: PipelineConfig):
        self.cfg = cfg
        self.mean = self.scale = None
        self.keep1 = self.keep2 = None
        self.scores1 = self.importances2 = None
        self.pca = None
        self.model: MD.FittedModel | None = None

    # -- fitting
    def fit(self, train: DataFrame) -> "FittedPipeline":
        d = train.select("row_id", "x", "label")
        if self.cfg.scaler:
            means, scales = fold_scalers(d.withColumn("fold", F.lit(0)), 0)
            self.mean, self.scale = means[0], scales[0]
            d = self._scale(d)
        if self.cfg.first_filter:
            self._first_filter(filter_features(to_long(d), self.cfg.first_filter).collect())  # one row per feature
            d = take_indices(d, self.keep1)
        self.fit_model(self.fit_rest(d))
        return self

    def _first_filter(self, rows) -> None:
        """``rows``: ``feature, score, pvalue, selected`` of every feature."""
        self.scores1 = sorted(rows, key=lambda r: r["feature"])
        self.keep1 = [r["feature"] for r in self.scores1 if r["selected"]]
        if not self.keep1:
            raise ValueError("the univariate filter kept no feature")

    def fit_rest(self, d: DataFrame) -> DataFrame:
        """Fit the stages after the univariate filter on filtered rows; the rows that the classifier is fitted on."""
        if self.cfg.second_filter:
            sf = self.cfg.second_filter
            kw = {k: v for k, v in sf.items() if k not in ("method", "threshold")}
            if sf.get("method") == "hsic":
                if not isinstance(sf.get("threshold", 20), int):
                    raise ValueError("with hsic the threshold must be an integer number of features")
                kw["num_feat"] = sf.get("threshold", 20)
            imp = embedded_importances(d, sf.get("method", "l1_svc"), **kw)
            self.importances2 = imp
            if sf.get("method") == "hsic":  # the threshold is the number of features; selected = nonzero
                self.keep2 = [i for i, v in enumerate(imp) if v > 0] or [int(np.argmax(imp))]
            else:
                tbl = MD.importance_table(d, imp)
                kept = (S.threshold_select(tbl, sf.get("threshold", "mean")).where("selected")
                        .select("feature").collect())
                self.keep2 = sorted(r[0] for r in kept) or [int(np.argmax(np.abs(imp)))]
            d = take_indices(d, self.keep2)
        if self.cfg.learner:
            from cohortml.operators.project import fit_pca
            lt = self.cfg.learner
            options = {k: v for k, v in lt.items() if k not in ("type", "n_components", "kernel")}
            if lt.get("type") == "symbolic":
                from cohortml.operators.symbolic import learn_symbolic
                self.pca = learn_symbolic(d, int(lt.get("n_components", 2)), **options)
            else:
                self.pca = fit_pca(d, int(lt.get("n_components", 2)), kernel=lt.get("type", "pca"),
                                   kpca_kernel=lt.get("kernel", "linear"), **options)
            d = self.pca.transform(d)
        if self.cfg.resampler:
            rs = self.cfg.resampler
            options = {k: v for k, v in rs.items() if k != "type"} if isinstance(rs, dict) else {}
            d = resample(d, rs["type"] if isinstance(rs, dict) else rs, **options)
        return d

    def fit_model(self, d: DataFrame) -> "FittedPipeline":
        self.model = MD.fit_family(self.cfg.family, d, **self.cfg.params)
        return self

    def with_classifier(self, cfg: PipelineConfig) -> "FittedPipeline":
        """The same fitted stages under a configuration that differs in the classifier alone."""
        out = copy.copy(self)
        out.cfg, out.model = cfg, None
        return out

    def _scale(self, d: DataFrame) -> DataFrame:
        m, s = _lit_array(self.mean), _lit_array(self.scale)
        return d.withColumn("x", F.transform("x", lambda v, i: (v - F.element_at(m, i + 1)) / F.element_at(s, i + 1)))

    # -- applying
    def transform(self, df: DataFrame) -> DataFrame:
        d = df.select("row_id", "x", "label")
        if self.mean is not None:
            d = self._scale(d)
        if self.keep1 is not None:
            d = take_indices(d, self.keep1)
        if self.keep2 is not None:
            d = take_indices(d, self.keep2)
        if self.pca is not None:
            d = self.pca.transform(d)
        return d

    def predict(self, df: DataFrame) -> DataFrame:
        return self.model.predict(self.transform(df))

    def scorer(self):
        """:meth:`FittedModel.scorer` behind the scaler and the filters; None behind a learner."""
        found = self.model.scorer() if self.pca is None else None
        if found is None:
            return None
        mean, scale, places = self.mean, self.scale, self.keep1
        if self.keep2 is not None:
            places = self.keep2 if places is None else [places[i] for i in self.keep2]

        def prepare(x):
            x = x if mean is None else (x - mean) / scale
            return x if places is None else x[:, places]
        return found[0], prepare, places

    def selected(self, n: int) -> list[int]:
        """Original positions of the ``n`` or fewer features that pass both filters."""
        kept = list(self.keep1) if self.keep1 is not None else list(range(n))
        return [kept[i] for i in self.keep2] if self.keep2 is not None else kept

    def input_names(self, names: list[str]) -> list[str]:
        """Names of the classifier's inputs: the selected features, or the learner's components."""
        if self.pca is not None:
            return self.pca.names()
        return [names[i] for i in self.selected(len(names))]


def embedded_importances(d: DataFrame, method: str, **kw) -> list[float]:
    if method == "l1_logistic":
        return MD.embed_l1_logistic(d, **kw)
    if method == "l1_svc":
        return MD.embed_l1_svc(d, **kw)
    if method == "rf":
        return MD.embed_rf(d, **kw)
    if method == "ada":
        return MD.embed_ada(d, **kw)
    if method == "xgb":
        return MD.embed_gbt(d, **kw)
    if method == "hsic":
        from cohortml.operators.hsic import hsic_importances
        return hsic_importances(d, **kw)
    raise ValueError(f"unknown selection method {method!r}")


def resample(d: DataFrame, name: str, **options) -> DataFrame:
    """Resampled ``(row_id, x, label)``; ``options`` go to the resampler (``k``, ``m``, ``seed``, ``remove``)."""
    from cohortml.operators import neighbors as N
    plain = {"tomek": N.rs_tomek, "centroids": N.rs_centroids}
    synthetic = {"smote": N.rs_smote, "borderline": N.rs_borderline, "smotetomek": N.rs_smotetomek}
    if name in plain:
        return plain[name](d, **options).select("row_id", "x", "label")
    if name not in synthetic:
        raise ValueError(f"unknown resampler {name!r}")
    # written once: synthetic rows get fresh negative keys by their place
    out = synthetic[name](d, **options).checkpoint(eager=True)
    key = F.when(F.col("replica") < 0, F.col("row_id")).otherwise(-F.monotonically_increasing_id() - F.lit(1))
    return out.select(key.alias("row_id"), "x", "label").checkpoint(eager=True)


# ------------------------------------------------------------ cross-validation and search
SCORERS = {"accuracy": "accuracy", "f1": "f1", "mcc": "mcc", "roc_auc": "auc", "auc": "auc"}


def _scorer(scoring):
    if callable(scoring):
        return scoring
    if scoring not in SCORERS:
        raise ValueError(f"unknown scoring {scoring!r}")
    col = SCORERS[scoring]
    return lambda preds: E.score_on_test(preds).select(col).first()[0]


def fold_scalers(folded: DataFrame, cv: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and population deviations (zero: one) of the training part of every fold, ``max(cv, 1) x features``.

    Two passes over all rows, whatever the number of folds: sums per fold, then squares around each fold's own
    mean. A training part adds up the folds other than its own (all terms are positive, so nothing cancels). With ``cv`` of 0
    the one part is all rows.
    """
    parts = max(int(cv), 1)

    def sums(centre):
        def part(batch):
            x, fold = list_matrix(batch.column(0)), np.asarray(batch.column(1))
            x = x if centre is None else (x - centre[fold]) ** 2
            return np.concatenate([[(fold == f).sum(), *x[fold == f].sum(axis=0)] for f in range(parts)])
        return part

    rows = folded.select("x", "fold")
    first = fold_sum(rows, sums(None))
    if first is None:
        raise ValueError("no rows to fit on")
    n, total = np.split(first.reshape(parts, -1), [1], axis=1)
    own = total / np.maximum(n, 1.0)
    squares = fold_sum(rows, sums(own)).reshape(parts, -1)[:, 1:]
    means, scales = [], []
    for f in range(parts):
        g = [i for i in range(parts) if i != f or not cv]
        count = max(n[g].sum(), 1.0)
        mean = total[g].sum(axis=0) / count
        deviation = np.sqrt((squares[g] + n[g] * (own[g] - mean) ** 2).sum(axis=0) / count)
        means.append(mean)
        # a deviation within the rounding of the mean is none
        scales.append(np.where(deviation <= 8 * np.finfo(float).eps * np.abs(mean), 1.0, deviation))
    return np.array(means), np.array(scales)


def filter_features(long: DataFrame, options: dict, group=()) -> DataFrame:
    """``(group..., feature, score, pvalue, selected)`` of the univariate filter, all groups in one job."""
    fn = options.get("function", "mutual_info_classif")
    scores = U.score(long, fn, keys=(*group, "feature"))
    return (S.apply_mode(scores, options.get("mode", "percentile"), options.get("param", 1), fn, fn in U.OWN_FUNCTIONS, group)
            .select(*group, "feature", "score", "pvalue", "selected"))


class FoldInputs:
    """The rows of all folds, written once, and the fitted stages before the classifier, per configuration of these.

    Scaler and univariate filter of all folds are fused: one grouped job keyed by ``(fold, feature)``
    each. The later stages are fitted per fold. What a classifier needs of a fold (its training rows
    after all stages, the held-out rows and the test rows) is written if such stages made it, so that trials which differ in the
    classifier read it and fit nothing else again; scaled and filtered features are expressions of the rows, not copies per fold.
    """

    def __init__(self, train: DataFrame, cv: int, test: DataFrame | None = None):
        self.cv = int(cv)
        self.folded = stratified_kfold(train.select("row_id", "x", "label"), cv).checkpoint(eager=True)
        self.test = None if test is None else test.select("row_id", "x", "label").checkpoint(eager=True)
        self._ready, self._locks, self._lock = {}, {}, threading.Lock()

    def stages(self, cfg: PipelineConfig) -> list[tuple]:
        """Per fold ``(fitted stages, training rows, held-out rows, test rows)``."""
        key = json.dumps([cfg.scaler, cfg.first_filter, cfg.second_filter, cfg.learner, cfg.resampler], sort_keys=True, default=str)
        with self._lock:
            lock = self._locks.setdefault(key, threading.Lock())
        with lock:
            if key not in self._ready:
                self._ready[key] = self._fit(cfg)
            return self._ready[key]

    def _fit(self, cfg: PipelineConfig) -> list[tuple]:
        fitted = [FittedPipeline(cfg) for _ in range(self.cv)]
        if cfg.scaler:
            for fp, m, s in zip(fitted, *fold_scalers(self.folded, self.cv)):
                fp.mean, fp.scale = m, s
        parts = [self.folded.where(F.col("fold") != f).drop("fold") for f in range(self.cv)]
        if cfg.first_filter:
            for f, rows in self._filtered(cfg, fitted).items():
                fitted[f]._first_filter(rows)
        out = []
        kept = (lambda d: d.checkpoint(eager=True)) if cfg.second_filter or cfg.learner or cfg.resampler else (lambda d: d)
        for f, fp in enumerate(fitted):
            d = parts[f] if fp.mean is None else fp._scale(parts[f])
            d = d if fp.keep1 is None else take_indices(d, fp.keep1)
            d = kept(fp.fit_rest(d))
            held = kept(fp.transform(self.folded.where(F.col("fold") == f)))
            out.append((fp, d, held, None if self.test is None else kept(fp.transform(self.test))))
        return out

    def _filtered(self, cfg: PipelineConfig, fitted: list[FittedPipeline]) -> dict:
        """Scores of all folds' training parts from one grouped job (folds x features rows)."""
        copies = explode_training_folds(self.folded, self.cv)
        if cfg.scaler:
            means, scales = np.array([fp.mean for fp in fitted]), np.array([fp.scale for fp in fitted])

            @F.pandas_udf("array<double>")
            def scaled(x: pd.Series, fold: pd.Series) -> pd.Series:
                if not len(x):
                    return pd.Series([], dtype=object)
                f = fold.to_numpy()
                return pd.Series(list((np.stack(x.to_list()) - means[f]) / scales[f]))

            copies = copies.withColumn("x", scaled("x", "train_fold"))
        long = copies.select("train_fold", "row_id", "label", F.posexplode("x").alias("feature", "value"))
        found: dict = {}
        for r in filter_features(long, cfg.first_filter, ("train_fold",)).collect():
            found.setdefault(r["train_fold"], []).append(r)
        return found

    def evaluate(self, cfg: PipelineConfig, scoring="accuracy") -> dict:
        """Fit the classifier on every fold; all folds' predictions are scored in one grouped job each."""
        models, held, tested = [], [], []
        for f, (stages, rows, val, test) in enumerate(self.stages(cfg)):
            fp = stages.with_classifier(cfg).fit_model(rows)
            models.append(fp)
            held.append(fp.model.predict(val).select("row_id", "label", "prob", "pred", F.lit(f).alias("fold")))
            if test is not None:
                tested.append(fp.model.predict(test).select("row_id", "label", "prob", "pred", F.lit(f).alias("fold")))
        out = {"val_scores": [], "models": models, "test_metrics": []}
        if callable(scoring):
            out["val_scores"] = [float(scoring(p)) for p in held]
        else:
            _scorer(scoring)
            found = {r["fold"]: r[SCORERS[scoring]] for r in E.score_on_test(_union(held), ["fold"]).collect()}
            out["val_scores"] = [float(found[f]) for f in range(self.cv)]
        if tested:
            found = {r["fold"]: r for r in E.score_on_test(_union(tested), ["fold"]).collect()}
            out["test_metrics"] = [tuple(found[f][c] for c in ("accuracy", "f1", "mcc", "auc")) for f in range(self.cv)]
        return out


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cross_validate(train: DataFrame, cfg: PipelineConfig, cv: int = 10, scoring="accuracy",
                   test: DataFrame | None = None) -> dict:
    """Stratified k-fold: fit on k-1 folds, score the held-out fold; every fold model is kept
    (and, with ``test``, scored on the test set)."""
    _scorer(scoring)
    return FoldInputs(train, cv, test).evaluate(cfg, scoring)


def _metric_rows(spark, name: str, rows) -> DataFrame:
    """``(name_i, val_score, test metrics)`` per fold and their mean row."""
    rows = [(f"{name}_{i}", *[float(x) for x in r]) for i, r in rows]
    mean = np.array([r[1:] for r in rows], dtype=float).mean(axis=0)
    rows.append((f"{name}_mean", *[float(x) for x in mean]))
    return spark.createDataFrame(rows, "name string, val_score double, test_acc double, test_f1 double, "
                                       "test_mcc double, test_auc double")


def search_family(train: DataFrame, test: DataFrame, family: str, n_trials: int = 100, cv: int = 10,
                  scoring="accuracy", direction: str = "maximize", base: dict | None = None,
                  seed: int = 42, tune_components: int | None = None, fixed: dict | None = None,
                  inputs: FoldInputs | None = None, parallel_trials: int = 2, path: str | None = None):
    """Seeded random trials; the best trial's fold models and a metric table
    ``(name, val_score, test_acc, test_f1, test_mcc, test_auc)`` with a ``<family>_mean`` row.

    Trials are work items of a pool of ``parallel_trials`` threads (in the scheduler pool of the family, which
    matters under FAIR scheduling) over ``inputs``, the folds written once, which families can share. ``fixed``:
    parameters that are not drawn. With ``path`` every finished trial is added to a table there, and
    trials that the table has are not run again; only the best one is then fitted once more if need be. Of
    equal trials the first one is best, whatever the order in which they end.
    """
    spark = train.sparkSession
    inputs = inputs or FoldInputs(train, cv, test)
    if int(n_trials) < 1:
        raise ValueError("n_trials must be at least 1")

    def config(t):
        kw = dict(base or {})
        if tune_components and kw.get("learner"):
            kw["learner"] = dict(kw["learner"], n_components=random.Random(f"{seed}:nc:{family}:{t}")
                                 .randint(2, int(tune_components)))
        return build_pipeline(family=family, params=MD.draw_params(family, t, seed) | (fixed or {}), **kw)

    table = f"{path}/trials/{family}" if path else None
    done = _finished_trials(spark, table, inputs.cv) if table else {}
    best, lock = [], threading.Lock()

    def consider(t, res):
        value = float(np.mean(res["val_scores"]))
        rank = (-value if direction == "maximize" else value, t)
        with lock:
            if not best or rank < best[0]:
                best[:] = [rank, t, res]

    def trial(t):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", family)
        res = inputs.evaluate(config(t), scoring)
        if table:
            rows = [(t, f, float(v), *map(float, m)) for f, (v, m) in enumerate(zip(res["val_scores"], res["test_metrics"]))]
            with lock:
                spark.createDataFrame(rows, TRIAL_SCHEMA).coalesce(1).write.mode("append").parquet(table)
        consider(t, res)

    for t, res in done.items():
        if t < int(n_trials):
            consider(t, res)
    with ThreadPoolExecutor(max_workers=max(1, int(parallel_trials))) as pool:
        list(pool.map(trial, [t for t in range(int(n_trials)) if t not in done]))
    _, t, res = best
    cfg = config(t)
    if not res["models"]:
        res = inputs.evaluate(cfg, scoring)
    rows = enumerate((v, *tm) for v, tm in zip(res["val_scores"], res["test_metrics"]))
    return _metric_rows(spark, family, rows), res["models"], cfg


TRIAL_SCHEMA = "trial int, fold int, val_score double, test_acc double, test_f1 double, test_mcc double, test_auc double"


def _finished_trials(spark, table: str, cv: int) -> dict:
    """Trials whose folds are all in the table, without their models."""
    from pyspark.errors import AnalysisException
    try:
        rows = spark.read.schema(TRIAL_SCHEMA).parquet(table).collect()  # trials x folds rows
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    found: dict = {}
    for r in rows:
        found.setdefault(r["trial"], {})[r["fold"]] = r
    return {t: {"val_scores": [by[f]["val_score"] for f in range(cv)], "models": [],
                "test_metrics": [tuple(by[f][c] for c in ("test_acc", "test_f1", "test_mcc", "test_auc")) for f in range(cv)]}
            for t, by in found.items() if set(by) == set(range(cv))}


def train_all_families(train: DataFrame, test: DataFrame, families=MD.FAMILIES, parallel: int = 3,
                       fixed: dict | None = None, cv: int = 10, **kw):
    """Every family; metric tables unioned in the given order, models by family.

    Families are searched side by side in at most ``parallel`` threads, over folds and fitted stages written once
    for all of them. ``fixed``: per family, parameters that are not drawn."""
    inputs = FoldInputs(train, cv, test)

    def one(family):
        return search_family(train, test, family, cv=cv, fixed=(fixed or {}).get(family), inputs=inputs, **kw)

    with ThreadPoolExecutor(max_workers=max(1, int(parallel))) as pool:
        found = list(pool.map(one, families))
    return _union([t for t, _, _ in found]), {family: ms for family, (_, ms, _) in zip(families, found)}


# ------------------------------------------------------------ ensembles
def vote_soft_models(models: list[FittedPipeline], test: DataFrame, weights: list[float] | None = None) -> DataFrame:
    """Weighted mean of class-1 probabilities of the given fitted pipelines on ``test``."""
    preds = None
    for i, m in enumerate(models):
        p = m.predict(test).select("row_id", "label", "prob").withColumn("model", F.lit(i))
        preds = p if preds is None else preds.unionByName(p)
    w = {i: (weights[i] if weights else 1.0) for i in range(len(models))}
    return E.vote_soft(preds, w)


def fold_predictions(train: DataFrame, test: DataFrame, cfgs: list[PipelineConfig], cv: int = 10):
    """``(row_id, label, prob, model, fold)`` of the held-out fold and of ``test``, for every base
    pipeline and fold. Each pipeline is fitted once per fold; the two tables are written once, so
    whatever reads them later fits nothing again."""
    inputs, parts = FoldInputs(train, cv, test), ([], [])
    for i, cfg in enumerate(cfgs):
        for f, (stages, rows, *sides) in enumerate(inputs.stages(cfg)):
            model = stages.with_classifier(cfg).fit_model(rows).model
            for out, side in zip(parts, sides):
                out.append(model.predict(side).select("row_id", "label", "prob", F.lit(i).alias("model"), F.lit(f).alias("fold"))
                           .checkpoint(eager=True))
    return _union(parts[0]), _union(parts[1])


def vote_train(train: DataFrame, test: DataFrame, cfgs: list[PipelineConfig], n_trials: int = 100, cv: int = 10,
               scoring: str = "accuracy", direction: str = "maximize", seed: int = 42):
    """Soft voting with searched weights: ``(metric table named voting, best weights)``.

    A trial draws a weight of 1 to 100 for every base pipeline; its score is the mean over folds of
    the weighted vote on the held-out rows. The base pipelines are refitted per fold, once for all
    trials, and the best weights are scored on ``test`` with every fold's models."""
    if scoring not in SCORERS:
        raise ValueError(f"unknown scoring {scoring!r}")
    spark = train.sparkSession
    val, tst = fold_predictions(train, test, cfgs, cv)
    drawn = [[random.Random(f"{seed}:vote:{t}:{i}").randint(1, 100) for i in range(len(cfgs))] for t in range(int(n_trials))]
    weights = spark.createDataFrame([(t, i, float(w)) for t, ws in enumerate(drawn) for i, w in enumerate(ws)],
                                    "trial int, model int, weight double")

    def vote(preds, table):
        w = preds.join(bounded(table, 1_000_000), "model")
        return w.groupBy("trial", "fold", "row_id").agg(
            F.first("label").alias("label"), (F.sum(F.col("weight") * F.col("prob")) / F.sum("weight")).alias("prob"))

    column = SCORERS[scoring]
    scores = E.score_on_test(vote(val, weights), ["trial", "fold"]).select("trial", "fold", column).collect()
    mean = {}
    for r in scores:  # trials x folds rows
        mean.setdefault(r["trial"], []).append(r[column])
    order = max if direction == "maximize" else min
    best = order(sorted(mean), key=lambda t: float(np.mean(mean[t])))
    value = {r["fold"]: r[column] for r in scores if r["trial"] == best}
    metrics = E.score_on_test(vote(tst, weights.where(F.col("trial") == best)), ["fold"]).collect()
    rows = [(m["fold"], (value[m["fold"]], m["accuracy"], m["f1"], m["mcc"], m["auc"]))
            for m in sorted(metrics, key=lambda m: m["fold"])]
    return _metric_rows(spark, "voting", rows), drawn[best]


def stack_oof(train: DataFrame, test: DataFrame, cfgs: list[PipelineConfig], cv: int = 10):
    """Out-of-fold class-1 probabilities of each base pipeline (train) and the fold-mean (test)."""
    val, tst = fold_predictions(train, test, cfgs, cv)
    models = list(range(len(cfgs)))
    return E.stack_oof(val, models).checkpoint(eager=True), E.stack_oof(tst, models).checkpoint(eager=True)


def stack_train(train: DataFrame, test: DataFrame, cfgs: list[PipelineConfig], cv: int = 10,
                keep_original: bool = False, families=MD.FAMILIES, top_n: int = 20, save_features: int = 20,
                learner: dict | None = None, tune_components: int | None = None, path: str | None = None, **kw):
    """Retrain families on the stacked table of the base pipelines (MI k-best, no scaling or resampling).

    ``learner`` and ``tune_components`` go to the search; with ``path`` the stacked table is written
    there with its train / test tag."""
    if top_n < save_features:
        raise ValueError("top_n must be at least save_features")
    mtr, mte = stack_oof(train, test, cfgs[:top_n], cv)
    if path:
        from cohortml.sources.files import write_table
        write_table(mtr.withColumn("is_test", F.lit(0)).unionByName(mte.withColumn("is_test", F.lit(1))), path)
    meta_cols = [c for c in mtr.columns if c.startswith("metafeature_")]
    def pack(m, orig):  # noqa: E306
        x = F.array(*[F.col(c) for c in meta_cols])
        if keep_original:
            m = m.join(orig.select("row_id", F.col("x").alias("_ox")), "row_id", "inner")
            x = F.concat(x, F.col("_ox"))
        return m.select("row_id", x.alias("x"), "label")
    tr, te = pack(mtr, train), pack(mte, test)
    k = min(len(meta_cols), save_features)
    base = {"scaler": False, "first_filter": {"function": "mutual_info_classif", "mode": "k_best", "param": k}}
    if learner:
        base["learner"] = learner
    return train_all_families(tr, te, families, base=base, cv=cv, tune_components=tune_components, **kw)


def run_auto(train: DataFrame, test: DataFrame, families=MD.FAMILIES, n_trials: int = 100, cv: int = 10,
             ensemble: bool = False, stack: bool = False, top_n: int = 5, stack_top_n: int = 20,
             vote_trials: int = 100, path: str | None = None, **kw):
    """Train every family; optionally vote with the ``top_n`` best models and stack the ``stack_top_n`` best.

    Returns ``metrics`` (with the voting rows), ``models``, and for the options ``vote`` (test
    probabilities), ``weights``, ``stack`` (metrics) and ``stack_models``. With ``path`` the metric
    tables, the table of trials, the stacked table, the fold models of all families and a manifest of the best ones are
    written there; a call that was cut short goes on from the table of trials."""
    metrics, models = train_all_families(train, test, families, n_trials=n_trials, cv=cv, path=path, **kw)
    metrics = metrics.checkpoint(eager=True)
    ranked = [(r["name"], models[r["family"]][int(r["index"])])
              for r in E.top_n_models(metrics, max(top_n, stack_top_n)).collect()]
    out = {"metrics": metrics, "models": models}
    scoring = {k: kw[k] for k in ("scoring", "direction", "seed") if k in kw}
    if ensemble:
        chosen = [m for _, m in ranked[:top_n]]
        table, weights = vote_train(train, test, [m.cfg for m in chosen], vote_trials, cv, **scoring)
        out["weights"], out["vote"] = weights, vote_soft_models(chosen, test, weights)
        out["metrics"] = metrics.unionByName(table)
    if stack:
        cfgs = [m.cfg for _, m in ranked[:stack_top_n]]
        out["stack"], out["stack_models"] = stack_train(
            train, test, cfgs, cv, families=families, top_n=max(stack_top_n, len(cfgs)),
            save_features=min(stack_top_n, len(cfgs)), n_trials=n_trials, path=f"{path}/stacked" if path else None,
            **{k: v for k, v in kw.items() if k in ("scoring", "direction", "seed", "fixed", "parallel")})
    if path:
        from cohortml.sources.files import save_model, write_manifest, write_metrics
        write_metrics([out["metrics"]], f"{path}/metrics")
        if stack:
            write_metrics([out["stack"]], f"{path}/stack_metrics")
        saved = {f"{family}_{f}": save_model(m, f"{path}/models/{family}_{f}") for family, ms in models.items() for f, m in enumerate(ms)}
        chosen = [name for name, _ in ranked[:top_n]]
        write_manifest(train.sparkSession, {name: saved[name] for name in chosen}, f"{path}/manifest")
    return out
