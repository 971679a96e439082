"""Registered queries: classifier families, embedded selectors, projections, pipeline and search.

Fixture: ``embeddings`` with the binary label, split 80/20 by the stratified
hash split. These are fitted models, checked by rows/schema here and by
property tests (each family beats the majority rate) in ``tests/``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortml.operators import folds
from cohortml.operators import models as MD
from cohortml.operators import select as S
from cohortml.plans import pipeline as P
from cohortml.queries import register
from cohortml.sources import tables as T


def split_vectors(spark, sf):
    e = T.read_table(spark, sf, "embeddings")
    v = e.select(F.col("vec_id").alias("row_id"), F.transform("embedding", lambda x: x.cast("double")).alias("x"),
                 (F.col("label") < 3).cast("int").alias("label"))
    s = folds.stratified_split(v)
    return s.where("split = 'train'").drop("split"), s.where("split = 'test'").drop("split")


def _family_query(family, params):
    def q(spark, sf):
        tr, te = split_vectors(spark, sf)
        fp = P.FittedPipeline(P.build_pipeline(family=family, params=params)).fit(tr)
        return fp.predict(te).select("row_id", "label", "prob", "pred")
    return q


FAMILY_PARAMS = {
    "fam_logistic": ("logistic", {"C": 0.5, "l1_ratio": 0.5}),
    "fam_svc": ("svc", {"C": 0.5, "kernel": "rbf"}),
    "fam_rf": ("rf", {"n_estimators": 50, "max_depth": 4, "min_samples_leaf": 5, "max_samples": 0.8}),
    "fam_mlp": ("mlp", {"hidden": (8,), "learning_rate": 0.03, "batch_size": 32}),
    "fam_et": ("et", {"n_estimators": 50, "max_depth": 4, "min_samples_leaf": 5}),
    "fam_ada": ("ada", {"n_estimators": 50, "learning_rate": 0.1}),
    "fam_gdbt": ("gdbt", {"n_estimators": 50, "learning_rate": 0.1, "max_depth": 3}),
    "fam_xgboost": ("xgboost", {"n_estimators": 50, "max_depth": 3, "learning_rate": 0.1}),
}
for _name, (_fam, _params) in FAMILY_PARAMS.items():
    register(_name)(_family_query(_fam, _params))


def _embed_query(method, **kw):
    def q(spark, sf):
        tr, _ = split_vectors(spark, sf)
        imp = P.embedded_importances(tr, method, **kw)
        return S.threshold_select(MD.importance_table(tr, imp), "mean")
    return q


for _name, (_m, _kw) in {"embed_l1_logistic": ("l1_logistic", {"C": 0.5}),
                          "embed_l1_svc": ("l1_svc", {"C": 0.5}),
                          "embed_rf": ("rf", {"n_estimators": 100}),
                          "embed_ada": ("ada", {"n_estimators": 50}),
                          "embed_xgb": ("xgb", {"n_estimators": 50, "max_depth": 3})}.items():
    register(_name)(_embed_query(_m, **_kw))


@register("embed_importance_report")
def q_embed_importance_report(spark, sf):
    tr, _ = split_vectors(spark, sf)
    imp = MD.embed_l1_logistic(tr, 0.5)
    sel = S.threshold_select(MD.importance_table(tr, imp), "1.25*mean")
    return sel.where("selected").select(F.col("feature").alias("feature_name"), F.col("importance")
                                        .alias("feature_importance"))


@register("learn_pca")
def q_learn_pca(spark, sf):
    from cohortml.operators.project import fit_pca
    tr, _ = split_vectors(spark, sf)
    p = fit_pca(tr, 5)
    return p.transform(tr).select("row_id", "label", F.posexplode("x").alias("component", "value"))


@register("pca_loadings")
def q_pca_loadings(spark, sf):
    from cohortml.operators.project import fit_pca
    tr, _ = split_vectors(spark, sf)
    return fit_pca(tr, 5).loadings(spark)


@register("learn_kpca")
def q_learn_kpca(spark, sf):
    from cohortml.operators.project import fit_kernel_pca
    tr, _ = split_vectors(spark, sf)
    return fit_kernel_pca(tr, 5, "rbf").transform(tr).select("row_id", "label", F.posexplode("x").alias("component", "value"))


@register("kpca_coords")
def q_kpca_coords(spark, sf):
    from cohortml.operators.project import fit_kernel_pca
    tr, te = split_vectors(spark, sf)
    p = fit_kernel_pca(tr, 2, "rbf")
    return p.transform(te).select("row_id", "label", F.col("x")[0].alias("c1"), F.col("x")[1].alias("c2"))


@register("projection_report")
def q_projection_report(spark, sf):
    """Both projections of the features that pass a univariate and an embedded filter."""
    from cohortml.plans.reports import projection_report
    tr, te = split_vectors(spark, sf)
    fp = P.FittedPipeline(P.build_pipeline(
        family="logistic", params={"C": 0.5}, first_filter={"function": "kruskal", "mode": "k_best", "param": 20},
        second_filter={"method": "l1_logistic", "threshold": "mean"})).fit(tr)
    return projection_report(tr.unionByName(te), fp.selected(64))


FULL = dict(family="logistic", params={"C": 0.5, "l1_ratio": 0.5},
            first_filter={"function": "kruskal", "mode": "pvalue", "param": 0.5},
            second_filter={"method": "l1_logistic", "threshold": "mean", "C": 1.0},
            learner={"type": "pca", "n_components": 4}, resampler="smote")


@register("build_pipeline")
def q_build_pipeline(spark, sf):
    tr, te = split_vectors(spark, sf)
    return P.FittedPipeline(P.build_pipeline(**FULL)).fit(tr).predict(te)


@register("cross_validate")
def q_cross_validate(spark, sf):
    tr, te = split_vectors(spark, sf)
    res = P.cross_validate(tr, P.build_pipeline(family="logistic", params={"C": 0.5}), scoring="accuracy", test=te)
    rows = [(i, v, *m) for i, (v, m) in enumerate(zip(res["val_scores"], res["test_metrics"]))]
    return spark.createDataFrame(rows, "fold int, val_score double, test_acc double, test_f1 double, "
                                       "test_mcc double, test_auc double")


@register("search_family")
def q_search_family(spark, sf):
    tr, te = split_vectors(spark, sf)
    table, _, _ = P.search_family(tr, te, "logistic", n_trials=10)
    return table


#: The lowest ensemble sizes of the search ranges. The queries below also pass one trial and two or
#: three folds (defaults: 100 and 10): another trial could be the best one, so their result is that of a smaller search.
SMALLEST = {f: {"n_estimators": 50} for f in ("rf", "et", "ada", "gdbt", "xgboost")}


@register("train_all_families")
def q_train_all_families(spark, sf):
    tr, te = split_vectors(spark, sf)
    table, _ = P.train_all_families(tr, te, n_trials=1, cv=2, fixed=SMALLEST)
    return table


@register("stack_train")
def q_stack_train(spark, sf):
    tr, te = split_vectors(spark, sf)
    cfgs = [P.build_pipeline(family="logistic", params={"C": 0.5}),
            P.build_pipeline(family="knn", params={"k": 5}),
            P.build_pipeline(family="rf", params={"n_estimators": 50})]
    table, _ = P.stack_train(tr, te, cfgs, cv=3, families=("logistic", "gdbt", "mlp"), n_trials=1, fixed=SMALLEST)
    return table


@register("run_auto")
def q_run_auto(spark, sf):
    tr, te = split_vectors(spark, sf)
    out = P.run_auto(tr, te, families=("logistic", "rf", "knn"), n_trials=1, cv=2, ensemble=True, stack=True, top_n=3,
                     stack_top_n=3, vote_trials=20, fixed=SMALLEST)
    return out["metrics"].unionByName(out["stack"].withColumn("name", F.concat(F.lit("stack_"), F.col("name"))))
