"""Registered queries: HSIC Lasso, symbolic features, and the report drivers."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortml.operators import models as MD
from cohortml.operators.hsic import hsic_importances
from cohortml.operators.symbolic import learn_symbolic
from cohortml.plans import pipeline as P
from cohortml.plans.q_models import split_vectors
from cohortml.plans.reports import one_table, retrieve_features, visual_report
from cohortml.queries import register


@register("embed_hsic")
def q_embed_hsic(spark, sf):
    tr, _ = split_vectors(spark, sf)
    imp = hsic_importances(tr, num_feat=10, B=20, M=2)
    return MD.importance_table(tr, imp).withColumn("selected", F.col("importance") > 0)


@register("embed_hsic_regression")
def q_embed_hsic_regression(spark, sf):
    tr, _ = split_vectors(spark, sf)
    # regression target: the first embedding coordinate, explained by the others
    reg = tr.select("row_id", F.slice("x", 2, 1000).alias("x"), F.col("x")[0].alias("label"))
    imp = hsic_importances(reg, num_feat=5, B=20, M=1, mode="regression")
    return MD.importance_table(reg, imp).withColumn("selected", F.col("importance") > 0)


@register("learn_symbolic")
def q_learn_symbolic(spark, sf):
    tr, te = split_vectors(spark, sf)
    sym = learn_symbolic(tr, n_components=3, seed=42)
    return sym.transform(te).select("row_id", "label", F.posexplode("x").alias("component", "value"))


@register("symbolic_report")
def q_symbolic_report(spark, sf):
    tr, _ = split_vectors(spark, sf)
    sym = learn_symbolic(tr, n_components=3, seed=42)
    return sym.report(spark, [f"emb_{i}" for i in range(64)])


def _fitted(spark, sf):
    tr, te = split_vectors(spark, sf)
    cfg = P.build_pipeline(family="logistic", params={"C": 0.5, "l1_ratio": 0.5},
                           first_filter={"function": "kruskal", "mode": "k_best", "param": 20},
                           second_filter={"method": "l1_logistic", "threshold": "mean"})
    return P.FittedPipeline(cfg).fit(tr), tr, te


@register("retrieve_features")
def q_retrieve_features(spark, sf):
    fp, tr, te = _fitted(spark, sf)
    return one_table(retrieve_features(fp, tr, te))


@register("visual_report")
def q_visual_report(spark, sf):
    fp, tr, te = _fitted(spark, sf)
    return one_table(visual_report(fp, tr, te))


@register("shap_permutation")
def q_shap_permutation(spark, sf):
    from cohortml.operators.explain import permutation_attributions
    tr, te = split_vectors(spark, sf)
    fp = P.FittedPipeline(P.build_pipeline(family="gdbt", params={"n_estimators": 10, "max_depth": 3})).fit(tr)
    return permutation_attributions(fp.predict, te, tr)
