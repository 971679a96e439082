"""Registered queries: file sources and sinks (round trips through shared storage),
model persistence, and the small set operators of the feature reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortml.operators import evaluate as E
from cohortml.operators import folds
from cohortml.operators import select as S
from cohortml.operators import univariate as U
from cohortml.plans.q_univariate import KS, TB, binary, kruskal_scores
from cohortml.queries import register
from cohortml.sources import files as FS
from cohortml.sources import tables as T

M, LB = T.MATRIX_LONG_SQL, T.LABEL_BINARY_SQL
CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@register("src_csv", rounded=("c_acctbal",), sql="""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def q_src_csv(spark, sf):
    path = FS.scratch_path(spark, "customer-csv")
    FS.write_table(T.read_table(spark, sf, "customer"), path, fmt="csv")
    return FS.read_csv(spark, path, CUSTOMER_SCHEMA, key="c_custkey")


@register("src_matrix_csv", rounded=("value",), sql=f"""
SELECT 's' || CAST(row_id AS VARCHAR) AS sample, 'f' || CAST(feature AS VARCHAR) AS feature,
       ln(1 + abs(value)) AS value FROM {M} _m""")
def q_src_matrix_csv(spark, sf):
    # a feature x sample file: one row per feature, one column per sample
    long = T.matrix_long(spark, sf).select(F.concat(F.lit("s"), F.col("row_id").cast("string")).alias("sample"),
                                          F.concat(F.lit("f"), F.col("feature").cast("string")).alias("feature"),
                                          F.abs("value").alias("value"))
    path = FS.scratch_path(spark, "matrix-csv")
    FS.write_matrix_csv(long, path)
    return FS.read_matrix_csv(spark, path)


@register("sink_table", sql=f"SELECT row_id, label FROM {folds.split_sql(LB)} _s WHERE split = 'train'")
def q_sink_table(spark, sf):
    s = folds.stratified_split(T.label_binary(spark, sf))
    path = FS.scratch_path(spark, "trainset")
    FS.write_table(s.where("split = 'train'").select("row_id", "label"), path)
    return spark.read.parquet(path)


@register("sink_features", rounded=("score", "pvalue"), sql=f"""
SELECT feature AS feature_name, score, pvalue FROM {KS} s WHERE pvalue <= 0.05""")
def q_sink_features(spark, sf):
    rep = S.univariate_report(S.select_pvalue(kruskal_scores(spark, sf), 0.05, "kruskal"))
    path = FS.scratch_path(spark, "first-filter")
    FS.write_table(rep, path, fmt="csv")
    return FS.read_csv(spark, path, "feature_name int, score double, pvalue double")


#: One pipeline per family, and one per learner and kernel.
SAVED = {
    "logistic": ("logistic", {"C": 0.5}, None), "svc_rbf": ("svc", {"C": 0.5, "kernel": "rbf"}, None),
    "rf": ("rf", {"n_estimators": 50}, None), "mlp": ("mlp", {}, None), "xgboost": ("xgboost", {"n_estimators": 3}, None),
    "et": ("et", {"n_estimators": 50}, None), "ada": ("ada", {"n_estimators": 3}, None),
    "gdbt": ("gdbt", {"n_estimators": 5}, None), "knn": ("knn", {"k": 5}, None),
    "pca": ("logistic", {}, {"type": "pca", "n_components": 5}),
    "kpca_rbf": ("logistic", {}, {"type": "kpca", "kernel": "rbf", "n_components": 3}),
    "symbolic": ("logistic", {}, {"type": "symbolic", "n_components": 2, "population": 20, "generations": 1}),
}


@register("model_save_load", sql="SELECT * FROM (VALUES " + ", ".join(f"('{n}', TRUE)" for n in sorted(SAVED))
          + ") t(name, same)")
def q_model_save_load(spark, sf):
    """Does every kind of pipeline predict the same before and after, for every test row?"""
    from cohortml.plans import pipeline as P
    from cohortml.plans.q_models import split_vectors
    tr, te = split_vectors(spark, sf)
    tr, te = tr.checkpoint(eager=True), te.checkpoint(eager=True)
    out = None
    for name, (family, params, learner) in SAVED.items():
        fp = P.FittedPipeline(P.build_pipeline(family=family, params=params, learner=learner)).fit(tr)
        path = FS.scratch_path(spark, f"model-{name}")
        FS.save_model(fp, path)
        before = fp.predict(te).select("row_id", "prob")
        after = FS.load_model(spark, path).predict(te).select("row_id", F.col("prob").alias("again"))
        part = (before.join(after, "row_id", "full").agg(F.bool_and(F.coalesce(
            F.abs(F.col("prob") - F.col("again")) < 1e-9, F.lit(False))).alias("same")).select(F.lit(name).alias("name"), "same"))
        out = part if out is None else out.unionByName(part)
    return out


@register("model_manifest", sql="""
SELECT name, name AS path, CAST((SELECT sum(round(0.2 * c)) FROM (SELECT count(*) AS c FROM embeddings GROUP BY label < 3) q)
       AS BIGINT) AS predicted
  FROM (VALUES ('knn_0'), ('logistic_0'), ('logistic_1')) t(name)""")
def q_model_manifest(spark, sf):
    """Fold models written, listed in a manifest with paths below its folder, and loaded from there."""
    from cohortml.plans import pipeline as P
    from cohortml.plans.q_models import split_vectors
    tr, te = split_vectors(spark, sf)
    root = FS.scratch_path(spark, "models")
    for name, params in (("logistic_0", {"C": 0.5}), ("logistic_1", {"C": 0.1}), ("knn_0", {"k": 5})):
        fp = P.FittedPipeline(P.build_pipeline(family=name.split("_")[0], params=params)).fit(tr)
        FS.save_model(fp, f"{root}/{name}")
    path = FS.scratch_path(spark, "manifest")
    FS.write_manifest(spark, {name: name for name in ("logistic_0", "logistic_1", "knn_0")}, path)
    listed = spark.read.schema("name string, path string").json(path).collect()
    return spark.createDataFrame([(r["name"], r["path"], FS.load_model(spark, f"{root}/{r['path']}").predict(te).count()) for r in listed],
                                 "name string, path string, predicted long")


@register("concat_rows", sql=f"""
SELECT row_id, label, 'train' AS split FROM {folds.split_sql(LB)} a WHERE split = 'train'
UNION ALL SELECT row_id, label, 'test' FROM {folds.split_sql(LB)} b WHERE split = 'test'""")
def q_concat_rows(spark, sf):
    s = folds.stratified_split(T.label_binary(spark, sf))
    tr = s.where("split = 'train'").select("row_id", "label").withColumn("split", F.lit("train"))
    te = s.where("split = 'test'").select("row_id", "label").withColumn("split", F.lit("test"))
    return tr.unionByName(te)


@register("filter_selected_names", rounded=("score", "pvalue"), sql=f"""
SELECT feature, score, pvalue FROM {KS} s
 WHERE feature IN (SELECT feature FROM (SELECT feature, row_number() OVER (ORDER BY score DESC, feature DESC) AS rn
                                          FROM {KS} s2) _r WHERE rn <= 10)""")
def q_filter_selected_names(spark, sf):
    sc = kruskal_scores(spark, sf)
    names = S.select_k_best(sc, 10).where("selected").select("feature")
    return sc.join(names, "feature", "left_semi")


@register("project_features", rounded=("value",), sql=f"""
SELECT row_id, feature, value FROM {M} m WHERE feature IN (SELECT feature FROM {KS} s WHERE pvalue <= 0.05)""")
def q_project_features(spark, sf):
    names = S.univariate_report(S.select_pvalue(kruskal_scores(spark, sf), 0.05, "kruskal")) \
        .select(F.col("feature_name").alias("feature"))
    return T.matrix_long(spark, sf).join(names, "feature", "left_semi")


@register("sort_importance", rounded=("importance",), sql=f"""
WITH i AS (SELECT feature, corr(value, CAST(label AS DOUBLE)) AS importance FROM {TB} t GROUP BY feature)
SELECT feature, importance, CAST(row_number() OVER (ORDER BY abs(importance) DESC, feature) AS INTEGER) AS rank
  FROM i ORDER BY rank LIMIT 20""")
def q_sort_importance(spark, sf):
    from pyspark.sql import Window
    imp = U.correlation(binary(spark, sf)).select("feature", F.col("r").alias("importance"))
    w = Window.orderBy(F.abs("importance").desc(), F.col("feature"))  # one row per feature
    return imp.withColumn("rank", F.row_number().over(w)).where("rank <= 20")
