"""Registered queries: sources, column handling, split, folds, imputation, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortml.functions.hashing import sql_hash_int
from cohortml.operators import folds, prep
from cohortml.queries import register
from cohortml.sources import tables as T

M, LB, L5, CL = T.MATRIX_LONG_SQL, T.LABEL_BINARY_SQL, T.LABEL_FIVE_SQL, T.CLINICAL_SQL


@register("src_matrix_long", sql=f"SELECT row_id, feature, value FROM {M} _m", rounded=("value",))
def q_src_matrix_long(spark, sf):
    return T.matrix_long(spark, sf)


@register("log1p", rounded=("value",),
          sql=f"SELECT label, feature, ln(1 + value) AS value FROM {T.NONNEG_MATRIX_SQL} _n")
def q_log1p(spark, sf):
    return prep.log1p(T.nonneg_matrix(spark, sf)).select("label", "feature", "value")


@register("inner_join_key", rounded=("acctbal",),
          sql=f"SELECT c.row_id, c.acctbal, c.segment, l.label FROM {CL} c JOIN {LB} l ON c.row_id = l.row_id")
def q_inner_join_key(spark, sf):
    return T.clinical(spark, sf).join(T.label_binary(spark, sf), "row_id", "inner")


@register("drop_columns", sql=f"SELECT row_id, label FROM {CL} c JOIN {LB} l USING (row_id)")
def q_drop_columns(spark, sf):
    j = T.clinical(spark, sf).join(T.label_binary(spark, sf), "row_id", "inner")
    return prep.drop_columns(j, ["acctbal", "segment", "label"], label="label")


@register("cast_label", sql=f"SELECT row_id, CAST(acctbal > 0 AS INTEGER) AS label FROM {CL} c")
def q_cast_label(spark, sf):
    c = T.clinical(spark, sf).select("row_id", (F.col("acctbal") > 0).alias("label"))
    return prep.cast_label(c, None, "label")


@register("split_xy", rounded=("acctbal",),
          sql=f"SELECT row_id, acctbal FROM {CL} c JOIN {LB} l USING (row_id)")
def q_split_xy(spark, sf):
    j = T.clinical(spark, sf).join(T.label_binary(spark, sf), "row_id").drop("segment")
    x, _y = prep.split_xy(j, "label")
    return x


@register("stratified_split", sql=f"SELECT row_id, label, split FROM {folds.split_sql(LB)} _s")
def q_stratified_split(spark, sf):
    return folds.stratified_split(T.label_binary(spark, sf)).select("row_id", "label", "split")


@register("stratified_kfold", sql=f"SELECT row_id, label, fold FROM {folds.kfold_sql(L5, 10)} _k")
def q_stratified_kfold(spark, sf):
    return folds.stratified_kfold(T.label_five(spark, sf), 10).select("row_id", "label", "fold")


@register("impute_median", rounded=("acctbal",), sql=f"""
SELECT row_id, coalesce(acctbal, (SELECT quantile_cont(acctbal, 0.5) FROM {CL} c0)) AS acctbal, segment
  FROM {CL} c""")
def q_impute_median(spark, sf):
    return prep.impute_median(T.clinical(spark, sf), ["acctbal"])


@register("impute_mode", rounded=("acctbal",), sql=f"""
SELECT row_id, acctbal, coalesce(segment, (SELECT segment FROM (
    SELECT segment, count(*) AS c FROM {CL} c0 WHERE segment IS NOT NULL
     GROUP BY segment ORDER BY c DESC, segment LIMIT 1) _m)) AS segment
  FROM {CL} c""")
def q_impute_mode(spark, sf):
    return prep.impute_mode(T.clinical(spark, sf), ["segment"])


@register("impute_pass", rounded=("acctbal",), sql=f"""
SELECT coalesce(acctbal, (SELECT quantile_cont(acctbal, 0.5) FROM {CL} c0)) AS acctbal,
       coalesce(segment, (SELECT segment FROM (
    SELECT segment, count(*) AS c FROM {CL} c0 WHERE segment IS NOT NULL
     GROUP BY segment ORDER BY c DESC, segment LIMIT 1) _m)) AS segment
  FROM {CL} c""")
def q_impute_pass(spark, sf):
    return prep.impute(T.clinical(spark, sf), ["acctbal"], ["segment"])


_TRAIN_IDS = f"(SELECT row_id FROM {folds.split_sql(LB)} _s WHERE split = 'train')"


@register("standard_scale", rounded=("value",), sql=f"""
WITH m AS (SELECT * FROM {M} _m),
st AS (SELECT feature, avg(value) AS mean,
              CASE WHEN stddev_pop(value) = 0 OR stddev_pop(value) IS NULL THEN 1.0
                   ELSE stddev_pop(value) END AS scale
         FROM m WHERE row_id IN {_TRAIN_IDS} GROUP BY feature)
SELECT m.row_id, m.feature, (m.value - st.mean) / st.scale AS value FROM m JOIN st USING (feature)""")
def q_standard_scale(spark, sf):
    long = T.matrix_long(spark, sf)
    train = folds.stratified_split(T.label_binary(spark, sf)).where("split = 'train'").select("row_id")
    fit = long.join(train, "row_id", "left_semi")
    return prep.standard_scale(long, fit).select("row_id", "feature", "value")


@register("balanced_weights", rounded=("weight",), sql=f"""
WITH l AS (SELECT * FROM {LB} _l), c AS (SELECT label, count(*) AS n_c FROM l GROUP BY label)
SELECT l.row_id, l.label, (SELECT count(*) FROM l) / ((SELECT count(*) FROM c) * c.n_c) AS weight
  FROM l JOIN c USING (label)""")
def q_balanced_weights(spark, sf):
    return prep.balanced_weights(T.label_binary(spark, sf)).select("row_id", "label", "weight")


@register("explain_sample", sql=f"""
SELECT row_id, label FROM {LB} _l ORDER BY {sql_hash_int(42, 'row_id')}, row_id LIMIT 30""")
def q_explain_sample(spark, sf):
    return prep.explain_sample(T.label_binary(spark, sf), 30)
