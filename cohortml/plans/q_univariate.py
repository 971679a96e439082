"""Registered queries: univariate scores, p-values and selectors (LONG layout)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from cohortml.functions.special import sql_digamma_int
from cohortml.operators import select as S
from cohortml.operators import univariate as U
from cohortml.queries import register
from cohortml.sources import tables as T

M, LB, L5, NM = T.MATRIX_LONG_SQL, T.LABEL_BINARY_SQL, T.LABEL_FIVE_SQL, T.NONNEG_MATRIX_SQL
SCORE_COLS = ("score",)
P_COLS = ("score", "pvalue")


def five(spark, sf):
    return T.labelled_long(spark, sf, T.label_five(spark, sf))


def binary(spark, sf):
    return T.labelled_long(spark, sf, T.label_binary(spark, sf))


T5 = f"(SELECT m.row_id, m.feature, m.value, l.label FROM {M} m JOIN {L5} l USING (row_id))"
TB = f"(SELECT m.row_id, m.feature, m.value, l.label FROM {M} m JOIN {LB} l USING (row_id))"


# ------------------------------------------------------------ scores
PEARSON_SQL = f"""
SELECT feature, count(*) AS n,
       CASE WHEN min(value) = max(value) THEN 0.0 ELSE abs(corr(value, CAST(label AS DOUBLE))) END AS score
  FROM {TB} t GROUP BY feature"""


@register("score_pearson", rounded=SCORE_COLS, sql=PEARSON_SQL)
def q_score_pearson(spark, sf):
    return U.score_pearson(binary(spark, sf), with_pvalue=False).select("feature", "n", "score")


def _t_tail_sql(scores: str) -> str:
    """Two-sided tail of a correlation over an even number of rows: with an even number of degrees of
    freedom the t tail is a finite sum in powers of 1 - r * r."""
    return f"""SELECT feature, n, score, 1 - score * list_sum(list_transform(range(0, (n - 2) // 2),
       lambda j: exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1.0)) * pow(1 - score * score, j))) AS pvalue
  FROM ({scores}) _s"""


@register("pvalue_t", rounded=P_COLS, sql=_t_tail_sql(PEARSON_SQL))
def q_pvalue_t(spark, sf):
    return U.score_pearson(binary(spark, sf)).select("feature", "n", "score", "pvalue")


_MID = ("rank() OVER (PARTITION BY feature ORDER BY {c}) "
        "+ (count(*) OVER (PARTITION BY feature, {c}) - 1) / 2.0")


SPEARMAN_SQL = f"""
WITH r AS (SELECT feature, value, {_MID.format(c='value')} AS rx, {_MID.format(c='label')} AS ry FROM {T5} t)
SELECT feature, count(*) AS n,
       CASE WHEN min(value) = max(value) THEN 0.0 ELSE abs(corr(rx, ry)) END AS score
  FROM r GROUP BY feature"""


@register("score_spearman", rounded=SCORE_COLS, sql=SPEARMAN_SQL)
def q_score_spearman(spark, sf):
    return U.score_spearman(five(spark, sf), with_pvalue=False).select("feature", "n", "score")


@register("pvalue_spearman", rounded=P_COLS, sql=_t_tail_sql(SPEARMAN_SQL))
def q_pvalue_spearman(spark, sf):
    return U.score_spearman(five(spark, sf)).select("feature", "n", "score", "pvalue")


KRUSKAL_SQL = f"""
WITH r AS (SELECT feature, label, value, {_MID.format(c='value')} AS rk,
                  count(*) OVER (PARTITION BY feature, value) AS t FROM {T5} t),
g AS (SELECT feature, label, sum(rk) AS R, count(*) AS ng FROM r GROUP BY feature, label),
h AS (SELECT feature, sum(R * R / ng) AS srn, CAST(sum(ng) AS DOUBLE) AS n, count(*) AS k FROM g GROUP BY feature),
tc AS (SELECT feature, sum(t * t - 1.0) AS ts, min(value) = max(value) AS c FROM r GROUP BY feature),
s AS (SELECT h.feature, h.n, h.k, tc.c,
             (12.0 / (h.n * (h.n + 1)) * h.srn - 3.0 * (h.n + 1)) / (1 - tc.ts / (h.n * h.n * h.n - h.n)) AS H
        FROM h JOIN tc USING (feature))
SELECT feature, CAST(n AS BIGINT) AS n,
       CASE WHEN c OR k < 2 THEN 0.0 ELSE H END AS score,
       CASE WHEN c OR k < 2 THEN 1.0 ELSE exp(-H / 2) * (1 + H / 2) END AS pvalue
  FROM s"""


@register("score_kruskal", rounded=P_COLS, sql=KRUSKAL_SQL)
def q_score_kruskal(spark, sf):
    return U.score_kruskal(five(spark, sf)).select("feature", "n", "score", "pvalue")


def _by_classes(spark, sf, classes):
    """LONG rows labelled ``label % classes``."""
    e = T.read_table(spark, sf, "embeddings")
    return T.labelled_long(spark, sf, e.select(F.col("vec_id").alias("row_id"),
                                               (F.col("label") % classes).cast("int").alias("label")))


def _classes_sql(classes):
    return (f"(SELECT m.*, e.label % {classes} AS label FROM {M} m JOIN embeddings e ON m.row_id = e.vec_id)")


def _chi2_tail_sql(classes):
    # with an even number 2m of degrees of freedom the tail is exp(-H/2) times the first m terms of exp(H/2)
    m = (classes - 1) // 2
    terms = " + ".join(f"pow(score / 2, {i}) / {math.factorial(i)}" for i in range(m))
    return f"""SELECT {classes - 1} AS df, feature, score, exp(-score / 2) * ({terms}) AS pvalue
  FROM (SELECT feature, score FROM ({KRUSKAL_SQL.replace(T5, _classes_sql(classes))}) q) k"""


@register("pvalue_chi2", rounded=("score", "pvalue"), sql=" UNION ALL ".join(_chi2_tail_sql(c) for c in (3, 5, 7)))
def q_pvalue_chi2(spark, sf):
    out = None
    for classes in (3, 5, 7):
        part = U.score_kruskal(_by_classes(spark, sf, classes)).select(
            F.lit(classes - 1).alias("df"), "feature", "score", "pvalue")
        out = part if out is None else out.unionByName(part)
    return out


@register("score_distancecorr", rounded=SCORE_COLS, sql=f"""
WITH t AS (SELECT * FROM {T5} _t),
p AS (SELECT a.feature, a.row_id AS i, abs(a.value - b.value) AS dx,
             abs(CAST(a.label AS DOUBLE) - b.label) AS dy
        FROM t a JOIN t b ON a.feature = b.feature),
rm AS (SELECT feature, i, avg(dx) AS ax, avg(dy) AS ay FROM p GROUP BY feature, i),
s1 AS (SELECT feature, avg(dx * dy) AS mxy, avg(dx * dx) AS mxx, avg(dy * dy) AS myy FROM p GROUP BY feature),
s2 AS (SELECT feature, count(*) AS n, avg(ax * ay) AS mab, avg(ax * ax) AS maa, avg(ay * ay) AS mbb,
              avg(ax) AS ma, avg(ay) AS mb FROM rm GROUP BY feature),
d AS (SELECT feature, n, mxy - 2 * mab + ma * mb AS dcov, mxx - 2 * maa + ma * ma AS dvx,
             myy - 2 * mbb + mb * mb AS dvy FROM s1 JOIN s2 USING (feature))
SELECT feature, CAST(n AS BIGINT) AS n,
       CASE WHEN dvx * dvy > 0 THEN sqrt(greatest(dcov, 0) / sqrt(dvx * dvy)) ELSE 0.0 END AS score
  FROM d""")
def q_score_distancecorr(spark, sf):
    return U.score_distancecorr(five(spark, sf), classes=list(range(5))).select("feature", "n", "score")


F_SQL = f"""
WITH g AS (SELECT feature, label, count(*) AS ng, avg(value) AS mg, var_pop(value) AS vg FROM {NM} t
            GROUP BY feature, label),
tt AS (SELECT feature, avg(value) AS m, count(*) AS n FROM {NM} t GROUP BY feature),
a AS (SELECT g.feature, sum(ng * (mg - m) * (mg - m)) AS ssb, sum(ng * vg) AS ssw,
             any_value(n) AS n, count(*) AS k FROM g JOIN tt USING (feature) GROUP BY g.feature)
SELECT feature, CAST(n AS BIGINT) AS n,
       CASE WHEN ssw = 0 THEN 0.0 ELSE (ssb / (k - 1)) / (ssw / (n - k)) END AS score FROM a"""


@register("score_f_classif", rounded=SCORE_COLS, sql=F_SQL)
def q_score_f_classif(spark, sf):
    return U.score_f_classif(T.nonneg_matrix(spark, sf), with_pvalue=False).select("feature", "n", "score")


# three classes: with two numerator degrees of freedom the F tail is a power
@register("pvalue_f", rounded=P_COLS, sql=f"""
SELECT feature, n, score, pow((n - 3) / (n - 3 + 2 * score), (n - 3) / 2.0) AS pvalue FROM ({F_SQL}) s""")
def q_pvalue_f(spark, sf):
    return U.score_f_classif(T.nonneg_matrix(spark, sf)).select("feature", "n", "score", "pvalue")


@register("score_chi2", rounded=P_COLS, sql=f"""
WITH g AS (SELECT feature, label, sum(value) AS o, count(*) AS nc FROM {NM} t GROUP BY feature, label),
tt AS (SELECT feature, sum(o) AS tot, sum(nc) AS n FROM g GROUP BY feature),
s AS (SELECT g.feature, any_value(tt.n) AS n,
             sum((o - nc / tt.n * tt.tot) * (o - nc / tt.n * tt.tot) / (nc / tt.n * tt.tot)) AS score
        FROM g JOIN tt USING (feature) GROUP BY g.feature)
SELECT feature, CAST(n AS BIGINT) AS n, score, exp(-score / 2) AS pvalue FROM s""")
def q_score_chi2(spark, sf):
    return U.score_chi2(T.nonneg_matrix(spark, sf)).select("feature", "n", "score", "pvalue")


@register("score_f_regression", rounded=SCORE_COLS, sql=f"""
SELECT feature, count(*) AS n,
       corr(value, label) * corr(value, label) / (1 - corr(value, label) * corr(value, label))
         * (count(*) - 2) AS score
  FROM {T5} t GROUP BY feature""")
def q_score_f_regression(spark, sf):
    return U.score_f_regression(five(spark, sf), with_pvalue=False).select("feature", "n", "score")


@register("score_r_regression", rounded=SCORE_COLS, sql=f"""
SELECT feature, count(*) AS n, corr(value, label) AS score FROM {T5} t GROUP BY feature""")
def q_score_r_regression(spark, sf):
    return U.score_r_regression(five(spark, sf)).select("feature", "n", "score")


_INF = "CAST('infinity' AS DOUBLE)"


def _win(a, b):
    """max(x - x_(i-a), x_(i+b) - x) with a missing neighbour making the window invalid."""
    left = "0.0" if a == 0 else f"x - l{a}"
    right = "0.0" if b == 0 else f"r{b} - x"
    nulls = " OR ".join([f"l{a} IS NULL"] * (a > 0) + [f"r{b} IS NULL"] * (b > 0)) or "FALSE"
    return f"CASE WHEN {nulls} THEN {_INF} ELSE greatest({left}, {right}) END"


def _kth(kc):
    return "least(" + ", ".join(_win(j, kc - j) for j in range(kc + 1)) + ")"


@register("score_mutual_info_classif", rounded=SCORE_COLS, sql=f"""
WITH t0 AS (SELECT feature, row_id, label AS y,
                   CASE WHEN stddev_pop(value) OVER (PARTITION BY feature) > 0
                        THEN value / stddev_pop(value) OVER (PARTITION BY feature) ELSE value END AS x
              FROM {T5} _t),
c AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY feature, y) AS nc FROM t0) _c WHERE nc > 1),
w AS (SELECT *, least(3, nc - 1) AS kc,
             lag(x, 1) OVER o AS l1, lag(x, 2) OVER o AS l2, lag(x, 3) OVER o AS l3,
             lead(x, 1) OVER o AS r1, lead(x, 2) OVER o AS r2, lead(x, 3) OVER o AS r3
        FROM c WINDOW o AS (PARTITION BY feature, y ORDER BY x, row_id)),
rad AS (SELECT feature, row_id, x, nc, kc,
               CASE kc WHEN 1 THEN {_kth(1)} WHEN 2 THEN {_kth(2)} ELSE {_kth(3)} END AS r FROM w),
m AS (SELECT a.feature, a.row_id, any_value(a.kc) AS kc, any_value(a.nc) AS nc, count(*) AS m
        FROM rad a JOIN c b ON a.feature = b.feature
         AND ((a.r > 0 AND abs(b.x - a.x) < a.r) OR (a.r = 0 AND b.x = a.x))
       GROUP BY a.feature, a.row_id)
SELECT feature, count(*) AS n,
       greatest(0.0, {sql_digamma_int('count(*)')} + avg({sql_digamma_int('kc')})
                - avg({sql_digamma_int('nc')}) - avg({sql_digamma_int('m')})) AS score
  FROM m GROUP BY feature""")
def q_score_mutual_info_classif(spark, sf):
    return U.score_mutual_info_classif(five(spark, sf)).select("feature", "n", "score")


# ------------------------------------------------------------ selectors (Kruskal scores, 5 classes)
def kruskal_scores(spark, sf):
    return U.score_kruskal(five(spark, sf)).select("feature", "score", "pvalue")


KS = f"(SELECT feature, score, pvalue FROM ({KRUSKAL_SQL}) _k)"


@register("select_k_best", rounded=P_COLS, sql=f"""
SELECT feature, score, pvalue, row_number() OVER (ORDER BY score DESC, feature DESC) <= 10 AS selected
  FROM {KS} s""")
def q_select_k_best(spark, sf):
    return S.select_k_best(kruskal_scores(spark, sf), 10)


@register("select_percentile_own", rounded=P_COLS, sql=f"""
SELECT feature, score, pvalue, score >= (SELECT quantile_cont(score, 0.5) FROM {KS} s0) AS selected
  FROM {KS} s""")
def q_select_percentile_own(spark, sf):
    return S.select_percentile_own(kruskal_scores(spark, sf), 50)


@register("select_percentile_lib", rounded=P_COLS, sql=f"""
WITH s AS (SELECT *, (SELECT quantile_cont(score, 0.9) FROM {KS} s0) AS thr FROM {KS} _s),
r AS (SELECT *, count(*) OVER () AS n, sum(CAST(score > thr AS INTEGER)) OVER () AS above,
             sum(CAST(score = thr AS INTEGER)) OVER (ORDER BY feature ROWS UNBOUNDED PRECEDING) AS tie_rank
        FROM s)
SELECT feature, score, pvalue,
       score > thr OR (score = thr AND tie_rank <= floor(n * 10 / 100.0) - above) AS selected FROM r""")
def q_select_percentile_lib(spark, sf):
    return S.select_percentile_lib(kruskal_scores(spark, sf), 10)


@register("select_pvalue", rounded=P_COLS,
          sql=f"SELECT feature, score, pvalue, coalesce(pvalue <= 0.05, FALSE) AS selected FROM {KS} s")
def q_select_pvalue(spark, sf):
    return S.select_pvalue(kruskal_scores(spark, sf), 0.05, "kruskal")


@register("select_fpr", rounded=P_COLS,
          sql=f"SELECT feature, score, pvalue, coalesce(pvalue < 0.05, FALSE) AS selected FROM {KS} s")
def q_select_fpr(spark, sf):
    return S.select_fpr(kruskal_scores(spark, sf), 0.05)


@register("select_fwe", rounded=P_COLS, sql=f"""
SELECT feature, score, pvalue, coalesce(pvalue < 0.05 / count(*) OVER (), FALSE) AS selected FROM {KS} s""")
def q_select_fwe(spark, sf):
    return S.select_fwe(kruskal_scores(spark, sf), 0.05)


@register("select_fdr", rounded=P_COLS, sql=f"""
WITH r AS (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY pvalue, feature) AS i FROM {KS} s),
c AS (SELECT max(CASE WHEN pvalue <= 0.05 / n * i THEN pvalue END) AS cut FROM r)
SELECT feature, score, pvalue, coalesce(pvalue <= (SELECT cut FROM c), FALSE) AS selected FROM r""")
def q_select_fdr(spark, sf):
    return S.select_fdr(kruskal_scores(spark, sf), 0.05)


@register("univariate_report", rounded=P_COLS, sql=f"""
SELECT feature AS feature_name, score, pvalue FROM {KS} s WHERE pvalue <= 0.05""")
def q_univariate_report(spark, sf):
    return S.univariate_report(S.select_pvalue(kruskal_scores(spark, sf), 0.05, "kruskal"))


@register("select_by_support", rounded=("value",), sql=f"""
WITH k AS (SELECT feature FROM (SELECT feature, row_number() OVER (ORDER BY score DESC, feature DESC) AS rn
                                  FROM {KS} s) _r WHERE rn <= 10)
SELECT row_id, feature, value FROM {M} m WHERE feature IN (SELECT feature FROM k)""")
def q_select_by_support(spark, sf):
    sel = S.select_k_best(kruskal_scores(spark, sf), 10).where("selected").select("feature")
    return T.matrix_long(spark, sf).join(sel, "feature", "left_semi")


@register("threshold_select", rounded=("importance",), sql=f"""
WITH i AS (SELECT feature, corr(value, CAST(label AS DOUBLE)) AS importance FROM {TB} t GROUP BY feature)
SELECT feature, importance,
       abs(importance) >= 1.25 * (SELECT avg(abs(importance)) FROM i) AS selected FROM i""")
def q_threshold_select(spark, sf):
    imp = U.correlation(binary(spark, sf)).select("feature", F.col("r").alias("importance"))
    return S.threshold_select(imp, "1.25*mean").select("feature", "importance", "selected")


# regression target: the first embedding coordinate; features: the other 63
TREG = f"""(SELECT m.row_id, m.feature, m.value, t.value AS label
   FROM {M} m JOIN (SELECT row_id, value FROM {M} _t0 WHERE feature = 0) t ON m.row_id = t.row_id
  WHERE m.feature > 0)"""


def regression_long(spark, sf):
    m = T.matrix_long(spark, sf)
    tgt = m.where("feature = 0").select("row_id", F.col("value").alias("label"))
    return m.where("feature > 0").join(tgt, "row_id", "inner")


@register("score_mutual_info_regression", rounded=SCORE_COLS, sql=f"""
WITH t AS (SELECT feature, row_id,
                  CASE WHEN stddev_pop(value) OVER (PARTITION BY feature) > 0
                       THEN value / stddev_pop(value) OVER (PARTITION BY feature) ELSE value END AS x,
                  CASE WHEN stddev_pop(label) OVER (PARTITION BY feature) > 0
                       THEN label / stddev_pop(label) OVER (PARTITION BY feature) ELSE label END AS y
             FROM {TREG} _r),
p AS (SELECT a.feature, a.row_id, greatest(abs(a.x - b.x), abs(a.y - b.y)) AS d,
             row_number() OVER (PARTITION BY a.feature, a.row_id ORDER BY greatest(abs(a.x - b.x), abs(a.y - b.y))) AS rk
        FROM t a JOIN t b ON a.feature = b.feature AND a.row_id <> b.row_id),
e AS (SELECT p.feature, p.row_id, p.d AS eps, t.x, t.y FROM p JOIN t ON p.feature = t.feature AND p.row_id = t.row_id
       WHERE rk = 3),
c AS (SELECT e.feature, e.row_id,
             sum(CASE WHEN (e.eps > 0 AND abs(b.x - e.x) < e.eps) OR (e.eps = 0 AND b.x = e.x) THEN 1 ELSE 0 END) - 1 AS nx,
             sum(CASE WHEN (e.eps > 0 AND abs(b.y - e.y) < e.eps) OR (e.eps = 0 AND b.y = e.y) THEN 1 ELSE 0 END) - 1 AS ny
        FROM e JOIN t b ON b.feature = e.feature GROUP BY e.feature, e.row_id)
SELECT feature, count(*) AS n,
       greatest(0.0, {sql_digamma_int('count(*)')} + {sql_digamma_int('3')}
                - avg({sql_digamma_int('nx + 1')}) - avg({sql_digamma_int('ny + 1')})) AS score
  FROM c GROUP BY feature""")
def q_score_mutual_info_regression(spark, sf):
    return U.score_mutual_info_regression(regression_long(spark, sf)).select("feature", "n", "score")
