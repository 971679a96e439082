"""Registered queries: evaluation tables, metric tables and ensembles.

Inputs: ``scored`` (events as one scored set) and ``scored_models`` (three
models x five hash folds over the same rows).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortml.functions.hashing import hash_int, sql_hash_int
from cohortml.operators import evaluate as E
from cohortml.queries import register
from cohortml.sources import files as FS
from cohortml.sources import tables as T

SC, SM = T.SCORED_SQL, T.SCORED_MODELS_SQL
MF = ("model", "fold")

_POINT = f"""
WITH c AS (SELECT model, fold,
                  CAST(sum(CASE WHEN label = 1 AND prob > 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
                  CAST(sum(CASE WHEN label = 0 AND prob > 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
                  CAST(sum(CASE WHEN label = 0 AND prob <= 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS tn,
                  CAST(sum(CASE WHEN label = 1 AND prob <= 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS fn
             FROM {SM} s GROUP BY model, fold),
m AS (SELECT model, fold,
             CASE WHEN tp + fp + tn + fn = 0 THEN 0.0 ELSE (tp + tn) / (tp + fp + tn + fn) END AS accuracy,
             CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
             CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0.0
                  ELSE (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) END AS mcc
        FROM c)"""

_AUC = f"""
WITH r AS (SELECT model, fold, label,
                  rank() OVER (PARTITION BY model, fold ORDER BY prob)
                  + (count(*) OVER (PARTITION BY model, fold, prob) - 1) / 2.0 AS rk
             FROM {SM} s),
a AS (SELECT model, fold, sum(CASE WHEN label = 1 THEN rk ELSE 0 END) AS rp,
             CAST(sum(label) AS DOUBLE) AS P, CAST(count(*) - sum(label) AS DOUBLE) AS N
        FROM r GROUP BY model, fold)
SELECT model, fold, CASE WHEN P > 0 AND N > 0 THEN (rp - P * (P + 1) / 2) / (P * N) END AS auc FROM a"""


def sm(spark, sf):
    return T.scored_models(spark, sf)


def sc(spark, sf):
    return T.scored(spark, sf)


@register("m_accuracy", rounded=("accuracy",), sql=_POINT + " SELECT model, fold, accuracy FROM m")
def q_m_accuracy(spark, sf):
    return E.point_metrics(sm(spark, sf), MF).select(*MF, "accuracy")


@register("m_f1", rounded=("f1",), sql=_POINT + " SELECT model, fold, f1 FROM m")
def q_m_f1(spark, sf):
    return E.point_metrics(sm(spark, sf), MF).select(*MF, "f1")


@register("m_mcc", rounded=("mcc",), sql=_POINT + " SELECT model, fold, mcc FROM m")
def q_m_mcc(spark, sf):
    return E.point_metrics(sm(spark, sf), MF).select(*MF, "mcc")


@register("m_auc", rounded=("auc",), sql=_AUC)
def q_m_auc(spark, sf):
    return E.m_auc(sm(spark, sf), MF)


@register("score_on_test", rounded=("accuracy", "f1", "mcc", "auc"), sql=f"""
{_POINT}, au AS ({_AUC.replace('WITH r AS', 'SELECT * FROM (WITH r AS')}) _x)
SELECT m.model, m.fold, accuracy, f1, mcc, auc FROM m JOIN au USING (model, fold)""")
def q_score_on_test(spark, sf):
    return E.score_on_test(sm(spark, sf), MF)


@register("confusion_matrix", sql=f"""
WITH g AS (SELECT t AS true_label, p AS pred_label FROM (VALUES (0), (1)) a(t), (VALUES (0), (1)) b(p)),
c AS (SELECT label AS true_label, CAST(prob > 0.5 AS INTEGER) AS pred_label, count(*) AS n FROM {SC} s
       GROUP BY 1, 2)
SELECT g.true_label, g.pred_label, coalesce(c.n, 0) AS count
  FROM g LEFT JOIN c ON g.true_label = c.true_label AND g.pred_label = c.pred_label""")
def q_confusion_matrix(spark, sf):
    return E.confusion_matrix(sc(spark, sf))


@register("classification_report", rounded=("precision", "recall", "f1"), sql=f"""
WITH c AS (SELECT CAST(sum(CASE WHEN label = 1 AND prob > 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
                  CAST(sum(CASE WHEN label = 0 AND prob > 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
                  CAST(sum(CASE WHEN label = 0 AND prob <= 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS tn,
                  CAST(sum(CASE WHEN label = 1 AND prob <= 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS fn FROM {SC} s),
k AS (SELECT '0' AS row, tn AS t, fn AS fpos, fp AS fneg FROM c UNION ALL
      SELECT '1', tp, fp, fn FROM c),
p AS (SELECT row, CASE WHEN t + fpos = 0 THEN 0.0 ELSE t / (t + fpos) END AS precision,
             CASE WHEN t + fneg = 0 THEN 0.0 ELSE t / (t + fneg) END AS recall, t + fneg AS support FROM k),
per AS (SELECT row, precision, recall,
               CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1,
               support FROM p)
SELECT row, precision, recall, f1, CAST(support AS BIGINT) AS support FROM per
UNION ALL SELECT 'accuracy', NULL, NULL,
       CASE WHEN tp + fp + tn + fn = 0 THEN 0.0 ELSE (tp + tn) / (tp + fp + tn + fn) END,
       CAST(tp + fp + tn + fn AS BIGINT) FROM c
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
       sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per""")
def q_classification_report(spark, sf):
    return E.classification_report(sc(spark, sf))


def _cum_desc(keys: str, src: str) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    sel = f"{keys}, " if keys else ""
    return f"""
WITH d AS (SELECT {sel}prob AS score, sum(label) AS pos, count(*) - sum(label) AS neg FROM {src} s
            GROUP BY {sel}prob),
r AS (SELECT {sel}score, pos, neg,
             sum(pos) OVER ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tps,
             sum(neg) OVER ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fps,
             sum(pos) OVER ({part}) AS P, sum(neg) OVER ({part}) AS N FROM d)"""


ROC_SQL = _cum_desc("model", SM) + f"""
SELECT model, score AS threshold, CASE WHEN N = 0 THEN 0.0 ELSE fps / N END AS fpr,
       CASE WHEN P = 0 THEN 0.0 ELSE tps / P END AS tpr FROM r
UNION ALL SELECT DISTINCT model, CAST('infinity' AS DOUBLE), 0.0, 0.0 FROM {SM} s"""


@register("roc_curve", rounded=("threshold", "fpr", "tpr"), sql=ROC_SQL)
def q_roc_curve(spark, sf):
    return E.roc_curve(sm(spark, sf), ["model"])


@register("pr_curve", rounded=("threshold", "precision", "recall"), sql=_cum_desc("model", SM) + f"""
SELECT model, score AS threshold, CASE WHEN tps + fps = 0 THEN 0.0 ELSE tps / (tps + fps) END AS precision,
       CASE WHEN P = 0 THEN 1.0 ELSE tps / P END AS recall FROM r
UNION ALL SELECT DISTINCT model, NULL, 1.0, 0.0 FROM {SM} s""")
def q_pr_curve(spark, sf):
    return E.pr_curve(sm(spark, sf), ["model"])


@register("m_average_precision", rounded=("average_precision",), sql=_cum_desc("model", SM) + """
SELECT model, sum(CASE WHEN P = 0 THEN 0.0 ELSE pos / P END
                  * CASE WHEN tps + fps = 0 THEN 0.0 ELSE tps / (tps + fps) END) AS average_precision
  FROM r GROUP BY model""")
def q_m_average_precision(spark, sf):
    return E.m_average_precision(sm(spark, sf), ["model"])


KS_SQL = f"""
WITH d AS (SELECT model, prob AS score, sum(label) AS pos, count(*) - sum(label) AS neg FROM {SM} s
            GROUP BY model, prob),
r AS (SELECT model, score,
             sum(pos) OVER (PARTITION BY model ORDER BY score ROWS UNBOUNDED PRECEDING) AS cp,
             sum(neg) OVER (PARTITION BY model ORDER BY score ROWS UNBOUNDED PRECEDING) AS cn,
             sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N FROM d),
k AS (SELECT model, score AS prob, CASE WHEN P = 0 THEN 0.0 ELSE cp / P END AS cum_pos,
             CASE WHEN N = 0 THEN 0.0 ELSE cn / N END AS cum_neg FROM r)"""


@register("ks_curve", rounded=("prob", "cum_pos", "cum_neg", "diff"), sql=KS_SQL + """
SELECT model, prob, cum_pos, cum_neg, abs(cum_pos - cum_neg) AS diff FROM k""")
def q_ks_curve(spark, sf):
    return E.ks_curve(sm(spark, sf), ["model"])


@register("m_ks", rounded=("ks", "ks_prob"), sql=KS_SQL + """
SELECT model, max(abs(cum_pos - cum_neg)) AS ks, arg_min(prob, -abs(cum_pos - cum_neg)) AS ks_prob
  FROM k GROUP BY model""")
def q_m_ks(spark, sf):
    return E.m_ks(sm(spark, sf), ["model"])


GAIN_SQL = f"""
WITH r AS (SELECT model, row_id, prob,
                  row_number() OVER (PARTITION BY model ORDER BY prob DESC, row_id) AS rk,
                  sum(label) OVER (PARTITION BY model ORDER BY prob DESC, row_id ROWS UNBOUNDED PRECEDING) AS cp,
                  sum(label) OVER (PARTITION BY model) AS P, count(*) OVER (PARTITION BY model) AS n
             FROM {SM} s)"""


@register("gain_curve", rounded=("prob", "pct_samples", "gain"), sql=GAIN_SQL + """
SELECT model, row_id, prob, rk AS rank, rk / n AS pct_samples,
       CASE WHEN P = 0 THEN 0.0 ELSE cp / P END AS gain FROM r""")
def q_gain_curve(spark, sf):
    return E.gain_curve(sm(spark, sf), ["model"]).drop("lift")


@register("lift_curve", rounded=("pct_samples", "lift"), sql=GAIN_SQL + """
SELECT model, row_id, rk / n AS pct_samples,
       CASE WHEN P = 0 THEN 0.0 ELSE cp / P END / (rk / n) AS lift FROM r""")
def q_lift_curve(spark, sf):
    return E.gain_curve(sm(spark, sf), ["model"]).select("model", "row_id", "pct_samples", "lift")


def _edge_sql(col: str, strict: bool) -> str:
    op = ">" if strict else ">="
    return "(" + " + ".join(f"CAST({col} {op} {e!r} AS INTEGER)" for e in E.bin_edges(10)) + ")"


@register("calibration_curve", rounded=("prob_true", "prob_pred"), sql=f"""
SELECT model, {_edge_sql('prob', True)} AS bin, avg(CAST(label AS DOUBLE)) AS prob_true, avg(prob) AS prob_pred,
       count(*) AS count
  FROM {SM} s GROUP BY model, bin""")
def q_calibration_curve(spark, sf):
    return E.calibration_curve(sm(spark, sf), ["model"])


@register("probability_histogram", rounded=("bin_start",), sql=f"""
WITH c AS (SELECT model, {_edge_sql('prob', False)} AS bin, count(*) AS n FROM {SM} s
            WHERE prob >= 0 AND prob <= 1 GROUP BY model, bin),
g AS (SELECT DISTINCT model, CAST(b.i AS INTEGER) AS bin FROM {SM} s, range(0, 10) b(i))
SELECT g.model, g.bin, g.bin / 10.0 AS bin_start, coalesce(c.n, 0) AS count
  FROM g LEFT JOIN c ON g.model = c.model AND g.bin = c.bin""")
def q_probability_histogram(spark, sf):
    return E.probability_histogram(sm(spark, sf), ["model"])


@register("margin_to_prob", rounded=("margin", "prob"), sql="""
SELECT event_id AS row_id, value / 100.0 - 1.0 AS margin, 1.0 / (1.0 + exp(-(value / 100.0 - 1.0))) AS prob
  FROM events""")
def q_margin_to_prob(spark, sf):
    ev = T.read_table(spark, sf, "events")
    m = F.col("value") / F.lit(100.0) - F.lit(1.0)
    return ev.select(F.col("event_id").alias("row_id"), m.alias("margin"), E.margin_to_prob(m).alias("prob"))


_STEP = 1.0 / 99


@register("roc_mean_by_family",
          rounded=("fpr", "mean_tpr", "std_tpr", "tpr_upper", "tpr_lower", "mean_auc", "std_auc"), sql=f"""
WITH d AS (SELECT model, fold, prob AS score, sum(label) AS pos, count(*) - sum(label) AS neg FROM {SM} s
            GROUP BY model, fold, prob),
r AS (SELECT model, fold,
             sum(pos) OVER (PARTITION BY model, fold ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tps,
             sum(neg) OVER (PARTITION BY model, fold ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fps,
             sum(pos) OVER (PARTITION BY model, fold) AS P, sum(neg) OVER (PARTITION BY model, fold) AS N FROM d),
roc AS (SELECT model, fold, CASE WHEN N = 0 THEN 0.0 ELSE fps / N END AS fpr,
               CASE WHEN P = 0 THEN 0.0 ELSE tps / P END AS tpr FROM r
        UNION ALL SELECT DISTINCT model, fold, 0.0, 0.0 FROM {SM} s),
pts AS (SELECT model, fold, fpr, min(tpr) AS lo, max(tpr) AS hi FROM roc GROUP BY model, fold, fpr),
grid AS (SELECT DISTINCT model, fold, CAST(g.i AS INTEGER) AS i,
                CASE WHEN g.i = 99 THEN 1.0 ELSE g.i * {_STEP!r} END AS x FROM {SM} s, range(0, 100) g(i)),
lft AS (SELECT g.model, g.fold, g.i, any_value(g.x) AS x, max(p.fpr) AS a, arg_max(p.hi, p.fpr) AS ya
        FROM grid g JOIN pts p ON g.model = p.model AND g.fold = p.fold AND p.fpr <= g.x
       GROUP BY g.model, g.fold, g.i),
rgt AS (SELECT g.model, g.fold, g.i, min(p.fpr) AS b, arg_min(p.lo, p.fpr) AS yb
        FROM grid g JOIN pts p ON g.model = p.model AND g.fold = p.fold AND p.fpr > g.x
       GROUP BY g.model, g.fold, g.i),
it AS (SELECT lft.model, lft.fold, lft.i, lft.x,
              CASE WHEN lft.i = 0 THEN 0.0 WHEN rgt.b IS NULL THEN lft.ya
                   ELSE lft.ya + (lft.x - lft.a) * (rgt.yb - lft.ya) / (rgt.b - lft.a) END AS tpr
         FROM lft LEFT JOIN rgt ON lft.model = rgt.model AND lft.fold = rgt.fold AND lft.i = rgt.i),
agg AS (SELECT model, i AS grid_index, any_value(x) AS fpr,
               CASE WHEN i = 99 THEN 1.0 ELSE avg(tpr) END AS mean_tpr, stddev_pop(tpr) AS std_tpr
          FROM it GROUP BY model, i),
au AS (SELECT model, avg(auc) AS mean_auc, stddev_pop(auc) AS std_auc FROM ({_AUC}) _a GROUP BY model)
SELECT agg.model, grid_index, fpr, mean_tpr, std_tpr, least(mean_tpr + std_tpr, 1.0) AS tpr_upper,
       greatest(mean_tpr - std_tpr, 0.0) AS tpr_lower, mean_auc, std_auc
  FROM agg JOIN au ON agg.model = au.model""")
def q_roc_mean_by_family(spark, sf):
    return E.roc_mean_by_family(sm(spark, sf))


@register("roc_best_by_family", rounded=("threshold", "fpr", "tpr", "auc"), sql=f"""
WITH au AS ({_AUC}),
best AS (SELECT model, arg_min(fold, struct_pack(na := -auc, f := fold)) AS fold, max(auc) AS auc
           FROM au GROUP BY model),
s AS (SELECT s.* FROM {SM} s JOIN best b ON s.model = b.model AND s.fold = b.fold),
{_cum_desc('model, fold', 's')[len(chr(10)) + 5:]},
roc AS (SELECT model, fold, score AS threshold, CASE WHEN N = 0 THEN 0.0 ELSE fps / N END AS fpr,
               CASE WHEN P = 0 THEN 0.0 ELSE tps / P END AS tpr FROM r
        UNION ALL SELECT DISTINCT model, fold, CAST('infinity' AS DOUBLE), 0.0, 0.0 FROM s)
SELECT roc.model, roc.fold, threshold, fpr, tpr, best.auc FROM roc JOIN best USING (model, fold)""")
def q_roc_best_by_family(spark, sf):
    return E.roc_best_by_family(sm(spark, sf))


_METRICS = f"""
{_POINT}, au AS (SELECT * FROM ({_AUC}) _a),
per AS (SELECT 'model' || CAST(m.model AS VARCHAR) || '_' || CAST(m.fold AS VARCHAR) AS name, m.model,
               auc AS val_score, accuracy AS test_acc, f1 AS test_f1, mcc AS test_mcc, auc AS test_auc
          FROM m JOIN au ON m.model = au.model AND m.fold = au.fold),
mt AS (SELECT name, val_score, test_acc, test_f1, test_mcc, test_auc FROM per
       UNION ALL SELECT 'model' || CAST(model AS VARCHAR) || '_mean', avg(val_score), avg(test_acc), avg(test_f1),
              avg(test_mcc), avg(test_auc) FROM per GROUP BY model)"""
MCOLS = ("val_score", "test_acc", "test_f1", "test_mcc", "test_auc")


@register("sink_metrics", rounded=MCOLS, sql=_METRICS + " SELECT * FROM mt")
def q_metric_table(spark, sf):
    path = FS.scratch_path(spark, "metrics")
    FS.write_metrics([E.metric_table(sm(spark, sf))], path)
    return spark.read.parquet(path).drop("family")


@register("exclude_mean_rows", rounded=MCOLS,
          sql=_METRICS + " SELECT * FROM mt WHERE NOT contains(lower(name), 'mean')")
def q_exclude_mean_rows(spark, sf):
    return E.exclude_mean_rows(E.metric_table(sm(spark, sf)))


@register("top_n_models", rounded=("val_score",), sql=_METRICS + r"""
SELECT name, val_score, regexp_extract(name, '^(.*)_([^_]*)$', 1) AS family,
       regexp_extract(name, '^(.*)_([^_]*)$', 2) AS index
  FROM mt WHERE NOT contains(lower(name), 'mean') ORDER BY val_score DESC, name LIMIT 5""")
def q_top_n_models(spark, sf):
    return E.top_n_models(E.metric_table(sm(spark, sf)), 5)


# ------------------------------------------------------------ ensembles
VOTE_W = {0: 1.0, 1: 2.0, 2: 3.0}


@register("vote_soft", rounded=("prob",), sql=f"""
SELECT row_id, any_value(label) AS label,
       sum(CASE model WHEN 0 THEN 1.0 WHEN 1 THEN 2.0 ELSE 3.0 END * prob)
       / sum(CASE model WHEN 0 THEN 1.0 WHEN 1 THEN 2.0 ELSE 3.0 END) AS prob
  FROM {SM} s GROUP BY row_id""")
def q_vote_soft(spark, sf):
    return E.vote_soft(sm(spark, sf), VOTE_W)


N_TRIALS = 8


def vote_trials(spark):
    """Weight trials: integer weights 1..100 per (trial, model), drawn by hash."""
    t = spark.range(N_TRIALS).select(F.col("id").cast("int").alias("trial"))
    t = t.select("trial", F.explode(F.sequence(F.lit(0), F.lit(T.N_MODELS - 1))).alias("model"))
    return t.select("trial", F.col("model").cast("int"),
                    (F.pmod(hash_int("vote", "trial", "model"), F.lit(100)) + F.lit(1)).cast("double")
                    .alias("weight"))


@register("vote_weight_search", rounded=("accuracy", "f1", "mcc", "auc"), sql=f"""
WITH t AS (SELECT CAST(a.trial AS INTEGER) AS trial, CAST(b.model AS INTEGER) AS model,
                  CAST({sql_hash_int('vote', 'a.trial', 'b.model')} % 100 + 1 AS DOUBLE) AS weight
             FROM range(0, {N_TRIALS}) a(trial), range(0, {T.N_MODELS}) b(model)),
e AS (SELECT t.trial, s.row_id, any_value(s.label) AS label, sum(t.weight * s.prob) / sum(t.weight) AS prob
        FROM {SM} s JOIN t ON s.model = t.model GROUP BY t.trial, s.row_id),
c AS (SELECT trial, CAST(sum(CASE WHEN label = 1 AND prob > 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
             CAST(sum(CASE WHEN label = 0 AND prob > 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
             CAST(sum(CASE WHEN label = 0 AND prob <= 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS tn,
             CAST(sum(CASE WHEN label = 1 AND prob <= 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS fn FROM e GROUP BY trial),
r AS (SELECT trial, label, rank() OVER (PARTITION BY trial ORDER BY prob)
             + (count(*) OVER (PARTITION BY trial, prob) - 1) / 2.0 AS rk FROM e),
a AS (SELECT trial, sum(CASE WHEN label = 1 THEN rk ELSE 0 END) AS rp, CAST(sum(label) AS DOUBLE) AS P,
             CAST(count(*) - sum(label) AS DOUBLE) AS N FROM r GROUP BY trial)
SELECT c.trial,
       CASE WHEN tp + fp + tn + fn = 0 THEN 0.0 ELSE (tp + tn) / (tp + fp + tn + fn) END AS accuracy,
       CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
       CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0.0
            ELSE (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) END AS mcc,
       (rp - P * (P + 1) / 2) / (P * N) AS auc
  FROM c JOIN a ON c.trial = a.trial""")
def q_vote_weight_search(spark, sf):
    return E.vote_weight_search(sm(spark, sf), vote_trials(spark))


_STACK = f"""
SELECT row_id, any_value(label) AS label,
       avg(CASE WHEN model = 0 THEN prob END) AS metafeature_0,
       avg(CASE WHEN model = 1 THEN prob END) AS metafeature_1,
       avg(CASE WHEN model = 2 THEN prob END) AS metafeature_2
  FROM {SM} s GROUP BY row_id"""
META = ("metafeature_0", "metafeature_1", "metafeature_2")


@register("stack_oof", rounded=META, sql=_STACK)
def q_stack_oof(spark, sf):
    return E.stack_oof(sm(spark, sf), list(range(T.N_MODELS)))


@register("concat_columns", rounded=META + ("value",), sql=f"""
SELECT m.*, e.value FROM ({_STACK}) m JOIN events e ON m.row_id = e.event_id""")
def q_concat_columns(spark, sf):
    meta = E.stack_oof(sm(spark, sf), list(range(T.N_MODELS)))
    ev = T.read_table(spark, sf, "events").select(F.col("event_id").alias("row_id"), "value")
    return meta.join(ev, "row_id", "inner")


@register("sink_meta", rounded=META, sql=f"SELECT *, CAST(row_id % 5 = 0 AS INTEGER) AS is_test FROM ({_STACK}) m")
def q_sink_meta(spark, sf):
    # stacked table with its train/test tag, as written by the stacking step
    meta = E.stack_oof(sm(spark, sf), list(range(T.N_MODELS)))
    path = FS.scratch_path(spark, "meta")
    FS.write_table(meta.withColumn("is_test", (F.col("row_id") % 5 == 0).cast("int")), path)
    return spark.read.parquet(path)
