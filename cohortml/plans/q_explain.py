"""Registered queries: explanation tables on exact linear attributions.

Fixture ``phi``: a linear margin with fixed weights over the 64 embedding
features, phi = w (x - mean), labels from ``label_binary``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortml.functions.hashing import sql_hash_int
from cohortml.operators import explain as X
from cohortml.operators.prep import explain_sample
from cohortml.queries import register
from cohortml.sources import tables as T

M, LB = T.MATRIX_LONG_SQL, T.LABEL_BINARY_SQL


# Fixed model of the fixture: weight of feature j is ((j mod 7) - 3) / 10, no intercept.
def weight_col(feature="feature"):
    return ((F.col(feature) % 7) - F.lit(3)).cast("double") / F.lit(10.0)


def _w_sql(f="feature"):
    return f"(CAST(({f} % 7) - 3 AS DOUBLE) / 10.0)"


def phi(spark, sf):
    return X.linear_attributions(T.matrix_long(spark, sf), weight_col())


def labels(spark, sf):
    return T.label_binary(spark, sf)


PHI_SQL = f"""
WITH m AS (SELECT * FROM {M} _m), mu AS (SELECT feature, avg(value) AS mean FROM m GROUP BY feature),
phi AS (SELECT m.row_id, m.feature, m.value, {_w_sql('m.feature')} * (m.value - mu.mean) AS shap,
               (SELECT sum({_w_sql()} * mean) FROM mu) AS base_value FROM m JOIN mu ON m.feature = mu.feature),
lab AS (SELECT * FROM {LB} _l),
ma AS (SELECT feature, avg(abs(shap)) AS mean_abs FROM phi GROUP BY feature),
mar AS (SELECT feature, mean_abs, CAST(row_number() OVER (ORDER BY mean_abs DESC, feature) AS INTEGER) AS rank
          FROM ma),
outp AS (SELECT row_id, any_value(base_value) + sum(shap) AS output FROM phi GROUP BY row_id),
miss AS (SELECT p.row_id, p.feature, 1.0 / (1.0 + exp(-o.output)) AS prob_full,
                1.0 / (1.0 + exp(-(o.output - p.shap))) AS prob_without
           FROM phi p JOIN outp o ON p.row_id = o.row_id)"""
PHI_COLS = ("value", "shap", "base_value")


@register("shap_values", rounded=PHI_COLS, sql=PHI_SQL + " SELECT * FROM phi")
def q_shap_values(spark, sf):
    return phi(spark, sf)


@register("shap_mean_abs", rounded=("mean_abs",), sql=PHI_SQL + " SELECT * FROM mar")
def q_shap_mean_abs(spark, sf):
    return X.shap_mean_abs(phi(spark, sf))


@register("shap_top_features", rounded=("mean_abs",), sql=PHI_SQL + " SELECT * FROM mar WHERE rank <= 20")
def q_shap_top_features(spark, sf):
    return X.shap_top_features(phi(spark, sf), 20)


@register("shap_decision_rows", rounded=("shap", "cum_output", "output"), sql=PHI_SQL + f""",
pick AS (SELECT row_id FROM lab ORDER BY {sql_hash_int(42, 'row_id')}, row_id LIMIT 30),
d AS (SELECT p.row_id, p.feature, r.rank, p.shap, p.base_value
        FROM phi p JOIN mar r ON p.feature = r.feature WHERE p.row_id IN (SELECT row_id FROM pick))
SELECT d.row_id, d.feature, d.rank, d.shap,
       d.base_value + sum(d.shap) OVER (PARTITION BY d.row_id ORDER BY d.rank DESC ROWS UNBOUNDED PRECEDING)
         AS cum_output,
       d.base_value + sum(d.shap) OVER (PARTITION BY d.row_id) AS output,
       CAST(d.base_value + sum(d.shap) OVER (PARTITION BY d.row_id) > 0 AS INTEGER) AS predicted,
       CAST(d.base_value + sum(d.shap) OVER (PARTITION BY d.row_id) > 0 AS INTEGER) <> l.label AS misclassified
  FROM d JOIN lab l ON d.row_id = l.row_id""")
def q_shap_decision_rows(spark, sf):
    lab = labels(spark, sf)
    return X.shap_decision_rows(phi(spark, sf), lab, explain_sample(lab, 30))


_INTER = PHI_SQL + """,
top AS (SELECT feature FROM mar WHERE rank = 1),
ref AS (SELECT row_id, value AS x_ref, shap AS phi_ref FROM phi WHERE feature = (SELECT feature FROM top)),
pos AS (SELECT row_id, phi_ref,
               (row_number() OVER (ORDER BY x_ref, row_id) - 1)
               // greatest(least(CAST(floor((SELECT count(*) FROM ref) / 10.0) AS BIGINT), 50), 1) AS chunk
          FROM ref),
o AS (SELECT p.feature, pos.chunk, corr(pos.phi_ref, p.value) AS c, sum(abs(p.value)) AS ax
        FROM phi p JOIN pos ON p.row_id = pos.row_id
       WHERE p.feature <> (SELECT feature FROM top) GROUP BY p.feature, pos.chunk),
s AS (SELECT feature,
             CASE WHEN sum(ax) < 1e-8 THEN 0.0
                  ELSE sum(CASE WHEN c IS NULL OR isnan(c) THEN 0.0 ELSE abs(c) END) END AS interaction
        FROM o GROUP BY feature),
sr AS (SELECT feature, interaction, CAST(row_number() OVER (ORDER BY interaction DESC, feature) AS INTEGER) AS rank
         FROM s)"""


@register("shap_interactions", rounded=("interaction",), sql=_INTER + " SELECT * FROM sr")
def q_shap_interactions(spark, sf):
    return X.shap_interactions(phi(spark, sf))


@register("shap_dependence", rounded=("value", "shap", "colour_value"), sql=_INTER + """
SELECT a.row_id, a.feature, a.value, a.shap, b.feature AS colour_feature, b.value AS colour_value
  FROM phi a JOIN phi b ON a.row_id = b.row_id
 WHERE a.feature = (SELECT feature FROM top) AND b.feature = (SELECT feature FROM sr WHERE rank = 1)""")
def q_shap_dependence(spark, sf):
    return X.shap_dependence(phi(spark, sf))


@register("missing_feature_prob", rounded=("prob_full", "prob_without"), sql=PHI_SQL + " SELECT * FROM miss")
def q_missing_feature_prob(spark, sf):
    return X.missing_feature_prob(phi(spark, sf))


_EPS = X.EPS64
_GLOBAL = PHI_SQL + f""",
ll AS (SELECT m.feature, CAST(l.label AS DOUBLE) AS y,
              least(greatest(m.prob_without, {_EPS!r}), 1 - {_EPS!r}) AS pw,
              least(greatest(m.prob_full, {_EPS!r}), 1 - {_EPS!r}) AS pf
         FROM miss m JOIN lab l ON m.row_id = l.row_id),
g AS (SELECT feature, avg(-(y * ln(pw) + (1 - y) * ln(1 - pw)) + (y * ln(pf) + (1 - y) * ln(1 - pf))) AS delta
        FROM ll GROUP BY feature)"""


@register("logloss_delta_global", rounded=("delta",), sql=_GLOBAL + """
SELECT feature, delta, CAST(row_number() OVER (ORDER BY delta DESC, feature) AS INTEGER) AS rank FROM g""")
def q_logloss_delta_global(spark, sf):
    return X.logloss_delta_global(phi(spark, sf), labels(spark, sf))


@register("logloss_delta_top", rounded=("delta",), sql=_GLOBAL + """
SELECT * FROM (SELECT feature, delta, CAST(row_number() OVER (ORDER BY abs(delta) DESC, feature) AS INTEGER) AS rank
                 FROM g) _t WHERE rank <= 20""")
def q_logloss_delta_top(spark, sf):
    return X.logloss_delta_top(phi(spark, sf), labels(spark, sf), 20)


@register("logloss_delta_local", rounded=("delta",), sql=PHI_SQL + """
SELECT m.row_id, m.feature,
       -(l.label * ln(m.prob_without + 1e-15) + (1 - l.label) * ln(1 - m.prob_without + 1e-15))
       + (l.label * ln(m.prob_full + 1e-15) + (1 - l.label) * ln(1 - m.prob_full + 1e-15)) AS delta
  FROM miss m JOIN lab l ON m.row_id = l.row_id""")
def q_logloss_delta_local(spark, sf):
    return X.logloss_delta_local(phi(spark, sf), labels(spark, sf))


@register("roc_compare_missing", rounded=("threshold", "fpr", "tpr", "auc"), sql=PHI_SQL + """,
top AS (SELECT feature FROM mar WHERE rank = 1),
b AS (SELECT m.row_id, l.label, 'full' AS variant, m.prob_full AS prob FROM miss m JOIN lab l USING (row_id)
       WHERE m.feature = (SELECT feature FROM top)
      UNION ALL
      SELECT m.row_id, l.label, 'without', m.prob_without FROM miss m JOIN lab l USING (row_id)
       WHERE m.feature = (SELECT feature FROM top)),
d AS (SELECT variant, prob AS score, sum(label) AS pos, count(*) - sum(label) AS neg FROM b GROUP BY variant, prob),
r AS (SELECT variant, score, sum(pos) OVER (PARTITION BY variant ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tps,
             sum(neg) OVER (PARTITION BY variant ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fps,
             sum(pos) OVER (PARTITION BY variant) AS P, sum(neg) OVER (PARTITION BY variant) AS N FROM d),
roc AS (SELECT variant, score AS threshold, fps / N AS fpr, tps / P AS tpr FROM r
        UNION ALL SELECT 'full', CAST('infinity' AS DOUBLE), 0.0, 0.0
        UNION ALL SELECT 'without', CAST('infinity' AS DOUBLE), 0.0, 0.0),
rk AS (SELECT variant, label, rank() OVER (PARTITION BY variant ORDER BY prob)
              + (count(*) OVER (PARTITION BY variant, prob) - 1) / 2.0 AS rk FROM b),
au AS (SELECT variant, (sum(CASE WHEN label = 1 THEN rk ELSE 0 END) - sum(label) * (sum(label) + 1) / 2.0)
              / (sum(label) * (count(*) - sum(label))) AS auc FROM rk GROUP BY variant)
SELECT roc.variant, threshold, fpr, tpr, auc FROM roc JOIN au ON roc.variant = au.variant""")
def q_roc_compare_missing(spark, sf):
    return X.roc_compare_missing(phi(spark, sf), labels(spark, sf))
