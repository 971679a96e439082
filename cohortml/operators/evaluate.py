"""Evaluation tables for binary scores: ``(keys..., row_id, label, prob)``.

``keys`` groups independent score sets, e.g. ``["model", "fold"]``. Curves
first collapse rows to distinct scores per key, then use the block-wise
running totals, so neither a large key nor the whole table lands in a single
task. The positive class is 1; a row is predicted positive when
``prob > 0.5``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortml.functions import bounded
from cohortml.functions.ordered import running_totals


def _k(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


def attach(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join a per-key summary; with no keys its single row becomes scalar subqueries."""
    keys = list(keys)
    if keys:
        return df.join(small, keys, "inner")
    return df.withColumns({c: small.select(c).scalar() for c in small.columns})


def _ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0 (the zero-division convention of the metrics)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def predicted(prob: Column, threshold: float = 0.5) -> Column:
    return (prob > F.lit(float(threshold))).cast("int")


def margin_to_prob(margin: Column) -> Column:
    """Sigmoid of a decision score, for models without probabilities."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


# ------------------------------------------------------------ point metrics
def confusion_counts(df: DataFrame, keys=(), label="label", prob="prob", pred: str | None = None) -> DataFrame:
    k = _k(keys)
    p = F.col(pred) if pred else predicted(F.col(prob))
    y = F.col(label)
    return df.groupBy(*k).agg(
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"),
        F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"))


def point_metrics(df: DataFrame, keys=(), label="label", prob="prob", pred: str | None = None) -> DataFrame:
    """accuracy, f1 and MCC per key (zero denominators give 0)."""
    k = _k(keys)
    c = confusion_counts(df, k, label, prob, pred)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return c.select(*k, _ratio(tp + tn, n).alias("accuracy"),
                    _ratio(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn).alias("f1"),
                    _ratio(tp * tn - fp * fn, den).alias("mcc"))


def distinct_scores(df: DataFrame, keys=(), label="label", prob="prob") -> DataFrame:
    """One row per (key, distinct score) with its positive and negative counts."""
    k = _k(keys)
    return df.groupBy(*k, F.col(prob).alias("score")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"),
        F.sum((F.col(label) != 1).cast("long")).alias("neg"))


def m_auc(df: DataFrame, keys=(), label="label", prob="prob") -> DataFrame:
    """Rank AUC: (R+ - P(P+1)/2) / (P N), tied scores at their mid-rank."""
    k = _k(keys)
    d = distinct_scores(df, k, label, prob)
    r = running_totals(d, k, ["score"], {"c_le": (F.col("pos") + F.col("neg")).cast("double")})
    mid = F.col("c_le") - (F.col("pos") + F.col("neg") - F.lit(1)) / F.lit(2.0)
    a = r.groupBy(*k).agg(F.sum(F.col("pos") * mid).alias("rpos"),
                          F.sum("pos").cast("double").alias("P"), F.sum("neg").cast("double").alias("N"))
    auc = (F.col("rpos") - F.col("P") * (F.col("P") + F.lit(1.0)) / F.lit(2.0)) / (F.col("P") * F.col("N"))
    return a.select(*k, F.when((F.col("P") > 0) & (F.col("N") > 0), auc).alias("auc"))


def score_on_test(df: DataFrame, keys=(), label="label", prob="prob") -> DataFrame:
    """accuracy, f1, MCC and AUC per key in one table."""
    k = _k(keys)
    pm = point_metrics(df, k, label, prob)
    au = m_auc(df, k, label, prob)
    return pm.join(au, k, "inner") if k else pm.withColumn("auc", au.select("auc").scalar())


def confusion_matrix(df: DataFrame, keys=(), label="label", prob="prob", classes=(0, 1)) -> DataFrame:
    """Counts per (true, predicted) class, zeros included."""
    k = _k(keys)
    counts = (df.select(*k, F.col(label).alias("true_label"), predicted(F.col(prob)).alias("pred_label"))
              .groupBy(*k, "true_label", "pred_label").agg(F.count(F.lit(1)).alias("count")))
    cls = F.array(*[F.lit(int(c)) for c in classes])
    # the full grid of cells per key, made by exploding the fixed class list
    grid = (df.select(*k).distinct() if k else df.sparkSession.range(1).select())
    grid = grid.select(*k, F.explode(cls).alias("true_label")).select(*k, "true_label",
                                                                     F.explode(cls).alias("pred_label"))
    return (grid.join(counts, k + ["true_label", "pred_label"], "left")
            .select(*k, "true_label", "pred_label", F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def classification_report(df: DataFrame, keys=(), label="label", prob="prob") -> DataFrame:
    """precision, recall, f1, support per class plus accuracy, macro and weighted rows."""
    k = _k(keys)
    c = confusion_counts(df, k, label, prob)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    rows = []
    for cls, (t, fpos, fneg) in (("0", (tn, fn, fp)), ("1", (tp, fp, fn))):
        prec = _ratio(t, t + fpos)
        rec = _ratio(t, t + fneg)
        rows.append(c.select(*k, F.lit(cls).alias("row"), prec.alias("precision"), rec.alias("recall"),
                             _ratio(F.lit(2.0) * prec * rec, prec + rec).alias("f1"),
                             (t + fneg).alias("support")))
    per = rows[0].unionByName(rows[1])
    n = c.select(*k, (tp + fp + tn + fn).alias("n"), _ratio(tp + tn, tp + fp + tn + fn).alias("acc"))
    acc = n.select(*k, F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                   F.lit(None).cast("double").alias("recall"), F.col("acc").alias("f1"), F.col("n").alias("support"))
    macro = per.groupBy(*k).agg(F.lit("macro avg").alias("row"), F.avg("precision").alias("precision"),
                                F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                                F.sum("support").alias("support"))
    wsum = lambda c_: F.sum(F.col(c_) * F.col("support")) / F.sum("support")
    weighted = per.groupBy(*k).agg(F.lit("weighted avg").alias("row"), wsum("precision").alias("precision"),
                                   wsum("recall").alias("recall"), wsum("f1").alias("f1"),
                                   F.sum("support").alias("support"))
    out = per.unionByName(acc).unionByName(macro).unionByName(weighted)
    return out.withColumn("support", F.col("support").cast("long"))


# ------------------------------------------------------------ curves
def _desc_cumulative(df, keys, label, prob):
    k = _k(keys)
    d = distinct_scores(df, k, label, prob)
    r = running_totals(d, k, [F.col("score").desc()], {"tps": F.col("pos"), "fps": F.col("neg")})
    tot = d.groupBy(*k).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return attach(r, tot, k)


def roc_curve(df: DataFrame, keys=(), label="label", prob="prob") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, plus the start (inf, 0, 0)."""
    return _roc_points(df, _desc_cumulative(df, _k(keys), label, prob), _k(keys))


def _roc_points(df: DataFrame, r: DataFrame, k) -> DataFrame:
    """The curve from the running counts ``r``."""
    pts = r.select(*k, F.col("score").alias("threshold"), _ratio(F.col("fps"), F.col("N")).alias("fpr"),
                   _ratio(F.col("tps"), F.col("P")).alias("tpr"))
    start_src = r.select(*k).distinct() if k else df.sparkSession.range(1).select()
    start = start_src.select(*k, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                             F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def pr_curve(df: DataFrame, keys=(), label="label", prob="prob") -> DataFrame:
    """(threshold, precision, recall) per distinct score, plus the end point (null, 1, 0)."""
    k = _k(keys)
    r = _desc_cumulative(df, k, label, prob)
    recall = F.when(F.col("P") == 0, F.lit(1.0)).otherwise(F.col("tps") / F.col("P"))
    pts = r.select(*k, F.col("score").alias("threshold"),
                   _ratio(F.col("tps"), F.col("tps") + F.col("fps")).alias("precision"), recall.alias("recall"))
    end_src = df.select(*k).distinct() if k else df.sparkSession.range(1).select()
    end = end_src.select(*k, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                         F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def m_average_precision(df: DataFrame, keys=(), label="label", prob="prob") -> DataFrame:
    """AP = sum_n (R_n - R_(n-1)) P_n over descending thresholds."""
    k = _k(keys)
    r = _desc_cumulative(df, k, label, prob)
    term = _ratio(F.col("pos"), F.col("P")) * _ratio(F.col("tps"), F.col("tps") + F.col("fps"))
    return r.groupBy(*k).agg(F.sum(term).alias("average_precision"))


def ks_curve(df: DataFrame, keys=(), label="label", prob="prob") -> DataFrame:
    """Cumulative shares of positives and negatives up to each distinct score (ascending)."""
    k = _k(keys)
    d = distinct_scores(df, k, label, prob)
    r = running_totals(d, k, ["score"], {"cp": F.col("pos"), "cn": F.col("neg")})
    tot = d.groupBy(*k).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    r = attach(r, tot, k)
    cum_pos = _ratio(F.col("cp"), F.col("P"))
    cum_neg = _ratio(F.col("cn"), F.col("N"))
    return r.select(*k, F.col("score").alias("prob"), cum_pos.alias("cum_pos"), cum_neg.alias("cum_neg"),
                    F.abs(cum_pos - cum_neg).alias("diff"))


def m_ks(df: DataFrame, keys=(), label="label", prob="prob") -> DataFrame:
    """Largest gap between the cumulative shares, and the (lowest) score where it occurs."""
    k = _k(keys)
    c = ks_curve(df, k, label, prob)
    best = F.min(F.struct((-F.col("diff")).alias("nd"), F.col("prob").alias("p")))
    return c.groupBy(*k).agg(F.max("diff").alias("ks"), best.alias("b")).select(*k, "ks", F.col("b.p").alias("ks_prob"))


def gain_curve(df: DataFrame, keys=(), label="label", prob="prob", key="row_id") -> DataFrame:
    """Per row in descending score (ties by key): fraction of samples, gain and lift."""
    k = _k(keys)
    base = df.select(*k, key, F.col(prob).alias("prob"), (F.col(label) == 1).cast("long").alias("_pos"))
    r = running_totals(base, k, [F.col("prob").desc(), F.col(key)],
                       {"cum_pos": F.col("_pos"), "rn": F.lit(1).cast("long")})
    tot = base.groupBy(*k).agg(F.sum("_pos").alias("P"), F.count(F.lit(1)).alias("n"))
    r = attach(r, tot, k)
    gain = _ratio(F.col("cum_pos"), F.col("P"))
    pct = F.col("rn") / F.col("n")
    return r.select(*k, key, "prob", F.col("rn").cast("long").alias("rank"), pct.alias("pct_samples"),
                    gain.alias("gain"), (gain / pct).alias("lift"))


def _edge_count(p: Column, edges, strict: bool) -> Column:
    terms = [((p > F.lit(float(e))) if strict else (p >= F.lit(float(e)))).cast("int") for e in edges]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def bin_edges(n_bins: int) -> list[float]:
    """Inner edges of ``n_bins`` equal bins on [0, 1], as NumPy's linspace gives them."""
    return [float(e) for e in np.linspace(0.0, 1.0, int(n_bins) + 1)[1:-1]]


def calibration_curve(df: DataFrame, keys=(), label="label", prob="prob", n_bins: int = 10) -> DataFrame:
    """Non-empty equal-width bins: mean probability and share of positives; a value on an edge goes to the lower bin."""
    k = _k(keys)
    b = _edge_count(F.col(prob), bin_edges(n_bins), strict=True)
    return (df.withColumn("bin", b).groupBy(*k, "bin")
            .agg(F.avg(F.col(label).cast("double")).alias("prob_true"), F.avg(prob).alias("prob_pred"),
                 F.count(F.lit(1)).alias("count")))


def probability_histogram(df: DataFrame, keys=(), prob="prob", n_bins: int = 10) -> DataFrame:
    """Counts in ``n_bins`` bins over [0, 1], right-open except the last; empty bins included."""
    k = _k(keys)
    inside = df.where((F.col(prob) >= 0) & (F.col(prob) <= 1))
    b = _edge_count(F.col(prob), bin_edges(n_bins), strict=False)
    counts = inside.withColumn("bin", b).groupBy(*k, "bin").agg(F.count(F.lit(1)).alias("count"))
    src = df.select(*k).distinct() if k else df.sparkSession.range(1).select()
    grid = src.select(*k, F.explode(F.sequence(F.lit(0), F.lit(int(n_bins) - 1))).alias("bin"))
    return (grid.join(counts, k + ["bin"], "left")
            .select(*k, "bin", (F.col("bin") / F.lit(float(n_bins))).alias("bin_start"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count")))


# ------------------------------------------------------------ family curves
def grid_x(i: Column, grid_points: int) -> Column:
    """The i-th point of ``linspace(0, 1, grid_points)`` (NumPy: i * step, last = 1)."""
    g = int(grid_points)
    return F.when(i == F.lit(g - 1), F.lit(1.0)).otherwise(i.cast("double") * F.lit(1.0 / (g - 1)))


def roc_mean_by_family(df: DataFrame, family="model", fold="fold", label="label", prob="prob",
                       grid_points: int = 100) -> DataFrame:
    """Mean ROC of the fold models of each family on a common fpr grid.

    tpr is interpolated linearly with NumPy ``interp`` rules (left point: the
    largest fpr <= x, taking its highest tpr; right point: the smallest
    fpr > x, taking its lowest tpr); the first grid value is 0, the last mean
    is 1; band = mean +/- population std clipped to [0, 1].

    Each curve point is sent to the one grid cell it falls in; left and right
    points then come from running max / min over the grid, a table of
    ``grid_points`` rows per fold model, whatever the data size.
    """
    g = int(grid_points)
    keys = [family, fold]
    # one ranking of the scores feeds the curve, the grid and the area
    ranked = _desc_cumulative(df, keys, label, prob)
    pts = _roc_points(df, ranked, keys).groupBy(*keys, "fpr").agg(F.min("tpr").alias("lo"), F.max("tpr").alias("hi"))
    # cell = smallest grid index i with x_i >= fpr
    c = F.ceil(F.col("fpr") * F.lit(g - 1)).cast("int")
    c = (F.when((c > 0) & (grid_x(c - F.lit(1), g) >= F.col("fpr")), c - F.lit(1))
         .when(grid_x(c, g) < F.col("fpr"), c + F.lit(1)).otherwise(c))
    cells = (pts.withColumn("i", F.least(F.greatest(c, F.lit(0)), F.lit(g - 1)))
             .groupBy(*keys, "i")
             .agg(F.max(F.struct(F.col("fpr").alias("a"), F.col("hi").alias("y"))).alias("L"),
                  F.min(F.struct(F.col("fpr").alias("b"), F.col("lo").alias("y"))).alias("R")))
    grid = (ranked.select(*keys).distinct()
            .select(*keys, F.explode(F.sequence(F.lit(0), F.lit(g - 1))).alias("i")))
    gc = grid.join(cells, keys + ["i"], "left").withColumn("x", grid_x(F.col("i"), g))
    w_up = Window.partitionBy(*keys).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    w_down = Window.partitionBy(*keys).orderBy("i").rowsBetween(1, Window.unboundedFollowing)
    gc = gc.select(*keys, "i", "x", F.max("L").over(w_up).alias("L"), F.min("R").over(w_down).alias("R"))
    a, ya, b, yb = F.col("L.a"), F.col("L.y"), F.col("R.b"), F.col("R.y")
    tpr = F.when(F.col("i") == 0, F.lit(0.0)).when(b.isNull(), ya).otherwise(
        ya + (F.col("x") - a) * (yb - ya) / (b - a))
    interp = gc.select(*keys, "i", "x", tpr.alias("tpr"))
    agg = interp.groupBy(family, "i").agg(F.first("x").alias("fpr"), F.avg("tpr").alias("mean_tpr"),
                                          F.stddev_pop("tpr").alias("std_tpr"))
    mean = F.when(F.col("i") == g - 1, F.lit(1.0)).otherwise(F.col("mean_tpr"))
    # a negative row is below the positives before it, and half below those of its own score
    won = F.sum(F.col("neg") * (F.col("tps") - F.col("pos") / F.lit(2.0)))
    area = ranked.groupBy(*keys).agg(won.alias("won"), F.first("P").alias("P"), F.first("N").alias("N"))
    area = area.select(*keys, F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("won") / (F.col("P") * F.col("N")))
                       .alias("auc"))
    aucs = area.groupBy(family).agg(F.avg("auc").alias("mean_auc"),
                                                            F.stddev_pop("auc").alias("std_auc"))
    out = agg.select(family, F.col("i").alias("grid_index"), "fpr", mean.alias("mean_tpr"), "std_tpr")
    out = (out.withColumn("tpr_upper", F.least(F.col("mean_tpr") + F.col("std_tpr"), F.lit(1.0)))
           .withColumn("tpr_lower", F.greatest(F.col("mean_tpr") - F.col("std_tpr"), F.lit(0.0))))
    return out.join(aucs, family, "inner")


def roc_best_by_family(df: DataFrame, family="model", fold="fold", label="label", prob="prob") -> DataFrame:
    """ROC curve of the fold model with the highest AUC in each family (lowest fold on ties)."""
    keys = [family, fold]
    aucs = m_auc(df, keys, label, prob)
    best = aucs.groupBy(family).agg(F.min(F.struct((-F.col("auc")).alias("na"), F.col(fold).alias("f"))).alias("b"))
    best = best.select(family, F.col("b.f").alias(fold), (-F.col("b.na")).alias("auc"))
    roc = roc_curve(df.join(best.select(family, fold), keys, "left_semi"), keys, label, prob)
    return roc.join(best, keys, "inner")


# ------------------------------------------------------------ metric tables
def metric_table(df: DataFrame, family="model", fold="fold", label="label", prob="prob",
                 val_metric: str = "auc") -> DataFrame:
    """Per-fold metrics named ``<family>_<fold>`` plus a ``<family>_mean`` row."""
    keys = [family, fold]
    m = score_on_test(df, keys, label, prob)
    per = m.select(F.concat(F.lit("model"), F.col(family).cast("string"), F.lit("_"),
                            F.col(fold).cast("string")).alias("name"),
                   F.col(family), F.col(val_metric).alias("val_score"), F.col("accuracy").alias("test_acc"),
                   F.col("f1").alias("test_f1"), F.col("mcc").alias("test_mcc"), F.col("auc").alias("test_auc"))
    cols = ["val_score", "test_acc", "test_f1", "test_mcc", "test_auc"]
    mean = per.groupBy(family).agg(*[F.avg(c).alias(c) for c in cols]).select(
        F.concat(F.lit("model"), F.col(family).cast("string"), F.lit("_mean")).alias("name"), family, *cols)
    return per.unionByName(mean).drop(family)


def exclude_mean_rows(metrics: DataFrame, name: str = "name") -> DataFrame:
    return metrics.where(~F.lower(F.col(name)).contains("mean"))


def top_n_models(metrics: DataFrame, n: int = 5, name: str = "name") -> DataFrame:
    """Best ``n`` by validation score (ties by name); name split at the last underscore."""
    top = exclude_mean_rows(metrics, name).orderBy(F.col("val_score").desc(), F.col(name)).limit(int(n))
    return top.select(name, "val_score",
                      F.regexp_extract(F.col(name), r"^(.*)_([^_]*)$", 1).alias("family"),
                      F.regexp_extract(F.col(name), r"^(.*)_([^_]*)$", 2).alias("index"))


# ------------------------------------------------------------ ensembles
def vote_soft(preds: DataFrame, weights: dict | None = None, model="model", key="row_id",
              label="label", prob="prob") -> DataFrame:
    """Weighted mean of the class-1 probability over models: ``(row_id, label, prob)``."""
    w = F.lit(1.0)
    if weights:
        w = F.coalesce(F.element_at(F.create_map(*[x for m_, v in weights.items()
                                                    for x in (F.lit(m_), F.lit(float(v)))]), F.col(model)),
                       F.lit(0.0))
    p = preds.withColumn("_w", w)
    return (p.groupBy(key).agg(F.first(label).alias(label),
                               (F.sum(F.col("_w") * F.col(prob)) / F.sum("_w")).alias(prob)))


def vote_weight_search(preds: DataFrame, trials: DataFrame, model="model", key="row_id", label="label",
                       prob="prob") -> DataFrame:
    """Score many weight vectors at once: ``trials(trial, model, weight)`` -> accuracy and AUC per trial.

    The trial table is small (trials x models); the join keeps one row per
    (trial, prediction), then every trial is aggregated in the same job.
    """
    j = preds.join(bounded(trials, 1_000_000), model, "inner")
    ens = j.groupBy("trial", key).agg(F.first(label).alias(label),
                                      (F.sum(F.col("weight") * F.col(prob)) / F.sum("weight")).alias(prob))
    return score_on_test(ens, ["trial"], label, prob)


def stack_oof(preds: DataFrame, models: Sequence, model="model", key="row_id", label="label",
              prob="prob") -> DataFrame:
    """Out-of-fold class-1 probabilities side by side: ``metafeature_i`` per base model."""
    wide = (preds.groupBy(key, label).pivot(model, list(models)).agg(F.avg(prob)))
    return wide.select(key, label, *[F.col(str(m)).alias(f"metafeature_{i}") for i, m in enumerate(models)])
