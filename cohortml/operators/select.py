"""Selectors over score tables ``(group..., feature, score, pvalue)``.

A score table has one row per (fold, feature): its size is bounded by the
width of the data, not by the number of samples, so per-fold windows over it
are cheap. Every selector adds a boolean ``selected`` column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortml.operators.prep import exact_quantile


def _g(group) -> list[str]:
    return [group] if isinstance(group, str) else list(group or [])


def _over(group):
    g = _g(group)
    return Window.partitionBy(*g) if g else Window.partitionBy()


def select_k_best(scores: DataFrame, k: int, group=(), feature: str = "feature") -> DataFrame:
    """Keep the ``k`` highest scores; ties go to the later feature index."""
    if isinstance(k, bool) or not isinstance(k, int) or k <= 0:
        raise ValueError("k_best needs a positive integer")
    w = _over(group).orderBy(F.col("score").desc_nulls_last(), F.col(feature).desc())
    return scores.withColumn("selected", F.row_number().over(w) <= F.lit(k))


def select_percentile_own(scores: DataFrame, param: float, group=(), feature: str = "feature") -> DataFrame:
    """Keep ``score >= percentile(scores, param)`` (linear interpolation).

    This is the custom scorers' sense: ``param = 1`` keeps about 99 %.
    """
    if not 0 <= param <= 100:
        raise ValueError("percentile must lie in [0, 100]")
    g = _g(group)
    thr = exact_quantile(scores, g, "score", float(param) / 100.0, "_thr")
    j = scores.join(thr, g, "inner") if g else scores.withColumn("_thr", thr.select("_thr").scalar())
    return j.withColumn("selected", F.col("score") >= F.col("_thr")).drop("_thr")


def select_percentile_lib(scores: DataFrame, param: float, group=(), feature: str = "feature") -> DataFrame:
    """Keep the top ``param`` % of features (library sense).

    Scores above the ``(100 - param)`` percentile are kept; ties at the
    threshold are added in feature order until ``floor(n * param / 100)``.
    """
    if not 0 <= param <= 100:
        raise ValueError("percentile must lie in [0, 100]")
    if param == 100:
        return scores.withColumn("selected", F.lit(True))
    if param == 0:
        return scores.withColumn("selected", F.lit(False))
    g = _g(group)
    clean = scores.withColumn("score", F.coalesce(F.col("score"), F.lit(float("-inf"))))
    thr = exact_quantile(clean, g, "score", (100.0 - float(param)) / 100.0, "_thr")
    j = clean.join(thr, g, "inner") if g else clean.withColumn("_thr", thr.select("_thr").scalar())
    w_all = _over(group)
    above = F.col("score") > F.col("_thr")
    tie = F.col("score") == F.col("_thr")
    j = (j.withColumn("_n", F.count(F.lit(1)).over(w_all))
          .withColumn("_above", F.sum(above.cast("int")).over(w_all))
          .withColumn("_tie_rank", F.sum(tie.cast("int")).over(
              _over(group).orderBy(F.col(feature)).rowsBetween(Window.unboundedPreceding, 0))))
    max_feats = F.floor(F.col("_n") * F.lit(float(param)) / F.lit(100.0))
    sel = above | (tie & (F.col("_tie_rank") <= max_feats - F.col("_above")))
    return (j.withColumn("selected", sel).drop("_thr", "_n", "_above", "_tie_rank")
            .withColumn("score", F.when(F.col("score") == float("-inf"), F.lit(None)).otherwise(F.col("score"))))


def select_pvalue(scores: DataFrame, param: float, function: str | None = None, group=()) -> DataFrame:
    """Keep ``pvalue <= param``; refused for distance correlation (no p-value)."""
    if function == "distancecorr":
        raise ValueError("distance correlation has no p-value; pvalue mode is not available")
    return scores.withColumn("selected", F.coalesce(F.col("pvalue") <= F.lit(float(param)), F.lit(False)))


def select_fpr(scores: DataFrame, alpha: float, group=()) -> DataFrame:
    return scores.withColumn("selected", F.coalesce(F.col("pvalue") < F.lit(float(alpha)), F.lit(False)))


def select_fwe(scores: DataFrame, alpha: float, group=()) -> DataFrame:
    """Bonferroni: ``p < alpha / n_features``."""
    n = F.count(F.lit(1)).over(_over(group))
    return scores.withColumn("selected", F.coalesce(F.col("pvalue") < F.lit(float(alpha)) / n, F.lit(False)))


def select_fdr(scores: DataFrame, alpha: float, group=(), feature: str = "feature") -> DataFrame:
    """Benjamini-Hochberg: keep p <= the largest sorted p_(i) with p_(i) <= alpha * i / n."""
    w = _over(group)
    ranked = (scores.withColumn("_n", F.count(F.lit(1)).over(w))
              .withColumn("_i", F.row_number().over(_over(group).orderBy(F.col("pvalue").asc_nulls_last(),
                                                                          F.col(feature)))))
    ok = F.col("pvalue") <= F.lit(float(alpha)) / F.col("_n") * F.col("_i")
    ranked = ranked.withColumn("_cut", F.max(F.when(ok, F.col("pvalue"))).over(w))
    return (ranked.withColumn("selected", F.coalesce(F.col("pvalue") <= F.col("_cut"), F.lit(False)))
            .drop("_n", "_i", "_cut"))


def select_k_best_lib(scores: DataFrame, k, group=(), feature: str = "feature") -> DataFrame:
    if k == "all":
        return scores.withColumn("selected", F.lit(True))
    return select_k_best(scores, int(k), group, feature)


OWN_MODES = ("k_best", "percentile", "pvalue")
LIB_MODES = ("percentile", "k_best", "fpr", "fdr", "fwe")


def apply_mode(scores: DataFrame, mode: str, param, function: str, own: bool, group=()) -> DataFrame:
    """Dispatch the univariate selection ``mode`` as the two scorer families define it."""
    if own:
        if mode == "k_best":
            return select_k_best(scores, param, group)
        if mode == "percentile":
            return select_percentile_own(scores, param, group)
        if mode == "pvalue":
            return select_pvalue(scores, param, function, group)
        raise ValueError(f"mode {mode!r} is not supported")
    if mode == "percentile":
        return select_percentile_lib(scores, param, group)
    if mode == "k_best":
        return select_k_best_lib(scores, param, group)
    if mode == "fpr":
        return select_fpr(scores, param, group)
    if mode == "fdr":
        return select_fdr(scores, param, group)
    if mode == "fwe":
        return select_fwe(scores, param, group)
    raise ValueError(f"mode {mode!r} is not supported")


def univariate_report(selected: DataFrame, feature: str = "feature", group: Sequence[str] = ()) -> DataFrame:
    """Feature, score and p-value of the kept features."""
    return selected.where("selected").select(*_g(group), F.col(feature).alias("feature_name"), "score", "pvalue")


def parse_threshold(threshold):
    """'mean', 'median', '1.25*mean' or a number -> (kind, factor)."""
    if isinstance(threshold, (int, float)) and not isinstance(threshold, bool):
        return "value", float(threshold)
    t = str(threshold).strip().lower().replace(" ", "")
    if "*" in t:
        f, ref = t.split("*", 1)
        if ref not in ("mean", "median"):
            raise ValueError(f"unknown threshold reference {ref!r}")
        return ref, float(f)
    if t in ("mean", "median"):
        return t, 1.0
    return "value", float(t)


def threshold_select(importances: DataFrame, threshold="mean", group=(), col: str = "importance",
                     absolute: bool = True) -> DataFrame:
    """Keep importance >= threshold (``mean``, ``median``, ``c*mean``, ``c*median`` or a number).

    With ``absolute=True`` the magnitude is compared (coefficients of L1 models).
    """
    g = _g(group)
    kind, factor = parse_threshold(threshold)
    mag = F.abs(F.col(col)) if absolute else F.col(col)
    d = importances.withColumn("_mag", mag)
    if kind == "value":
        thr = F.lit(factor)
        d = d.withColumn("_thr", thr)
    elif kind == "mean":
        d = d.withColumn("_thr", F.lit(factor) * F.avg("_mag").over(_over(group)))
    else:
        q = exact_quantile(d, g, "_mag", 0.5, "_med")
        d = (d.join(q, g, "inner") if g else d.withColumn("_med", q.select("_med").scalar()))
        d = d.withColumn("_thr", F.lit(factor) * F.col("_med")).drop("_med")
    return d.withColumn("selected", F.col("_mag") >= F.col("_thr")).drop("_mag", "_thr")
