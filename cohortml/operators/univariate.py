"""Univariate feature scores over the LONG layout.

Input: rows ``(keys..., value, label)``, where ``keys`` is ``["feature"]`` or
``["fold", "feature"]``; every function returns one row per key with
``score`` and (where defined) ``pvalue``. All folds and features are scored
in one job.

Rank-based scores never join ranks back to the sample rows: rows are first
collapsed to distinct ``(keys, value[, label])`` counts, mid-ranks come from
the block-wise running count, and the statistics are sums over the distinct
values.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortml.functions import safe_corr

from cohortml.functions.ordered import mid_ranks, row_numbers, running_totals
from cohortml.functions.special import digamma_int, pvalue_chi2, pvalue_f, pvalue_r
from cohortml.session import ensure_checkpoint_dir

_LABEL = "label"


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _constant_guard(out: DataFrame, constant_col: str) -> DataFrame:
    """Constant feature -> score 0, p-value 1."""
    return (out.withColumn("score", F.when(F.col(constant_col), F.lit(0.0)).otherwise(F.col("score")))
            .withColumn("pvalue", F.when(F.col(constant_col), F.lit(1.0)).otherwise(F.col("pvalue")))
            .drop(constant_col))


# ------------------------------------------------------------ correlation family
def correlation(df: DataFrame, keys: Sequence[str] = ("feature",), value: str = "value",
                label: str = _LABEL) -> DataFrame:
    """Signed Pearson r, row count and a constant flag per key."""
    k = _keys(keys)
    return (df.groupBy(*k)
            .agg(safe_corr(F.col(value), F.col(label).cast("double")).alias("r"),
                 F.count(F.lit(1)).alias("n"),
                 (F.min(value) == F.max(value)).alias("_const")))


def score_pearson(df: DataFrame, keys=("feature",), value="value", label=_LABEL,
                  with_pvalue: bool = True) -> DataFrame:
    """|r| with the label and the two-sided p-value; constant feature -> (0, 1)."""
    c = correlation(df, keys, value, label)
    out = c.select(*_keys(keys), "n", "_const", F.abs(F.coalesce("r", F.lit(0.0))).alias("score"),
                   (pvalue_r(F.col("r"), F.col("n")) if with_pvalue else F.lit(None).cast("double"))
                   .alias("pvalue"))
    return _constant_guard(out, "_const")


def score_r_regression(df: DataFrame, keys=("feature",), value="value", label=_LABEL) -> DataFrame:
    """Signed Pearson r (no p-value)."""
    c = correlation(df, keys, value, label)
    return c.select(*_keys(keys), "n", F.coalesce("r", F.lit(0.0)).alias("score"),
                    F.lit(None).cast("double").alias("pvalue"))


def score_f_regression(df: DataFrame, keys=("feature",), value="value", label=_LABEL,
                       with_pvalue: bool = True) -> DataFrame:
    """F = r^2 / (1 - r^2) * (n - 2) with its F(1, n-2) tail."""
    c = correlation(df, keys, value, label)
    r2 = F.pow(F.coalesce("r", F.lit(0.0)), 2)
    f = F.try_divide(r2, F.lit(1.0) - r2) * (F.col("n") - F.lit(2))
    out = c.select(*_keys(keys), "n", f.alias("score"))
    return out.withColumn("pvalue", pvalue_f(F.col("score"), F.lit(1.0), F.col("n") - F.lit(2))
                          if with_pvalue else F.lit(None).cast("double"))


def score_spearman(df: DataFrame, keys=("feature",), value="value", label=_LABEL,
                   with_pvalue: bool = True) -> DataFrame:
    """|rho| on mid-ranks with the two-sided p-value; constant feature -> (0, 1)."""
    k = _keys(keys)
    # label mid-ranks per key: one row per (keys, class)
    yc = df.groupBy(*k, label).agg(F.count(F.lit(1)).alias("cnt"))
    yr = mid_ranks(yc, k, label, "cnt", "ry")
    n = yc.groupBy(*k).agg(F.sum("cnt").alias("n"))
    yr = yr.join(n, k, "inner").withColumn("ryc", F.col("ry") - (F.col("n") + F.lit(1)) / F.lit(2.0))
    syy = yr.groupBy(*k).agg(F.sum(F.col("cnt") * F.col("ryc") * F.col("ryc")).alias("syy"))
    # distinct feature values with the summed centred label rank of their rows
    dv = (df.join(yr.select(*k, label, "ryc"), k + [label], "inner")
          .groupBy(*k, value).agg(F.count(F.lit(1)).alias("cnt"), F.sum("ryc").alias("sy")))
    xr = mid_ranks(dv, k, value, "cnt", "rx").join(n, k, "inner")
    xr = xr.withColumn("rxc", F.col("rx") - (F.col("n") + F.lit(1)) / F.lit(2.0))
    agg = xr.groupBy(*k).agg(F.first("n").alias("n"),
                             F.sum(F.col("rxc") * F.col("sy")).alias("sxy"),
                             F.sum(F.col("cnt") * F.col("rxc") * F.col("rxc")).alias("sxx"),
                             (F.count(F.lit(1)) <= 1).alias("_const"))
    j = agg.join(syy, k, "inner")
    rho = F.try_divide(F.col("sxy"), F.sqrt(F.col("sxx") * F.col("syy")))  # null for a constant feature
    out = j.select(*k, "n", "_const", rho.alias("rho"))
    out = out.select(*k, "n", "_const", F.abs(F.coalesce("rho", F.lit(0.0))).alias("score"),
                     (pvalue_r(F.col("rho"), F.col("n")) if with_pvalue else F.lit(None).cast("double"))
                     .alias("pvalue"))
    return _constant_guard(out, "_const")


# ------------------------------------------------------------ class-wise tests
def _value_label_counts(df, k, value, label):
    return df.groupBy(*k, value, label).agg(F.count(F.lit(1)).alias("cnt"))


def kruskal_stats(df: DataFrame, keys=("feature",), value="value", label=_LABEL) -> DataFrame:
    """H (tie-corrected), number of classes and flags per key."""
    k = _keys(keys)
    d3 = _value_label_counts(df, k, value, label)
    ranked = mid_ranks(d3, k, value, "cnt", "rank")
    # one pass over the ranked table: class rank sums and, per class, its share of the tie term
    per_class = ranked.groupBy(*k, label).agg(
        F.sum(F.col("rank") * F.col("cnt")).alias("R"), F.sum("cnt").alias("n_g"),
        F.sum((F.col("ties") * F.col("ties") - F.lit(1.0)) * F.col("cnt")).alias("_ts"),
        F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    j = per_class.groupBy(*k).agg(F.sum(F.col("R") * F.col("R") / F.col("n_g")).alias("srn"),
                                  F.sum("n_g").alias("n"), F.count(F.lit(1)).alias("n_classes"),
                                  F.sum("_ts").alias("tie_sum"), (F.min("_mn") == F.max("_mx")).alias("_const"))
    n = F.col("n").cast("double")
    h = F.lit(12.0) / (n * (n + F.lit(1.0))) * F.col("srn") - F.lit(3.0) * (n + F.lit(1.0))
    corr = F.lit(1.0) - F.col("tie_sum") / (n * n * n - n)
    return j.select(*k, "n", "n_classes", "_const", F.try_divide(h, corr).alias("H"))


def score_kruskal(df: DataFrame, keys=("feature",), value="value", label=_LABEL,
                  with_pvalue: bool = True) -> DataFrame:
    """Kruskal-Wallis H with its chi-square(K-1) tail; constant feature or one class -> (0, 1)."""
    k = _keys(keys)
    s = kruskal_stats(df, k, value, label)
    degenerate = F.col("_const") | (F.col("n_classes") < 2)
    out = s.select(*k, "n", F.col("H").alias("score"),
                   (pvalue_chi2(F.col("H"), F.col("n_classes") - F.lit(1)) if with_pvalue
                    else F.lit(None).cast("double")).alias("pvalue"),
                   degenerate.alias("_deg"))
    return _constant_guard(out, "_deg")


def score_f_classif(df: DataFrame, keys=("feature",), value="value", label=_LABEL,
                    with_pvalue: bool = True) -> DataFrame:
    """One-way ANOVA F; constant feature -> (0, 1)."""
    k = _keys(keys)
    g = df.groupBy(*k, label).agg(F.count(F.lit(1)).alias("n_g"), F.avg(value).alias("m_g"),
                                  F.var_pop(value).alias("v_g"))
    tot = df.groupBy(*k).agg(F.avg(value).alias("m"), F.count(F.lit(1)).alias("n"))
    j = g.join(tot, k, "inner")
    a = j.groupBy(*k).agg(
        F.sum(F.col("n_g") * F.pow(F.col("m_g") - F.col("m"), 2)).alias("ssb"),
        F.sum(F.col("n_g") * F.col("v_g")).alias("ssw"),
        F.first("n").alias("n"), F.count(F.lit(1)).alias("n_classes"))
    d1 = F.col("n_classes") - F.lit(1)
    d2 = F.col("n") - F.col("n_classes")
    f = F.try_divide(F.try_divide(F.col("ssb"), d1), F.try_divide(F.col("ssw"), d2))
    out = a.select(*k, "n", "n_classes", f.alias("score"), (F.col("ssw") == 0).alias("_deg"))
    out = out.withColumn("pvalue", pvalue_f(F.col("score"), d1, d2) if with_pvalue
                         else F.lit(None).cast("double")).drop("n_classes")
    return _constant_guard(out, "_deg")


def score_chi2(df: DataFrame, keys=("feature",), value="value", label=_LABEL,
               with_pvalue: bool = True) -> DataFrame:
    """Sum of (O - E)^2 / E over classes with O = class sum of x, E = class share x total.
    Values are counts: a negative one is an error."""
    k = _keys(keys)
    checked = F.when(F.col(value) < 0, F.raise_error(F.lit("chi-square scores need non-negative values"))
                     .cast("double")).otherwise(F.col(value))
    g = df.groupBy(*k, label).agg(F.sum(checked).alias("o"), F.count(F.lit(1)).alias("n_c"))
    tot = g.groupBy(*k).agg(F.sum("o").alias("t"), F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("K"))
    j = g.join(tot, k, "inner").withColumn("e", F.col("n_c") / F.col("n") * F.col("t"))
    a = j.groupBy(*k).agg(F.sum(F.try_divide(F.pow(F.col("o") - F.col("e"), 2), F.col("e"))).alias("score"),
                          F.first("K").alias("K"), F.first("n").alias("n"))
    return a.select(*k, "n", "score",
                    (pvalue_chi2(F.col("score"), F.col("K") - F.lit(1)) if with_pvalue
                     else F.lit(None).cast("double")).alias("pvalue"))


# ------------------------------------------------------------ distance correlation
def score_distancecorr(df: DataFrame, keys=("feature",), value="value", label=_LABEL,
                       classes: Sequence[int] | None = None) -> DataFrame:
    """Distance correlation of x with the label, in O(n log n).

    A label of at most 64 integer classes takes the class form below; any other numeric label, and
    any number of classes, takes :func:`_distancecorr_any`, which gives the same values.

    With a_i = mean_j |x_i - x_j| (from prefix counts and sums at x_i), and the
    class-pair sums D_kl = sum_{i in k, j in l} |x_i - x_j| (from per-class
    prefix sums), every term of the double-centred statistic is a sum over
    distinct ``(value, class)`` rows; no pair of rows is ever formed.
    """
    k = _keys(keys)
    if classes is None:
        classes = [r[0] for r in df.select(label).distinct().limit(65).collect()]
        if len(classes) > 64 or any(c is None or float(c) != int(c) for c in classes):
            return _distancecorr_any(df, k, value, label)
    classes = sorted(int(c) for c in classes)
    d3 = (df.groupBy(*k, value, label)
          .agg(F.count(F.lit(1)).cast("double").alias("cnt"), F.sum(value).alias("sv")))
    sums = {"C": F.col("cnt"), "S": F.col("sv")}
    for c in classes:
        sums[f"C{c}"] = F.when(F.col(label) == c, F.col("cnt")).otherwise(F.lit(0.0))
        sums[f"S{c}"] = F.when(F.col(label) == c, F.col("sv")).otherwise(F.lit(0.0))
    rt = running_totals(d3, k, [value], sums, peers=True, peer_totals=True)
    tot = d3.groupBy(*k).agg(
        F.sum("cnt").alias("n"), F.sum("sv").alias("T"),
        *[F.sum(F.when(F.col(label) == c, F.col("cnt")).otherwise(0.0)).alias(f"n{c}") for c in classes],
        *[F.sum(F.when(F.col(label) == c, F.col("sv")).otherwise(0.0)).alias(f"T{c}") for c in classes],
    )
    j = rt.join(tot, k, "inner")
    v, cnt, n = F.col(value), F.col("cnt"), F.col("n")
    # counts and sums strictly below v (whole data and per class)
    L = F.col("C") - F.col("C_grp")
    SL = F.col("S") - F.col("S_grp")
    # a(v) = mean_j |v - x_j| = (v (2L - n) - 2 SL + T) / n with L, SL strictly below v
    a = (v * (F.lit(2.0) * L - n) - F.lit(2.0) * SL + F.col("T")) / n
    lab = F.col(label).cast("double")
    b = None
    cross = None
    for c in classes:
        Lc = F.col(f"C{c}") - F.col(f"C{c}_grp")
        SLc = F.col(f"S{c}") - F.col(f"S{c}_grp")
        row_sum_c = v * (F.lit(2.0) * Lc - F.col(f"n{c}")) - F.lit(2.0) * SLc + F.col(f"T{c}")
        dist = F.abs(lab - F.lit(float(c)))
        term_b = dist * F.col(f"n{c}")
        term_x = dist * row_sum_c
        b = term_b if b is None else b + term_b
        cross = term_x if cross is None else cross + term_x
    b = b / n
    per = j.select(*k, "cnt", "n", a.alias("a"), b.alias("b"), cross.alias("cross"), v.alias("x"),
                   lab.alias("y"))
    agg = per.groupBy(*k).agg(
        F.first("n").alias("n"),
        (F.sum(F.col("cnt") * F.col("cross")) / F.pow(F.first("n"), 2)).alias("m_ab"),
        (F.sum(F.col("cnt") * F.col("a") * F.col("b")) / F.first("n")).alias("m_a_b"),
        (F.sum(F.col("cnt") * F.col("a")) / F.first("n")).alias("ma"),
        (F.sum(F.col("cnt") * F.col("b")) / F.first("n")).alias("mb"),
        (F.sum(F.col("cnt") * F.col("a") * F.col("a")) / F.first("n")).alias("maa"),
        (F.sum(F.col("cnt") * F.col("b") * F.col("b")) / F.first("n")).alias("mbb"),
        (F.sum(F.col("cnt") * F.col("x")) / F.first("n")).alias("mx"),
        (F.sum(F.col("cnt") * F.col("x") * F.col("x")) / F.first("n")).alias("mxx"),
        (F.sum(F.col("cnt") * F.col("y")) / F.first("n")).alias("my"),
        (F.sum(F.col("cnt") * F.col("y") * F.col("y")) / F.first("n")).alias("myy"))
    return _dcor(agg, k)


def _dcor(agg: DataFrame, k) -> DataFrame:
    """The correlation from the moments of the two distance matrices."""
    var_x = F.col("mxx") - F.col("mx") * F.col("mx")
    var_y = F.col("myy") - F.col("my") * F.col("my")
    dcov = F.col("m_ab") - F.lit(2.0) * F.col("m_a_b") + F.col("ma") * F.col("mb")
    dvx = F.lit(2.0) * var_x - F.lit(2.0) * F.col("maa") + F.col("ma") * F.col("ma")
    dvy = F.lit(2.0) * var_y - F.lit(2.0) * F.col("mbb") + F.col("mb") * F.col("mb")
    den = F.sqrt(dvx * dvy)
    dcor = F.when(den > 0, F.sqrt(F.greatest(dcov, F.lit(0.0)) / den)).otherwise(F.lit(0.0))
    return agg.select(*k, "n", dcor.alias("score"), F.lit(None).cast("double").alias("pvalue"))


def _distancecorr_any(df: DataFrame, k, value: str, label: str) -> DataFrame:
    """Distance correlation with any numeric label, without pairs of rows.

    Distinct points (value, label) with their counts are ranked by value. Two ranks first differ in
    one binary digit; at that level they lie in the left and the right half of one node. So the sum
    of |x_i - x_j| |y_i - y_j| over pairs is a sum over levels and nodes, and inside a node, along
    y, the right half enters by running counts and sums alone: n log n rows, one running total.
    """
    pts = (df.groupBy(*k, F.col(value).cast("double").alias("v"), F.col(label).cast("double").alias("y"))
           .agg(F.count(F.lit(1)).cast("double").alias("w")))
    pts = row_numbers(pts, k, ["v", "y"], "r")
    wv, wy = F.col("w") * F.col("v"), F.col("w") * F.col("y")
    tot = pts.groupBy(*k).agg(F.sum("w").alias("n"), F.sum(wv).alias("T"), F.sum(wy).alias("U"), F.max("r").alias("last"))
    top = tot.agg(F.max("last")).first()[0] or 1
    means = running_totals(pts, k, ["v"], {"Cx": F.col("w"), "Sx": wv}, peers=True)
    means = running_totals(means, k, ["y"], {"Cy": F.col("w"), "Sy": wy}, peers=True).join(tot, k, "inner")

    def mean_distance(x, count, total, whole):
        # counts and sums up to and including x; equal values add nothing
        return (x * (F.lit(2.0) * F.col(count) - F.col("n")) - F.lit(2.0) * F.col(total) + F.col(whole)) / F.col("n")

    a, b = mean_distance(F.col("v"), "Cx", "Sx", "T"), mean_distance(F.col("y"), "Cy", "Sy", "U")
    per = means.select(*k, "n", "w", "v", "y", a.alias("a"), b.alias("b"))

    levels = pts.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(max(int(top - 1).bit_length() - 1, 0)))))
    levels = levels.withColumn("node", F.expr("shiftright(r - 1, level + 1)"))
    levels = levels.withColumn("right", F.expr("shiftright(r - 1, level) & 1").cast("double"))
    right = F.col("w") * F.col("right")
    sums = {"c0": right, "cx": right * F.col("v"), "cy": right * F.col("y"), "cxy": right * F.col("v") * F.col("y")}
    node = [*k, "level", "node"]
    whole = levels.groupBy(*node).agg(*[F.sum(e).alias(f"N{n}") for n, e in sums.items()])
    run = running_totals(levels, node, ["y"], sums, peers=True).where("right = 0").join(whole, node, "inner")
    x, y = F.col("v"), F.col("y")

    def part(c0, cx, cy, cxy):
        """Sum over right points of (x_j - x_i)(y_i - y_j)."""
        return cx * y - cxy - x * y * c0 + x * cy

    below = part(*[F.col(n) for n in sums])
    above = part(*[F.col(f"N{n}") - F.col(n) for n in sums])
    pairs = run.groupBy(*k).agg(F.sum(F.col("w") * (below - above)).alias("pairs"))

    def mean(e):
        return F.sum(F.col("w") * e) / F.first("n")

    agg = per.groupBy(*k).agg(
        F.first("n").alias("n"), mean(F.col("a") * F.col("b")).alias("m_a_b"), mean(F.col("a")).alias("ma"),
        mean(F.col("b")).alias("mb"), mean(F.col("a") * F.col("a")).alias("maa"), mean(F.col("b") * F.col("b")).alias("mbb"),
        mean(F.col("v")).alias("mx"), mean(F.col("v") * F.col("v")).alias("mxx"),
        mean(F.col("y")).alias("my"), mean(F.col("y") * F.col("y")).alias("myy"))
    agg = agg.join(pairs, k, "left").withColumn(
        "m_ab", F.lit(2.0) * F.coalesce("pairs", F.lit(0.0)) / F.pow("n", F.lit(2.0))).drop("pairs")
    return _dcor(agg, k)


# ------------------------------------------------------------ mutual information (discrete y)
MI_NEIGHBORS = 3


def score_mutual_info_classif(df: DataFrame, keys=("feature",), value="value", label=_LABEL,
                              n_neighbors: int = MI_NEIGHBORS, scale: bool = True,
                              key: str = "row_id", per_row: bool = False) -> DataFrame:
    """kNN mutual information between a continuous feature and a class label (Ross, 2014).

    In one dimension the distance to the k-th same-class neighbour of x_i is
    ``min_{j=0..k} max(x_i - x_(i-j), x_(i+k-j) - x_i)`` on the sorted class
    values. Positions come from the block-wise running count; each row then
    sends its value to the 2k+1 positions around it, so every neighbourhood
    is a group of at most 2k+1 rows. The count m_i of all rows within the
    radius comes from running counts over the merged list of distinct values and
    interval endpoints. Classes with one row are left out; ties keep their
    distance 0 (no jitter is added).
    """
    k = _keys(keys)
    K = int(n_neighbors)
    base = df.select(*k, key, F.col(value).cast("double").alias("x"), F.col(label).alias("y"))
    if scale:  # x / population std over all rows of the feature
        # written once (a row per feature): summed in another order it differs by a rounding, and equal values would not meet
        ensure_checkpoint_dir(df.sparkSession)
        sd = base.groupBy(*k).agg(F.stddev_pop("x").alias("_sd")).checkpoint(eager=True)
        base = (base.join(sd, k, "inner")
                .withColumn("x", F.when(F.col("_sd") > 0, F.col("x") / F.col("_sd")).otherwise(F.col("x")))
                .drop("_sd"))
    sizes = base.groupBy(*k, "y").agg(F.count(F.lit(1)).alias("n_c"))
    base = base.join(sizes, k + ["y"], "inner").where(F.col("n_c") > 1)
    pos = running_totals(base, k + ["y"], ["x", key], {"p": F.lit(1).cast("bigint")})
    # neighbourhood slots: the row at position p is seen from targets p - d, d in [-K, K]
    offs = F.explode(F.sequence(F.lit(-K), F.lit(K))).alias("d")
    sent = pos.select(*k, "y", "n_c", "p", "x", offs).withColumn("target", F.col("p") - F.col("d"))
    sent = sent.where((F.col("target") >= 1) & (F.col("target") <= F.col("n_c")))
    hood = sent.groupBy(*k, "y", "target").agg(
        F.first("n_c").alias("n_c"),
        *[F.max(F.when(F.col("d") == j, F.col("x"))).alias(f"x{j + K}") for j in range(-K, K + 1)])
    big = F.lit(float("inf"))
    xc = F.col(f"x{K}")

    def kth(kc: int):
        cands = []
        for j in range(kc + 1):
            left = xc - F.col(f"x{K - j}")
            right = F.col(f"x{K + kc - j}") - xc
            # a missing neighbour (null) makes the window invalid; greatest() would skip it
            cands.append(F.when(left.isNull() | right.isNull(), big).otherwise(F.greatest(left, right)))
        return F.least(*cands) if len(cands) > 1 else cands[0]

    kc = F.least(F.lit(K), F.col("n_c") - F.lit(1))
    rad = kth(K)
    for v in range(1, K):
        rad = F.when(kc == v, kth(v)).otherwise(rad)
    rows = hood.select(*k, F.col("target").alias("_pos"), "y", xc.alias("x"), "n_c",
                       kc.alias("k_i"), rad.alias("r"))
    # Rows of a class with the same value and radius have the same m_i: they go on as one row with a
    # count, and so do equal values, so that a value held by half of all rows is no large peer group.
    alike = [*k, "y", "x", "n_c", "k_i", "r"]
    spots = rows.groupBy(*alike).agg(F.count(F.lit(1)).alias("copies"), F.min("_pos").alias("_spot"))
    # m_i = #{j : |x_j - x_i| < r_i}, or #{x_j == x_i} when r_i = 0; self included.
    # Upper end counts values below it, lower end values at or below it
    # (reversed when r = 0); ordering endpoints before (0) or after (2) equal values does that.
    vals = (base.groupBy(*k, F.col("x").alias("pt")).agg(F.count(F.lit(1)).alias("held"))
            .select(*k, "pt", F.lit(1).alias("_o"), F.lit(0).alias("sgn"), "held"))
    # x +/- r can round past the neighbour that defines r; a value within a
    # relative 1e-11 of an endpoint is taken to lie at distance r (excluded).
    tol = F.lit(1e-11) * (F.abs(F.col("x")) + F.col("r"))
    ends = []
    for sgn, pt in ((1, F.col("x") + F.col("r") - tol), (-1, F.col("x") - F.col("r") + tol)):
        # a radius within that (means that differ by rounding alone) is like 0: x itself is never left out
        own = (F.col("r") == 0) | (pt <= F.col("x") if sgn == 1 else pt >= F.col("x"))
        before = ~own if sgn == 1 else own
        pt = F.when(own, F.col("x")).otherwise(pt)
        ends.append(spots.select(*k, pt.alias("pt"), F.when(before, F.lit(0)).otherwise(F.lit(2)).alias("_o"),
                                 F.lit(sgn).alias("sgn"), "y", "_spot", "k_i", "n_c", "copies"))
    evs = vals.unionByName(ends[0], allowMissingColumns=True).unionByName(ends[1], allowMissingColumns=True)
    counted = running_totals(evs, k, ["pt", "_o"], {"below": F.coalesce(F.col("held"), F.lit(0))}, peers=True)
    m = (counted.where(F.col("sgn") != 0)
         .groupBy(*k, "y", "_spot")
         .agg(F.sum(F.col("sgn") * F.col("below")).alias("m"),
              F.first("k_i").alias("k_i"), F.first("n_c").alias("n_c"), F.first("copies").alias("copies")))
    if per_row:  # (keys, class, position, k_i, n_c, m), for tests
        found = m.join(spots.select(*k, "y", "_spot", "x", "r"), k + ["y", "_spot"]).drop("_spot", "copies")
        return found.join(rows.select(*k, "y", "_pos", "x", "r"), k + ["y", "x", "r"], "inner")

    def mean(v):
        return F.sum(F.col("copies") * digamma_int(F.col(v))) / F.sum("copies")

    agg = m.groupBy(*k).agg(F.sum("copies").alias("n"), mean("k_i").alias("psi_k"), mean("n_c").alias("psi_nc"), mean("m").alias("psi_m"))
    mi = digamma_int(F.col("n")) + F.col("psi_k") - F.col("psi_nc") - F.col("psi_m")
    return agg.select(*k, "n", F.greatest(mi, F.lit(0.0)).alias("score"),
                      F.lit(None).cast("double").alias("pvalue"))


SCORERS = {
    "pearson": score_pearson,
    "spearman": score_spearman,
    "kruskal": score_kruskal,
    "distancecorr": score_distancecorr,
    "f_classif": score_f_classif,
    "chi2": score_chi2,
    "f_regression": score_f_regression,
    "r_regression": score_r_regression,
    "mutual_info_classif": score_mutual_info_classif,
}

OWN_FUNCTIONS = ("pearson", "spearman", "distancecorr", "kruskal")


def score(df: DataFrame, function: str, keys=("feature",), **kw) -> DataFrame:
    if function not in SCORERS:
        raise ValueError(f"unknown score function {function!r}")
    return SCORERS[function](df, keys, **kw)


# ------------------------------------------------------------ mutual information (continuous y)
def _count_in_ball(rows, k, ids, c, r, vals, rel_tol=1e-11):
    """Per row: #values v with |v - c| < r (or v == c when r == 0), via running counts over
    the merged list of values and interval ends (a relative band guards the ends)."""
    r0 = F.col(r) == 0
    tol = F.lit(rel_tol) * (F.abs(F.col(c)) + F.col(r))
    v = vals.select(*k, F.col("v").alias("pt"), F.lit(1).alias("_o"), F.lit(0).alias("sgn"))
    ends = []
    for sgn, pt in ((1, F.col(c) + F.col(r) - tol), (-1, F.col(c) - F.col(r) + tol)):
        before = ~r0 if sgn == 1 else r0
        pt = F.when(r0, F.col(c)).otherwise(pt)
        ends.append(rows.select(*k, *ids, pt.alias("pt"), F.when(before, 0).otherwise(2).alias("_o"),
                                F.lit(sgn).alias("sgn")))
    evs = v.unionByName(ends[0], allowMissingColumns=True).unionByName(ends[1], allowMissingColumns=True)
    counted = running_totals(evs, k, ["pt", "_o"], {"below": F.when(F.col("sgn") == 0, 1).otherwise(0)},
                             peers=True)
    return (counted.where(F.col("sgn") != 0).groupBy(*k, *ids)
            .agg(F.sum(F.col("sgn") * F.col("below")).alias("cnt")))


#: Rows aimed at per cell of the neighbour search.
MI_CELL = 256


def _nearest(d: np.ndarray, k: int) -> np.ndarray:
    """The k smallest values of every row, rising, filled up with infinity."""
    d = np.where(np.isnan(d), np.inf, d)
    d = np.sort(np.partition(d, k - 1, axis=1)[:, :k] if d.shape[1] > k else d, axis=1)
    return np.pad(d, ((0, 0), (0, k - d.shape[1])), constant_values=np.inf)


def _kth_distance(rows, k, key, K):
    """``(keys, key, eps)``: exact distance in max-norm of ``(x, y)`` to the K-th nearest row of another key.

    The rows of a group are cut into strips along x and these into cells of about ``MI_CELL`` rows along y. A row's
    own cell bounds its distance; other cells are searched only if their box meets the square of that radius. The
    distance is zero or the square is small, so few rows visit other cells. Equal x (y) are ordered by y (x)."""
    size = rows.groupBy(*k).agg(F.count(F.lit(1)).alias("_n"))
    d = running_totals(rows, k, ["x", "y", key], {"_px": F.lit(1).cast("bigint")}).join(F.broadcast(size), k)
    strips = F.ceil(F.sqrt(F.ceil(F.col("_n") / F.lit(MI_CELL))))
    d = d.select(*k, key, "x", "y", F.floor((F.col("_px") - 1) * strips / F.col("_n")).cast("int").alias("_s"))
    w = Window.partitionBy(*k, "_s")  # a strip grows with the root of the rows
    place, held = F.row_number().over(w.orderBy("y", "x", key)), F.count(F.lit(1)).over(w)
    d = d.withColumns({"_py": place, "_m": held})
    cell = F.floor((F.col("_py") - 1) * F.ceil(F.col("_m") / F.lit(MI_CELL)) / F.col("_m")).cast("int")
    d = d.select(*k, key, "x", "y", "_s", cell.alias("_c")).checkpoint(eager=True)
    at = [*k, "_s", "_c"]
    out = T.StructType([*d.schema.fields, T.StructField("ub", T.DoubleType()), T.StructField("_near", T.ArrayType(T.DoubleType()))])
    step = 4 * MI_CELL

    def distances(q, r):
        x, y, ids = (r[c].to_numpy() for c in ("x", "y", key))
        found = []
        for i in range(0, len(q), step):
            part = q.iloc[i:i + step]
            far = np.maximum(np.abs(part["x"].to_numpy()[:, None] - x), np.abs(part["y"].to_numpy()[:, None] - y))
            found.append(_nearest(np.where(part[key].to_numpy()[:, None] == ids, np.inf, far), K))
        return np.concatenate(found)

    def within(pdf):
        near = distances(pdf, pdf)
        return pdf.assign(ub=near[:, -1], _near=list(near))

    own = d.groupBy(*at).applyInPandas(within, out).checkpoint(eager=True)
    boxes = d.groupBy(*at).agg(*[f(c).alias(f"_{n}{c}") for c in ("x", "y") for n, f in (("lo", F.min), ("hi", F.max))])
    strip = boxes.groupBy(*k, "_s").agg(F.min("_lox").alias("_lox"), F.max("_hix").alias("_hix"))
    meets = lambda c: (F.col(c) - F.col("ub") <= F.col(f"_hi{c}")) & (F.col(c) + F.col("ub") >= F.col(f"_lo{c}"))
    asked = own.where("ub > 0").select(*k, key, "x", "y", "ub", F.col("_s").alias("_s0"), F.col("_c").alias("_c0"))
    asked = asked.join(F.broadcast(strip), k).where(meets("x")).drop("_lox", "_hix")
    asked = asked.join(boxes, [*k, "_s"]).where(meets("x") & meets("y") & ~((F.col("_s") == F.col("_s0")) & (F.col("_c") == F.col("_c0"))))
    answer = T.StructType([*[d.schema[c] for c in (*k, key)], T.StructField("_near", T.ArrayType(T.DoubleType()))])

    def across(q, r):
        if not len(q) or not len(r):
            return pd.DataFrame({f.name: pd.Series([], dtype=object) for f in answer.fields})
        return q[[*k, key]].assign(_near=list(distances(q, r)))

    asked, cells = (t.select(*[F.col(c).alias(c) for c in (*at, key, "x", "y")]) for t in (asked, d))  # columns of their own
    other = asked.groupBy(*at).cogroup(cells.groupBy(*at)).applyInPandas(across, answer)
    near = own.select(*k, key, "_near").unionByName(other).groupBy(*k, key).agg(F.flatten(F.collect_list("_near")).alias("_near"))
    finite = F.filter("_near", lambda v: v < F.lit(float("inf")))
    return near.select(*k, key, F.element_at(F.array_sort(finite), K).alias("eps"))


def score_mutual_info_regression(df: DataFrame, keys=("feature",), value="value", label=_LABEL,
                                 n_neighbors: int = MI_NEIGHBORS, key: str = "row_id") -> DataFrame:
    """kNN mutual information of two continuous variables (Kraskov et al., 2004), exact.

    With x and y scaled by their population std, eps_i is the distance to the
    k-th neighbour in max-norm; MI = psi(n) + psi(k) - <psi(n_x + 1) + psi(n_y + 1)>
    with n_x = #{j != i : |x_j - x_i| < eps_i}. The neighbours are searched in cells of the plane, see
    :func:`_kth_distance`.
    """
    k = _keys(keys)
    K = int(n_neighbors)
    base = df.select(*k, key, F.col(value).cast("double").alias("x"), F.col(label).cast("double").alias("y"))
    sd = base.groupBy(*k).agg(F.stddev_pop("x").alias("_sx"), F.stddev_pop("y").alias("_sy"))
    base = (base.join(sd, k, "inner")
            .withColumn("x", F.when(F.col("_sx") > 0, F.col("x") / F.col("_sx")).otherwise(F.col("x")))
            .withColumn("y", F.when(F.col("_sy") > 0, F.col("y") / F.col("_sy")).otherwise(F.col("y")))
            .drop("_sx", "_sy"))
    rows = base.checkpoint(eager=True)
    eps = _kth_distance(rows.where(F.col(key).isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull()), k, key, K)
    e = rows.join(eps, k + [key], "inner").checkpoint(eager=True)
    nx = _count_in_ball(e, k, [key], "x", "eps", rows.select(*k, F.col("x").alias("v")))
    ny = _count_in_ball(e, k, [key], "y", "eps", rows.select(*k, F.col("y").alias("v")))
    cnt = (nx.withColumnRenamed("cnt", "nx").join(ny.withColumnRenamed("cnt", "ny"), k + [key], "inner"))
    agg = cnt.groupBy(*k).agg(F.count(F.lit(1)).alias("n"),
                              F.avg(digamma_int(F.col("nx"))).alias("psx"),
                              F.avg(digamma_int(F.col("ny"))).alias("psy"))
    mi = digamma_int(F.col("n")) + digamma_int(F.lit(K)) - F.col("psx") - F.col("psy")
    return agg.select(*k, "n", F.greatest(mi, F.lit(0.0)).alias("score"), F.lit(None).cast("double").alias("pvalue"))


SCORERS["mutual_info_regression"] = score_mutual_info_regression
