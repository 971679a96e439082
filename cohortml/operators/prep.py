"""Column handling, imputation, scaling and class weights.

Statistics are fitted on one DataFrame (normally the training rows) and
applied to another through small per-feature tables joined on the key; the
optimizer broadcasts those tables when their measured size allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortml.functions.hashing import hash_int
from cohortml.functions.ordered import running_totals


# ------------------------------------------------------------ columns
def drop_columns(df: DataFrame, cols: Sequence[str] | None, label: str | None = None) -> DataFrame:
    """Drop the listed columns, never the label."""
    cols = [c for c in (cols or []) if c != label]
    return df.drop(*cols)


def cast_label(train: DataFrame, test: DataFrame | None, label: str):
    """Label to int; it must exist in both tables."""
    for name, d in (("train", train), ("test", test)):
        if d is not None and label not in d.columns:
            raise ValueError(f"label {label!r} missing from the {name} set")
    out = [train.withColumn(label, F.col(label).cast("int"))]
    if test is not None:
        out.append(test.withColumn(label, F.col(label).cast("int")))
    return tuple(out) if len(out) > 1 else out[0]


def split_xy(df: DataFrame, label: str, key: str = "row_id"):
    """Feature columns and the label as two projections sharing the key."""
    feats = [c for c in df.columns if c not in (label, key)]
    return df.select(key, *feats), df.select(key, label)


def log1p(df: DataFrame, col: str = "value") -> DataFrame:
    return df.withColumn(col, F.log1p(F.col(col)))


# ------------------------------------------------------------ quantiles
def exact_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float,
                   name: str = "quantile") -> DataFrame:
    """Exact quantile with linear interpolation (NumPy's default), one row per key.

    Distributed: values are counted per distinct value, positioned with the
    block-wise running count, and only the one or two order statistics that
    bracket ``q * (n - 1)`` are kept. Nulls are ignored.
    """
    keys = list(keys)
    base = df.where(F.col(value).isNotNull())
    counts = base.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    pos = running_totals(counts, keys, [value], {"_cum": F.col("_c")})
    if keys:
        p = pos.join(counts.groupBy(*keys).agg(F.sum("_c").alias("_n")), keys, "inner")
    else:  # one global count: a scalar subquery, no join
        p = pos.withColumn("_n", counts.select(F.sum("_c")).scalar())
    target = F.lit(float(q)) * (F.col("_n") - F.lit(1))
    lo, hi = F.floor(target), F.ceil(target)
    start = F.col("_cum") - F.col("_c")  # 0-based index of the first copy
    covers = lambda i: (start <= i) & (i < F.col("_cum"))
    picked = p.where(covers(lo) | covers(hi))
    agg = picked.groupBy(*keys).agg(
        F.min(F.when(covers(lo), F.col(value))).alias("_lo"),
        F.max(F.when(covers(hi), F.col(value))).alias("_hi"),
        F.first(target - lo).alias("_frac"))
    return agg.select(*keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias(name))


# ------------------------------------------------------------ imputation
def impute_median(df: DataFrame, cols: Sequence[str], fit: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the exact medians of the fitting rows (default: ``df`` itself).

    All columns are one job: their values are unpivoted, counted and positioned by ``(column, value)``. A column
    without values keeps its nulls."""
    fit = fit if fit is not None else df
    if not cols:
        return df
    long = fit.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s"))
    medians = exact_quantile(long.select("s.c", "s.v"), ["c"], "v", 0.5, "m")
    # one row per column: a scalar subquery
    found = medians.agg(F.map_from_entries(F.collect_list(F.struct("c", "m"))).alias("m")).scalar()
    out = df.withColumn("_medians", found)
    return out.withColumns({c: F.coalesce(F.col(c), F.try_element_at("_medians", F.lit(c))) for c in cols}).drop("_medians")


def mode_value(df: DataFrame, col: str) -> Column:
    """Most frequent non-null value; the smallest one on ties (scalar subquery)."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    best = counts.agg(F.min(F.struct((-F.col("_c")).alias("negc"), F.col(col).alias("v"))).alias("b"))
    return best.select("b.v").scalar()


def impute_mode(df: DataFrame, cols: Sequence[str], fit: DataFrame | None = None) -> DataFrame:
    fit = fit if fit is not None else df
    out = df
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), mode_value(fit, c)))
    return out


def impute(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
           passthrough: Sequence[str] = (), fit: DataFrame | None = None) -> DataFrame:
    """Median for numeric, mode for categorical, listed feature columns unchanged;
    every column not listed is dropped (as the reference's column mapper does)."""
    out = impute_mode(impute_median(df, numeric, fit), categorical, fit)
    return out.select(*numeric, *categorical, *passthrough)


# ------------------------------------------------------------ scaling
def scaler_stats(fit_long: DataFrame, keys: Sequence[str] = ("feature",), value: str = "value") -> DataFrame:
    """Per-feature mean and population std; zero std is replaced by 1."""
    return (fit_long.groupBy(*keys)
            .agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("_sd"))
            .select(*keys, "mean",
                    F.when(F.col("_sd").isNull() | (F.col("_sd") == 0), F.lit(1.0))
                     .otherwise(F.col("_sd")).alias("scale")))


def standard_scale(long: DataFrame, fit_long: DataFrame | None = None, keys: Sequence[str] = ("feature",),
                   value: str = "value") -> DataFrame:
    """(x - mean) / std with population std fitted on ``fit_long`` (LONG layout)."""
    stats = scaler_stats(fit_long if fit_long is not None else long, keys, value)
    return (long.join(stats, list(keys), "inner")
            .withColumn(value, (F.col(value) - F.col("mean")) / F.col("scale"))
            .drop("mean", "scale"))


# ------------------------------------------------------------ weights, samples
def balanced_weights(df: DataFrame, label: str = "label", name: str = "weight",
                     keys: Sequence[str] = ()) -> DataFrame:
    """``n / (K * n_c)`` per row, as ``class_weight='balanced'``."""
    keys = list(keys)
    per = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_n_c"))
    if keys:
        tot = per.groupBy(*keys).agg(F.sum("_n_c").alias("_n"), F.count(F.lit(1)).alias("_k"))
        w = per.join(tot, keys, "inner")
    else:  # global totals as scalar subqueries
        w = per.withColumns({"_n": per.select(F.sum("_n_c")).scalar(),
                             "_k": per.select(F.count(F.lit(1))).scalar()})
    w = w.select(*keys, label, (F.col("_n") / (F.col("_k") * F.col("_n_c"))).alias(name))
    return df.join(w, keys + [label], "inner")


def explain_sample(df: DataFrame, n: int, key: str = "row_id", seed=42) -> DataFrame:
    """``n`` rows without replacement in hash order (all rows if fewer)."""
    return df.orderBy(hash_int(seed, key), F.col(key)).limit(int(n))
