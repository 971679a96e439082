"""Tail probabilities and the digamma function, without SciPy.

The p-value functions run as Arrow-batched pandas UDFs over score tables,
which have one row per (fold, feature): small, and never the sample rows.
The numerics are the regularized incomplete beta and gamma functions,
evaluated by their continued fractions, from the far end inwards, and series,
vectorised with NumPy.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_EPS = 1e-16
_MAX_IT = 400
def lgamma(x) -> np.ndarray:
    x = np.asarray(x, dtype=float)
    return np.array([math.lgamma(v) for v in x.ravel()], dtype=float).reshape(x.shape)


def _terms(*sizes) -> int:
    """Terms after which the fractions below have converged: they need some multiple of the root."""
    return 200 + int(12.0 * math.sqrt(max(float(np.max(v)) for v in sizes)))


def _beta_fraction(a, b, x):
    """1 / (1 + d1 / (1 + d2 / (1 + ...))) of the incomplete beta function, from the far end inwards.

    d(2m) = m (b - m) x / ((a + 2m - 1)(a + 2m)), d(2m+1) = -(a + m)(a + b + m) x / ((a + 2m)(a + 2m + 1)).
    """
    f = np.ones_like(x)
    for k in range(2 * _terms(a, b), 0, -1):
        m = k // 2
        if k % 2:
            d = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        else:
            d = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        f = 1.0 + d / f
    return 1.0 / f


def betainc(a, b, x) -> np.ndarray:
    """Regularized incomplete beta I_x(a, b), elementwise."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(x, float))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0)
    out[ok & (x <= 0)] = 0.0
    out[ok & (x >= 1)] = 1.0
    mid = ok & (x > 0) & (x < 1)
    if not mid.any():
        return out
    a, b, x = a[mid], b[mid], x[mid]
    lbt = lgamma(a + b) - lgamma(a) - lgamma(b) + a * np.log(x) + b * np.log1p(-x)
    front = np.exp(lbt)
    direct = x < (a + 1.0) / (a + b + 2.0)
    res = np.empty_like(x)
    if direct.any():
        res[direct] = front[direct] * _beta_fraction(a[direct], b[direct], x[direct]) / a[direct]
    if (~direct).any():
        i = ~direct
        res[i] = 1.0 - front[i] * _beta_fraction(b[i], a[i], 1.0 - x[i]) / b[i]
    out[mid] = np.clip(res, 0.0, 1.0)
    return out


def gammaincc(a, x) -> np.ndarray:
    """Regularized upper incomplete gamma Q(a, x), elementwise."""
    a, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(x, float))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & (a > 0) & ~np.isnan(x)
    out[ok & (x <= 0)] = 1.0
    out[ok & np.isposinf(x)] = 0.0
    mid = ok & (x > 0) & np.isfinite(x)
    if not mid.any():
        return out
    a, x = a[mid], x[mid]
    res = np.empty_like(x)
    lg = lgamma(a)
    series = x < a + 1.0
    if series.any():
        aa, xx = a[series], x[series]
        ap = aa.copy()
        s = 1.0 / aa
        term = s.copy()
        for _ in range(10 * _MAX_IT):
            ap = ap + 1.0
            term = term * xx / ap
            s = s + term
            if np.all(np.abs(term) < np.abs(s) * _EPS):
                break
        p = s * np.exp(-xx + aa * np.log(xx) - lg[series])
        res[series] = 1.0 - p
    if (~series).any():
        i = ~series
        aa, xx = a[i], x[i]
        last = _terms(aa, xx)
        f = xx + 2.0 * last + 1.0 - aa
        for n in range(last, 0, -1):  # x + 2n - 1 - a - n (n - a) / (x + 2n + 1 - a - ...)
            f = xx + 2.0 * n - 1.0 - aa - n * (n - aa) / f
        res[i] = np.exp(-xx + aa * np.log(xx) - lg[i]) / f
    out[mid] = np.clip(res, 0.0, 1.0)
    return out


def t_two_sided(t, df) -> np.ndarray:
    t, df = np.asarray(t, float), np.asarray(df, float)
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def r_two_sided(r, n) -> np.ndarray:
    """Two-sided p of a correlation r over n rows (t with n-2 df)."""
    r, n = np.asarray(r, float), np.asarray(n, float)
    df = n - 2.0
    r = np.clip(r, -1.0, 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        t = r * np.sqrt(df / ((1.0 - r) * (1.0 + r)))
    p = t_two_sided(t, df)
    p = np.where(np.abs(r) >= 1.0, 0.0, p)
    return np.where(df > 0, p, np.nan)


def f_sf(f, d1, d2) -> np.ndarray:
    f, d1, d2 = np.asarray(f, float), np.asarray(d1, float), np.asarray(d2, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        x = d2 / (d2 + d1 * f)
    p = betainc(d2 / 2.0, d1 / 2.0, x)
    return np.where(np.isposinf(f), 0.0, p)


def chi2_sf(x, df) -> np.ndarray:
    x, df = np.asarray(x, float), np.asarray(df, float)
    return gammaincc(df / 2.0, x / 2.0)


def _r_batch(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series(r_two_sided(r.to_numpy(float), n.to_numpy(float)))


def _chi2_batch(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(chi2_sf(x.to_numpy(float), df.to_numpy(float)))


def _f_batch(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series(f_sf(f.to_numpy(float), d1.to_numpy(float), d2.to_numpy(float)))


def _udf(fn):
    # built on use, not at import: workers import this module without a session
    return F.pandas_udf(fn, "double")


def pvalue_r(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation (Student t, n-2 df)."""
    return _udf(_r_batch)(r.cast("double"), n.cast("double"))


def pvalue_chi2(stat: Column, df: Column) -> Column:
    """Upper tail of the chi-square distribution."""
    return _udf(_chi2_batch)(stat.cast("double"), df.cast("double"))


def pvalue_f(stat: Column, d1: Column, d2: Column) -> Column:
    """Upper tail of the F distribution."""
    return _udf(_f_batch)(stat.cast("double"), d1.cast("double"), d2.cast("double"))


# ---------------------------------------------------------------- digamma
EULER_GAMMA = 0.5772156649015329
_DIGAMMA_SHIFT = 10


def digamma_int(n: Column) -> Column:
    """psi(n) for integer n >= 1 as a JVM-side expression.

    psi(n) = psi(n + 10) - sum_{j<10} 1/(n + j), with the asymptotic series
    for psi at n + 10 (error below 1e-12). The same formula is available as
    SQL text via :func:`sql_digamma_int`.
    """
    x = n.cast("double") + F.lit(float(_DIGAMMA_SHIFT))
    x2 = x * x
    asym = (F.log(x) - F.lit(0.5) / x - F.lit(1.0 / 12) / x2 + F.lit(1.0 / 120) / (x2 * x2)
            - F.lit(1.0 / 252) / (x2 * x2 * x2) + F.lit(1.0 / 240) / (x2 * x2 * x2 * x2))
    shift = None
    for j in range(_DIGAMMA_SHIFT):
        t = F.lit(1.0) / (n.cast("double") + F.lit(float(j)))
        shift = t if shift is None else shift + t
    return asym - shift


def sql_digamma_int(e: str) -> str:
    x = f"(CAST({e} AS DOUBLE) + {float(_DIGAMMA_SHIFT)})"
    x2 = f"({x} * {x})"
    asym = (f"(ln({x}) - 0.5 / {x} - {1.0 / 12!r} / {x2} + {1.0 / 120!r} / ({x2} * {x2})"
            f" - {1.0 / 252!r} / ({x2} * {x2} * {x2}) + {1.0 / 240!r} / ({x2} * {x2} * {x2} * {x2}))")
    shift = " + ".join(f"1.0 / (CAST({e} AS DOUBLE) + {float(j)})" for j in range(_DIGAMMA_SHIFT))
    return f"({asym} - ({shift}))"


def digamma_int_np(n) -> np.ndarray:
    """Exact psi(n) for small integer arrays, for tests."""
    n = np.asarray(n, dtype=np.int64)
    out = np.empty(n.shape)
    for i, v in enumerate(n.ravel()):
        out.ravel()[i] = -EULER_GAMMA + sum(1.0 / j for j in range(1, int(v)))
    return out
