"""Tail probabilities and digamma against direct numerical integration / sums."""

import math

import numpy as np

from cohortml.functions import special as S


def _integrate(f, a, b, n=200001):
    x = np.linspace(a, b, n)
    y = f(x)
    return float(np.trapezoid(y, x))


def test_betainc_matches_quadrature():
    # arcsine law: I_x(1/2, 1/2) = 2/pi asin(sqrt(x)) (quadrature is poor at the singularity)
    assert abs(S.betainc(0.5, 0.5, 0.3)[()] - 2 / math.pi * math.asin(math.sqrt(0.3))) < 1e-12
    for a, b, x in [(2.0, 3.0, 0.4), (10.0, 0.5, 0.9), (1.5, 7.0, 0.05)]:
        norm = math.exp(math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))
        eps = 1e-9
        val = _integrate(lambda t: t ** (a - 1) * (1 - t) ** (b - 1), eps, x) / norm
        assert abs(S.betainc(a, b, x)[()] - val) < 2e-4


def test_chi2_even_df_closed_form():
    for h in [0.1, 1.0, 5.0, 20.0, 60.0]:
        assert abs(S.chi2_sf(h, 4)[()] - math.exp(-h / 2) * (1 + h / 2)) < 1e-12
        assert abs(S.chi2_sf(h, 2)[()] - math.exp(-h / 2)) < 1e-12


def test_t_pvalue_symmetry_and_limits():
    assert abs(S.r_two_sided(0.0, 50)[()] - 1.0) < 1e-12
    assert S.r_two_sided(1.0, 50)[()] == 0.0
    assert abs(S.r_two_sided(0.3, 40)[()] - S.r_two_sided(-0.3, 40)[()]) < 1e-15
    # df = 1: t distribution is Cauchy, p = 1 - 2 atan(|t|) / pi
    t = 2.0
    r = t / math.sqrt(1 + t * t)  # n = 3 gives df = 1
    assert abs(S.r_two_sided(r, 3)[()] - (1 - 2 * math.atan(t) / math.pi)) < 1e-10


def test_f_sf_matches_t_square():
    # F(1, d) tail equals the two-sided t tail
    t, d = 2.3, 17
    f = S.f_sf(t * t, 1, d)[()]
    p = S.t_two_sided(t, d)[()]
    assert abs(f - p) < 1e-12


def test_digamma_int_expression(spark):
    from pyspark.sql import functions as F
    ns = list(range(1, 40)) + [100, 1000, 123456]
    df = spark.createDataFrame([(n,) for n in ns], "n int")
    got = [r[0] for r in df.select(S.digamma_int(F.col("n"))).collect()]
    exact = S.digamma_int_np(ns)
    assert np.max(np.abs(np.array(got) - exact)) < 1e-10
