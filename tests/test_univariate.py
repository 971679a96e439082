"""Scores against brute force on small data, and the degenerate cases."""

import numpy as np
import pandas as pd
import pytest

from cohortml.operators import select as S
from cohortml.operators import univariate as U


def _df(spark, x, y):
    pdf = pd.DataFrame({"row_id": np.arange(len(x)), "feature": 0, "value": np.asarray(x, float),
                        "label": np.asarray(y, int)})
    return spark.createDataFrame(pdf)


def _midrank(a):
    return pd.Series(a).rank(method="average").to_numpy()


def test_constant_feature_scores(spark):
    df = _df(spark, [2.0] * 8, [0, 1, 0, 1, 2, 2, 1, 0])
    for fn in (U.score_pearson, U.score_spearman, U.score_kruskal):
        r = fn(df).first()
        assert r["score"] == 0.0 and r["pvalue"] == 1.0


def test_one_class_kruskal(spark):
    r = U.score_kruskal(_df(spark, [1.0, 2.0, 3.0, 4.0], [1, 1, 1, 1])).first()
    assert (r["score"], r["pvalue"]) == (0.0, 1.0)


def test_kruskal_spearman_brute(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, 60).astype(float)  # many ties
    y = rng.integers(0, 3, 60)
    rk = _midrank(x)
    n = len(x)
    h = 12 / (n * (n + 1)) * sum(rk[y == g].sum() ** 2 / (y == g).sum() for g in np.unique(y)) - 3 * (n + 1)
    _, t = np.unique(x, return_counts=True)
    h /= 1 - (t ** 3 - t).sum() / (n ** 3 - n)
    got = U.score_kruskal(_df(spark, x, y)).first()
    assert abs(got["score"] - h) < 1e-9
    rho = np.corrcoef(_midrank(x), _midrank(y))[0, 1]
    assert abs(U.score_spearman(_df(spark, x, y)).first()["score"] - abs(rho)) < 1e-9


def test_distance_correlation_brute(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=80), 1)
    y = rng.integers(0, 3, 80)
    a = np.abs(x[:, None] - x[None, :])
    b = np.abs(y[:, None] - y[None, :]).astype(float)
    A = a - a.mean(0) - a.mean(1)[:, None] + a.mean()
    B = b - b.mean(0) - b.mean(1)[:, None] + b.mean()
    dcor = np.sqrt((A * B).mean() / np.sqrt((A * A).mean() * (B * B).mean()))
    got = U.score_distancecorr(_df(spark, x, y)).first()["score"]
    assert abs(got - dcor) < 1e-9
    # invariant to shift and scale of x
    got2 = U.score_distancecorr(_df(spark, 3 * x + 7, y)).first()["score"]
    assert abs(got - got2) < 1e-9 and 0 <= got <= 1


def test_mutual_info_brute(spark):
    from cohortml.functions.special import digamma_int_np
    rng = np.random.default_rng(11)
    y = rng.integers(0, 3, 90)
    x = rng.normal(size=90) + y * 0.8
    xs = x / x.std()
    rad = np.zeros(90); kk = np.zeros(90, int); nc = np.zeros(90, int)
    for c in np.unique(y):
        m = y == c
        d = np.sort(np.abs(xs[m][:, None] - xs[m][None, :]), axis=1)
        k = min(3, m.sum() - 1)
        rad[m], kk[m], nc[m] = d[:, k], k, m.sum()
    mc = np.array([np.sum(np.abs(xs - xs[i]) < rad[i]) for i in range(90)])
    mi = max(0.0, digamma_int_np([90])[0] + digamma_int_np(kk).mean() - digamma_int_np(nc).mean()
             - digamma_int_np(mc).mean())
    got = U.score_mutual_info_classif(_df(spark, x, y)).first()["score"]
    assert abs(got - mi) < 1e-9


def test_pvalues_pearson(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=40)
    y = (x + rng.normal(size=40) > 0).astype(int)
    got = U.score_pearson(_df(spark, x, y)).first()
    r = np.corrcoef(x, y)[0, 1]
    # p by numerical integration of the t density
    from math import gamma, pi, sqrt
    df = 38
    t = abs(r) * sqrt(df / (1 - r * r))
    z = np.linspace(t, 60, 400001)
    dens = gamma((df + 1) / 2) / (sqrt(df * pi) * gamma(df / 2)) * (1 + z * z / df) ** (-(df + 1) / 2)
    p = 2 * np.trapezoid(dens, z)
    assert abs(got["pvalue"] - p) < 1e-6


def test_selector_errors(spark):
    sc = spark.createDataFrame([(0, 1.0, 0.5), (1, 2.0, 0.01)], "feature int, score double, pvalue double")
    with pytest.raises(ValueError):
        S.select_k_best(sc, 0)
    with pytest.raises(ValueError):
        S.select_k_best(sc, 1.5)
    with pytest.raises(ValueError):
        S.select_percentile_own(sc, 120)
    with pytest.raises(ValueError):
        S.select_pvalue(sc, 0.05, "distancecorr")
    with pytest.raises(ValueError):
        U.score(sc, "nope")


def test_threshold_parse():
    assert S.parse_threshold("1.25*mean") == ("mean", 1.25)
    assert S.parse_threshold("median") == ("median", 1.0)
    assert S.parse_threshold(0.3) == ("value", 0.3)


def test_mutual_info_regression_brute(spark):
    from cohortml.functions.special import digamma_int_np
    rng = np.random.default_rng(8)
    n = 120
    x = rng.normal(size=n)
    y = np.sin(x) + 0.3 * rng.normal(size=n)
    # continuous values: on a grid, exact distance ties would be decided by the last bit of
    # the std used for scaling, which differs between NumPy and Spark
    xs, ys = x / x.std(), y / y.std()
    d = np.maximum(np.abs(xs[:, None] - xs[None, :]), np.abs(ys[:, None] - ys[None, :]))
    np.fill_diagonal(d, np.inf)
    eps = np.sort(d, axis=1)[:, 2]
    nx = np.array([np.sum(np.abs(xs - xs[i]) < eps[i]) if eps[i] > 0 else np.sum(xs == xs[i]) for i in range(n)])
    ny = np.array([np.sum(np.abs(ys - ys[i]) < eps[i]) if eps[i] > 0 else np.sum(ys == ys[i]) for i in range(n)])
    mi = max(0.0, digamma_int_np([n])[0] + digamma_int_np([3])[0] - digamma_int_np(nx).mean()
             - digamma_int_np(ny).mean())
    pdf = pd.DataFrame({"row_id": np.arange(n), "feature": 0, "value": x, "label": y})
    got = U.score_mutual_info_regression(spark.createDataFrame(pdf)).first()["score"]
    assert abs(got - mi) < 1e-9


def test_mutual_information_of_a_half_zero_feature_moves_counts(spark, monkeypatch):
    """Equal values go on as one row with a count: the merged list is far shorter than the rows, the score the same."""
    import numpy as np
    from cohortml.operators import univariate as U
    rng = np.random.default_rng(8)
    n = 400
    y = rng.integers(0, 2, n)
    v = np.where(rng.random(n) < 0.5, 0.0, rng.normal(size=n) + y)
    df = spark.createDataFrame([(i, 0, float(a), int(b)) for i, (a, b) in enumerate(zip(v, y))], "row_id long, feature int, value double, label int")
    sizes = []
    plain = U.running_totals

    def noted(rows, keys, order, sums, **kw):
        if kw.get("peers"):
            sizes.append(rows.count())
        return plain(rows, keys, order, sums, **kw)

    monkeypatch.setattr(U, "running_totals", noted)
    got = U.score(df, "mutual_info_classif").first()["score"]
    distinct = len(set(v))
    assert sizes and sizes[-1] <= 3 * distinct + 10 < 2 * n
    # by brute force, ties at distance zero
    x = v / v.std()
    psi = lambda k: -0.57721566490153286 + sum(1 / j for j in range(1, int(k)))
    total = []
    for i in range(n):
        same = np.sort(np.abs(np.delete(x[y == y[i]], np.flatnonzero(np.flatnonzero(y == y[i]) == i)) - x[i]))
        r = same[2]
        total.append(np.sum(np.abs(x - x[i]) < r * (1 - 1e-11)) if r > 0 else np.sum(x == x[i]))
    counts = np.array([(y == c).sum() for c in y])
    want = psi(n) + psi(3) - np.mean([psi(c) for c in counts]) - np.mean([psi(m) for m in total])
    assert abs(got - max(want, 0.0)) < 1e-6


def test_neighbours_in_max_norm_are_searched_in_cells(spark, monkeypatch):
    """Exact with ties, copies, rows of one key and far rows; a row meets few rows beside its own cell's."""
    monkeypatch.setattr(U, "MI_CELL", 8)
    rng = np.random.default_rng(5)
    n, K = 500, 3
    x, y = rng.normal(size=(2, n))
    x[:120], y[100:160] = 0.0, 0.25  # ties along one axis and both
    x[-1] = 400.0
    ids = np.arange(n)
    ids[200:204] = 200
    x[200:204], y[200:204] = x[200], y[200]
    df = spark.createDataFrame([(f, int(i), float(a), float(b)) for f in (0, 1) for i, a, b in zip(ids, x, y if f else -y)],
                               "feature int, row_id long, x double, y double").repartition(3)
    seen = spark.sparkContext.accumulator(0)
    plain = U._nearest
    monkeypatch.setattr(U, "_nearest", lambda d, k: seen.add(d.size) or plain(d, k))
    got = {(r["feature"], r["row_id"]): r["eps"] for r in U._kth_distance(df, ["feature"], "row_id", K).collect()}
    d = np.maximum(np.abs(x[:, None] - x), np.abs(y[:, None] - y))
    want = {}
    for i in set(ids.tolist()):
        want[i] = np.sort(d[ids == i][:, ids != i].ravel())[K - 1]
    assert got == {(f, i): e for f in (0, 1) for i, e in want.items()}
    assert 0 < seen.value < 2 * n * n / 3


def test_mutual_information_of_values_that_differ_by_rounding(spark):
    """A neighbour one rounding away gives a radius below the band at its ends; the row itself still counts."""
    rng = np.random.default_rng(5)
    n = 120
    x = rng.choice([0.0, 0.2, 0.4, 0.6, 0.8, 1.0], n)
    y = (rng.random(n) < x).astype(int)
    x = np.where(rng.random(n) < 0.1, np.nextafter(x, 2.0), x)
    x[:8], y[:8] = [0.3] * 3 + [np.nextafter(0.3, 1)] * 5, 1
    rad = np.zeros(n)
    for c in (0, 1):
        m = y == c
        rad[m] = np.sort(np.abs(x[m][:, None] - x[m][None, :]), axis=1)[:, 3]
    assert ((rad > 0) & (rad < 1e-15)).sum() >= 3
    d = np.abs(x[:, None] - x[None, :])
    counted = ((d == 0) | (d < (rad - 1e-11 * (np.abs(x) + rad))[:, None])).sum(axis=1)
    df = _df(spark, x, y)
    got = U.score_mutual_info_classif(df, scale=False, per_row=True).collect()
    assert sorted((r["x"], r["y"], r["m"]) for r in got) == sorted(zip(x.tolist(), y.tolist(), counted.tolist()))
    assert U.score_mutual_info_classif(df, scale=False).first()["score"] >= 0.0


def test_mutual_information_scales_by_one_deviation(spark, monkeypatch):
    """A deviation that comes out a rounding apart in every run of its job, as over many tasks, does not part equal values."""
    rng = np.random.default_rng(6)
    x = rng.choice([0.0, 0.2, 0.4, 0.6, 0.8, 1.0], 60)
    df = _df(spark, x, (rng.random(60) < x).astype(int))
    right = U.score_mutual_info_classif(df, scale=False, per_row=True).collect()
    plain = U.F.stddev_pop

    @U.F.udf("double")
    def rounded(v):
        import os
        return v * (1.0 + os.urandom(1)[0] * 2.0 ** -52)

    monkeypatch.setattr(U.F, "stddev_pop", lambda c: rounded(plain(c)))
    got = U.score_mutual_info_classif(df, per_row=True).collect()
    assert sorted((r["_pos"], r["y"], r["m"]) for r in got) == sorted((r["_pos"], r["y"], r["m"]) for r in right)
