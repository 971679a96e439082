"""Embedded selectors and the combined resampler against their definitions, in NumPy."""

import numpy as np
import pytest

from cohortml.operators import models as MD
from cohortml.operators import neighbors as N


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(17)
    n = 150
    y = (rng.random(n) < 0.35).astype(int)
    x = rng.normal(size=(n, 6))
    x[:, 0] += 1.0 * y
    x[:, 3] -= 0.7 * y
    df = spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))],
                               "row_id long, x array<double>, label int").repartition(3)
    weight = np.array([n / (2 * (y == c).sum()) for c in (0, 1)])[y]
    return df, x, y, weight


def root(f, low=-50.0, high=50.0):
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return (low + high) / 2


def optimal(beta, gradient, bound, tolerance):
    """The conditions of a minimum under an L1 penalty: slopes of ``bound`` against the sign, no larger ones elsewhere."""
    for b, g in zip(beta, gradient):
        if abs(b) > 1e-6:
            assert g == pytest.approx(-bound * np.sign(b), abs=tolerance)
        else:
            assert abs(g) <= bound + tolerance


@pytest.mark.parametrize("C", [0.05, 1.0])
def test_l1_logistic_is_the_minimum(rows, C):
    df, x, y, w = rows
    beta = np.array(MD.embed_l1_logistic(df, C))
    margin = x @ beta
    # the intercept is not penalised: it makes the weighted residuals sum to zero
    b0 = root(lambda b: (w * (1 / (1 + np.exp(-margin - b)) - y)).sum())
    residual = w * (1 / (1 + np.exp(-margin - b0)) - y)
    optimal(beta, x.T @ residual * C, 1.0, 0.02)
    assert C == 1.0 or (beta == 0).any()


@pytest.mark.parametrize("C", [0.01, 0.5])
def test_l1_svc_is_the_minimum(rows, C):
    df, x, y, w = rows
    beta = np.array(MD.embed_l1_svc(df, C, steps=2000, tol=1e-5))
    s = 2 * y - 1

    def slack(b):
        return np.maximum(0.0, 1 - s * (x @ beta + b))

    def slope(b):
        return -2 * C * (w * s * slack(b)).sum()

    # the intercept is a coefficient like the others, and penalised
    b0 = 0.0 if abs(slope(0.0)) <= 1 else root(lambda b: slope(b) + np.sign(-slope(0.0)))
    optimal(beta, -2 * C * x.T @ (w * s * slack(b0)), 1.0, 0.05)


def test_ada_importance_equals_boosted_stumps(spark):
    rng = np.random.default_rng(5)
    n, d, rate, rounds = 200, 5, 0.7, 8
    x = (rng.random((n, d)) < 0.5).astype(float)  # two values: one possible cut per feature
    y = ((0.9 * x[:, 1] + 0.7 * x[:, 3] - 0.4 * x[:, 0] + 0.8 * rng.normal(size=n)) > 0.6).astype(int)
    df = spark.createDataFrame([(i, r.tolist(), int(c)) for i, (r, c) in enumerate(zip(x, y))], "row_id long, x array<double>, label int")
    w, total = np.ones(n), np.zeros(d)
    for _ in range(rounds):
        best = None
        for f in range(d):
            impurity, guess = 0.0, np.zeros(n, int)
            for v in (0.0, 1.0):
                part = x[:, f] == v
                share = [w[part & (y == c)].sum() for c in (0, 1)]
                impurity += sum(share) - sum(a * a for a in share) / sum(share)
                guess[part] = int(share[1] > share[0])
            if best is None or impurity < best[0] - 1e-9:
                best = (impurity, f, guess)
        wrong = best[2] != y
        error = w[wrong].sum() / w.sum()
        if error >= 0.5:
            break
        alpha = rate * np.log((1 - error) / error)
        total[best[1]] += alpha
        w = w * np.exp(alpha * wrong)
    fitted = MD.fit_family("ada", df, n_estimators=rounds, learning_rate=rate)
    got = np.zeros(d)
    for feature, _, _, _, a in fitted.extra["stumps"]:
        got[feature] += a
    assert got == pytest.approx(total, rel=1e-6)
    imp = MD.embed_ada(df, 6)
    assert sum(imp) == pytest.approx(1) and np.argmax(imp) in (1, 3)


def test_smotetomek_is_smote_without_both_members_of_links(rows):
    df, *_ = rows
    smote = N.rs_smote(df).collect()
    x, y = np.array([r.x for r in smote]), np.array([r.label for r in smote])
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    near = d.argmin(axis=1)
    linked = [i for i in range(len(x)) if near[near[i]] == i and y[i] != y[near[i]]]
    want = sorted((tuple(np.round(x[i], 9)), int(y[i])) for i in range(len(x)) if i not in set(linked))
    got = sorted((tuple(np.round(r.x, 9)), r.label) for r in N.rs_smotetomek(df).collect())
    assert got == want and linked


def test_forest_and_booster_importances_find_the_planted_features(rows):
    df, *_ = rows
    for imp in (MD.embed_rf(df, 20), MD.embed_gbt(df, 5)):
        assert len(imp) == 6 and sum(imp) == pytest.approx(1) and set(np.argsort(imp)[-2:]) & {0, 3}


def test_random_features_approach_the_rbf_kernel(rows):
    df, x, _, _ = rows
    z = {r.row_id: r.x for r in MD.random_fourier(6, 4000, 0.2)(df).collect()}
    z = np.array([z[i] for i in range(len(x))])
    want = np.exp(-0.2 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - want).max() < 0.12
