"""Forests and the booster against growers written out row by row in NumPy."""

import numpy as np
import pytest

from cohortml.operators import boosting as B
from cohortml.operators import forest as FO
from cohortml.operators import models as MD
from cohortml.operators import trees as TR


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 200
    y = (rng.random(n) < 0.3).astype(int)
    x = rng.normal(size=(n, 9))
    x[:, 0] += 1.5 * y
    x[:, 4] -= y
    x[:, 7] = np.maximum(x[:, 7], 0.0)  # half of it zero
    x[:, 8] = 1.0  # constant
    df = spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))],
                               "row_id long, x array<double>, label int").repartition(5)
    keys = {r.row_id: r.key for r in df.selectExpr("row_id", "xxhash64(row_id) AS key").collect()}
    return df, x, y, np.array([keys[i] for i in range(n)])


def gini(w):
    s = sum(w)
    return s - sum(v * v for v in w) / s if s else 0.0


def grow(x, y, times, n_features, tree, seed, depth, least_split, least_leaf, cuts_of):
    """One tree: ``cuts_of(feature, rows, node)`` lists the cuts to try."""
    looked = int(np.sqrt(n_features))
    n = np.array([times[y == c].sum() for c in (0, 1)], float)
    weight = n.sum() / (2 * n)
    splits, leaves = {}, {}

    def visit(node, rows, level):
        count = np.array([times[rows][y[rows] == c].sum() for c in (0, 1)])
        best = (FO.LEAST_GAIN, None)
        if level < depth and count.sum() >= least_split and (count > 0).all():
            for f in FO.subset(n_features, looked, seed, tree, node):
                for c in cuts_of(int(f), rows, node):
                    low = x[rows, f] <= c
                    sides = [np.array([times[r][y[r] == k].sum() for k in (0, 1)]) for r in (rows[low], rows[~low])]
                    if min(s.sum() for s in sides) < least_leaf:
                        continue
                    gain = gini(count * weight) - sum(gini(s * weight) for s in sides)
                    if gain > best[0] + 1e-9:
                        best = (gain, (int(f), float(c)))
        if best[1] is None:
            leaves[node] = (count * weight).tolist()
            return
        splits[node] = best[1]
        low = x[rows, best[1][0]] <= best[1][1]
        for child, r in zip(TR.children(node), (rows[low], rows[~low])):
            visit(child, r, level + 1)

    visit(0, np.flatnonzero(times > 0), 0)
    return splits, leaves


def same(tree, splits, leaves):
    assert {k: (f, pytest.approx(c)) for k, (f, c) in tree["splits"].items()} == splits
    assert set(tree["leaves"]) == set(leaves)
    for k, w in leaves.items():
        assert tree["leaves"][k] == pytest.approx(w)


def test_balanced_forest_equals_a_grower_in_numpy(table):
    df, x, y, key = table
    forest = FO.grow_forest(df, 6, 4, 6, 3, max_samples=0.8, seed=5)
    cuts = TR.quantile_cuts(df, "x", FO.N_BINS)
    small = min((y == 0).sum(), (y == 1).sum())
    tables = [FO.poisson_table(0.8 * small / (y == c).sum()) for c in (0, 1)]
    for t, tree in enumerate(forest.trees):
        times = FO.draws(key, y, t, tables, 5)
        same(tree, *grow(x, y, times, 9, t, 5, 4, 6, 3, lambda f, rows, node: cuts[f]))


def test_bootstraps_are_balanced_and_differ(table):
    _, _, y, _ = table
    rng = np.random.default_rng(1)
    key, y = rng.integers(-2 ** 63, 2 ** 63 - 1, 40_000), np.repeat([0, 1], [36_000, 4_000])
    tables = [FO.poisson_table(0.5 * 4_000 / n) for n in (36_000, 4_000)]
    drawn = [FO.draws(key, y, t, tables, 42) for t in range(5)]
    for d in drawn:
        n = np.array([d[y == c].sum() for c in (0, 1)])
        assert (abs(n - 2_000) < 200).all()  # the same number from both classes
        assert d.max() > 1  # with replacement
    assert any((a != b).any() for a, b in zip(drawn, drawn[1:]))
    assert FO._class_weights(np.array([30.0, 10.0])) == pytest.approx([40 / 60, 40 / 20])


def test_extra_trees_equal_a_grower_with_the_same_cuts(table):
    df, x, y, _ = table
    forest = FO.grow_forest(df, 5, 4, 5, 2, bootstrap=False, random_cuts=True, seed=8)
    for t, tree in enumerate(forest.trees):
        def cut(f, rows, node, t=t):
            low, high = x[rows, f].min(), x[rows, f].max()
            c = low + FO.uniform(np.array([f]), 8, t, node, 1)[0] * (high - low)
            return [low if c >= high else c]

        same(tree, *grow(x, y, np.ones(len(y), np.int64), 9, t, 8, 4, 5, 2, cut))
    cuts = [c for tree in forest.trees for _, c in tree["splits"].values()]
    assert len(set(cuts)) == len(cuts)


def test_groups_of_trees_and_blocks_of_features_change_nothing(table, monkeypatch):
    df, *_ = table
    whole = FO.grow_forest(df, 4, 3, seed=2).trees, MD.fit_family("xgboost", df, n_estimators=2, max_depth=3).model.trees
    monkeypatch.setattr(TR, "MOST_CELLS", 200)
    parts = FO.grow_forest(df, 4, 3, seed=2).trees, MD.fit_family("xgboost", df, n_estimators=2, max_depth=3).model.trees
    assert whole[0] == parts[0]
    assert [t["splits"] for t in whole[1]] == [t["splits"] for t in parts[1]]


def test_forest_votes_and_importances(spark, table):
    df, x, y, _ = table
    forest = MD.fit_family("rf", df, n_estimators=8, max_depth=3)
    prob = {r.row_id: r.prob for r in forest.predict(df).collect()}
    share = np.zeros(len(y))
    for t in forest.model.trees:
        for i, row in enumerate(x):
            node = 0
            while node in t["splits"]:
                f, c = t["splits"][node]
                node = TR.children(node)[int(row[f] > c)]
            w = t["leaves"][node]
            share[i] += w[1] / sum(w) / 8
    assert np.allclose([prob[i] for i in range(len(y))], share)
    imp = forest.model.importances(9)
    assert sum(imp) == pytest.approx(1) and imp[8] == 0 and max(imp) in (imp[0], imp[4])
    extra = MD.fit_family("et", df, n_estimators=8, max_depth=3)
    assert {r.row_id: r.prob for r in extra.predict(df).collect()} != prob


def test_boosted_trees_equal_a_booster_in_numpy(table):
    df, x, y, _ = table
    lr, lam, alpha, gamma, depth = 0.3, 1.5, 0.2, 0.05, 3
    model = MD.fit_family("xgboost", df, n_estimators=B.WRITE_EVERY + 2, max_depth=depth, learning_rate=lr, reg_lambda=lam, reg_alpha=alpha, gamma=gamma).model
    cuts = TR.quantile_cuts(df, "x", B.N_BINS)
    m = np.full(len(y), np.log(y.mean() / (1 - y.mean())))

    def s(g):
        return np.sign(g) * max(abs(g) - alpha, 0.0)

    for tree in model.trees:
        p = 1 / (1 + np.exp(-m))
        g, h = p - y, p * (1 - p)
        step = np.zeros(len(y))

        def visit(node, rows, level):
            G, H = g[rows].sum(), h[rows].sum()
            best = (1e-12, None)
            if level < depth:
                for f in range(9):
                    for c in cuts[f]:
                        low = x[rows, f] <= c
                        hl, hr = h[rows[low]].sum(), h[rows[~low]].sum()
                        if hl < 1 or hr < 1:
                            continue
                        gain = 0.5 * (s(g[rows[low]].sum()) ** 2 / (hl + lam) + s(g[rows[~low]].sum()) ** 2 / (hr + lam) - s(G) ** 2 / (H + lam)) - gamma
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, c))
            if best[1] is None:
                assert node not in tree["splits"]
                assert tree["leaves"][node] == pytest.approx(-lr * s(G) / (H + lam))
                step[rows] = -lr * s(G) / (H + lam)
                return
            f, c = best[1]
            assert tree["splits"][node][0] == f and cuts[f][tree["splits"][node][1]] == pytest.approx(c)
            low = x[rows, f] <= c
            for child, r in zip(TR.children(node), (rows[low], rows[~low])):
                visit(child, r, level + 1)

        visit(0, np.arange(len(y)), 0)
        m = m + step
    prob = {r.row_id: r.prob for r in model.predict(df).collect()}
    assert np.allclose([prob[i] for i in range(len(y))], 1 / (1 + np.exp(-m)))


def test_one_class_and_no_rows(spark):
    one = spark.createDataFrame([(i, [float(i)], 0) for i in range(10)], "row_id long, x array<double>, label int")
    forest = FO.grow_forest(one, 2, 3)
    assert all(not t["splits"] for t in forest.trees)
    assert {r.prob for r in forest.predict(one).collect()} == {0.0}
    with pytest.raises(ValueError):
        FO.grow_forest(one.where("row_id < 0"), 2, 3)
