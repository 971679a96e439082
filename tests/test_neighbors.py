"""Exact kNN join against brute force, including a hot duplicated cluster; resampler properties."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cohortml.operators import neighbors as N


def _points(spark, n=300, d=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[: n // 3] = x[0] + rng.normal(scale=1e-3, size=(n // 3, d))  # a third of the rows in one tight cluster
    y = (rng.random(n) < 0.2).astype(int)
    pdf = pd.DataFrame({"row_id": np.arange(n), "x": [list(map(float, r)) for r in x], "label": y})
    return x, y, spark.createDataFrame(pdf, "row_id long, x array<double>, label int")


def test_knn_exact(spark):
    x, _, df = _points(spark)
    got = N.knn_join(df, df, 4, exclude_self=True, n_pivots=12).toPandas()
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d2, np.inf)
    for i in range(0, len(x), 7):
        exp = sorted(range(len(x)), key=lambda j: (d2[i, j], j))[:4]
        g = got[got.row_id == i].sort_values("nn_rank").nn_key.tolist()
        assert g == exp


def test_smote_balances_and_stays_on_segments(spark):
    x, y, df = _points(spark, seed=1)
    out = N.rs_smote(df).toPandas()
    counts = out.label.value_counts()
    assert counts[0] == counts[1]
    syn = out[out.replica >= 0]
    nn = N.knn_join(df.where("label = 1"), df.where("label = 1"), 5, exclude_self=True).toPandas()
    for _, r in syn.head(30).iterrows():
        base = x[int(r.row_id)]
        cands = nn[nn.row_id == r.row_id].nn_key.tolist()
        v = np.array(r.x)
        ok = False
        for c in cands:
            seg = x[c] - base
            u = np.dot(v - base, seg) / np.dot(seg, seg)
            if -1e-9 <= u <= 1 + 1e-9 and np.allclose(base + u * seg, v, atol=1e-9):
                ok = True
        assert ok


def test_tomek_is_subset_and_keeps_minority(spark):
    _, y, df = _points(spark, seed=2)
    out = N.rs_tomek(df).toPandas()
    assert set(out.row_id) <= set(range(len(y)))
    assert (out.label == 1).sum() == (y == 1).sum()


def test_knn_with_hot_exact_duplicates(spark):
    rng = np.random.default_rng(4)
    n = 240
    x = rng.normal(size=(n, 3))
    x[: n // 3] = x[0]  # a third of the rows are one exact vector
    pdf = pd.DataFrame({"row_id": np.arange(n), "x": [list(map(float, r)) for r in x], "label": 0})
    df = spark.createDataFrame(pdf, "row_id long, x array<double>, label int")
    got = N.knn_join(df, df, 3, exclude_self=True, n_pivots=8).toPandas()
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d2, np.inf)
    for i in list(range(0, n, 11)) + [0, 1, 5]:
        exp = sorted(range(n), key=lambda j: (d2[i, j], j))[:3]
        assert got[got.row_id == i].sort_values("nn_rank").nn_key.tolist() == exp


def _exact(got, x, k, ids):
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d2, np.inf)
    found = {i: g.sort_values("nn_rank").nn_key.tolist() for i, g in got.groupby("row_id")}
    for i in ids:
        assert found[i] == sorted(range(len(x)), key=lambda j: (d2[i, j], j))[:k]


def test_two_levels_are_exact(spark, monkeypatch):
    """Cells split again, rows and queries in several chunks; one cluster and one repeated vector are hot."""
    monkeypatch.setattr(N, "ROWS_PER_LEAF", 40)
    monkeypatch.setattr(N, "ROWS_PER_PART", 10)
    monkeypatch.setattr(N, "ROW_CHUNK", 32)
    monkeypatch.setattr(N, "QUERY_CHUNK", 16)
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(420, 3)), 1)  # rounded: distances tie
    x[:140] = x[0] + np.round(rng.normal(scale=0.05, size=(140, 3)), 2)
    x[140:200] = x[150]
    df = spark.createDataFrame([(i, [float(v) for v in r], 0) for i, r in enumerate(x)], "row_id long, x array<double>, label int").repartition(5)
    got = N.knn_join(df, df, 4, exclude_self=True, n_pivots=6).toPandas()
    assert len(got) == 4 * len(x)
    _exact(got, x, 4, range(0, len(x), 5))


def test_candidates_and_blocks_are_exact(spark, monkeypatch):
    """Few cells in reach: candidates; most cells in reach: pairs of blocks, with ties, copies and an entry without a value."""
    calls = []
    for name in ("_topk", "_topk_block"):
        monkeypatch.setattr(N, name, lambda *a, f=getattr(N, name), n=name: calls.append(n) or f(*a))
    for d, path in ((2, "_topk"), (24, "_topk_block")):
        monkeypatch.setattr(N, "ROW_CHUNK", 64 if d == 24 else 4)
        rng = np.random.default_rng(d)
        x = np.round(rng.normal(size=(400, d)), 1)
        x[:60] = x[0]
        x[60:120] = np.round(x[0] + rng.normal(scale=0.1, size=(60, d)), 1)
        x += 1e4  # dot products of such rows lose digits
        rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
        df = spark.createDataFrame(rows, "row_id long, x array<double>").repartition(3)
        got = N.knn_join(df, df, 4, exclude_self=True, n_pivots=40).toPandas()
        assert calls.pop() == path and len(got) == 4 * len(x)
        _exact(got, x, 4, range(0, len(x), 3))
    odd = spark.createDataFrame([*rows, (400, [None] * d)], "row_id long, x array<double>")
    assert N.knn_join(df, odd, 4, exclude_self=True, n_pivots=40).orderBy("row_id", "nn_rank").toPandas().equals(
        got.sort_values(["row_id", "nn_rank"]).reset_index(drop=True))


def test_wide_rows_are_not_copied_per_cell(spark, monkeypatch):
    """Rows sent to groups grow with the number of blocks, not of cells."""
    sent = []
    topk = N._topk_block
    monkeypatch.setattr(N, "_topk_block", lambda *a: sent.append(a) or topk(*a))
    monkeypatch.setattr(N, "_candidate_cells", lambda *a: (_ for _ in ()).throw(AssertionError("copies per cell")))
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 32))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id long, x array<double>")
    got = N.knn_join(df, df, 3, exclude_self=True).toPandas()
    assert sent
    _exact(got, x, 3, range(0, 600, 9))


def test_parts_stay_small_while_rows_grow(spark, monkeypatch):
    monkeypatch.setattr(N, "ROWS_PER_PART", 16)
    largest = []
    for n in (1000, 4000):
        rng = np.random.default_rng(n)
        df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(rng.normal(size=(n, 3)))], "nn_key long, _rx array<double>")
        pivots = N.choose_pivots(df, "nn_key", "_rx", 5)
        cells = N._assign_cells(df, "_rx", spark.sparkContext.broadcast(pivots)).checkpoint()
        sizes = {r[0]: r[1] for r in cells.groupBy("cell").count().collect()}
        parts, table = N._split_cells(cells, pivots, sizes)
        counts = [r[0] for r in parts.groupBy("cell", "sub").count().select("count").collect()]
        assert sum(counts) == n and len(counts) <= table.count()
        assert max(sizes.values()) > n / 10
        largest.append(max(counts))
    assert max(largest) < 16 * 8 and largest[1] < 2 * largest[0]


def test_many_centroids_equal_plain_rounds(spark, monkeypatch):
    """More centroids than Spark's KMeans is asked for: rounds over cells end where plain Lloyd rounds end."""
    from cohortml.operators import kmeans as K
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (900, 3)), rng.normal(6, 2, (500, 3)), rng.pareto(1.5, (200, 3)) * 50])
    x = np.concatenate([x, x[:300]])  # equal rows
    monkeypatch.setattr(N, "ROW_CHUNK", 64)  # several groups to a cell
    df = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").repartition(4)
    starts, drawn = [], K._drawn
    monkeypatch.setattr(K, "_drawn", lambda *a: starts.append(drawn(*a)) or starts[-1])
    got = np.array(sorted(r["mean"] for r in K.cluster_means(df, 150, rounds=6).collect()))
    c = np.array([r["c"] for s in starts for r in s.orderBy("number").collect()])
    assert len(c) == 150 == len(np.unique(c, axis=0))
    assert (c[:, None] == np.unique(x, axis=0)[None]).all(-1).any(1).all()
    for _ in range(6):
        at = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
        c = np.array([x[at == i].mean(0) if (at == i).any() else c[i] for i in range(len(c))])
    at = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
    want = np.array(sorted(x[at == i].mean(0).tolist() for i in np.unique(at)))
    assert got.shape == want.shape and np.allclose(got, want, atol=1e-9)


def test_centroids_over_cells_keep_the_rest(spark, monkeypatch):
    from cohortml.operators import kmeans as K
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 1, 2).tolist(), 0) for i in range(300)] + [(1000 + i, rng.normal(3, 1, 2).tolist(), 1) for i in range(20)]
    df = spark.createDataFrame(rows, "row_id long, x array<double>, label int")
    calls = []
    whole = K.cluster_means
    monkeypatch.setattr(K, "cluster_means", lambda *a: calls.append(a) or whole(*a))
    monkeypatch.setattr(N, "CENTRES", 10)
    out = N.rs_centroids(df).toPandas()
    assert len(calls) == 1 and out.row_id.is_unique
    assert (out.label == 1).sum() == 20 == (out.label == 0).sum()
    assert set(out[out.label == 1].row_id) == set(range(1000, 1020)) and (out[out.label == 0].row_id < 0).all()
    few = spark.createDataFrame([([float(i % 7)],) for i in range(100)], "x array<double>")
    assert sorted(r["mean"][0] for r in whole(few, 30).collect()) == [float(i) for i in range(7)]
    # a centre that no row is nearest to stays, and gives no row
    drawn = K._drawn
    monkeypatch.setattr(K, "_drawn", lambda *a: drawn(*a).withColumn("c", F.when(F.col("number") == 0, F.array(F.lit(1e6))).otherwise(F.col("c"))))
    assert len(whole(few, 5, rounds=2).collect()) == 4
    bad = df.unionByName(spark.createDataFrame([(5000, [None, 1.0], 0)], df.schema))
    try:
        N.rs_centroids(bad).collect()
        raise AssertionError("a null component was taken")
    except Exception as e:
        assert "vectors must not be null" in str(e)
