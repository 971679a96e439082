"""Centroid clustering and whitening against plain NumPy."""

import hashlib

import numpy as np
import pytest

from cohortml.llm import centroids, whitening
from cohortml.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, x string, cluster string, place string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "a", "b", "c") for i, v in rows], SCHEMA).repartition(3)


def clumps(n, d, seed, spread=0.1, groups=7):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, d))
    return (centres[rng.integers(0, groups, n) ** 2 % groups] + spread * rng.normal(size=(n, d))).astype(np.float32)


def plain_clusters(ids, vectors, k=40, rounds=5):
    x = np.floor(256 * vectors.astype(np.float64)).astype(np.int64)
    order = sorted(range(len(ids)), key=lambda i: (hashlib.sha256(f"2:{'null' if ids[i] is None else ids[i]}".encode()).hexdigest(), x[i].tolist()))
    c = x[order[:k]].copy()

    def nearest():
        d = np.stack([((x - v) ** 2).sum(axis=1) for v in c], axis=1)
        a = d.argmin(axis=1)
        return a, d[np.arange(len(x)), a]

    for _ in range(rounds):
        a, _d = nearest()
        for j in range(len(c)):
            if (a == j).any():
                c[j] = [int(v) // int((a == j).sum()) for v in x[a == j].sum(axis=0)]
    a, d = nearest()
    sha = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c.tolist()]
    return sorted((repr(i), int(j), int(v), int(d[a == j].sum()), int(d.sum()), sha[j]) for i, j, v in zip(ids, a, d))


def clusters(df):
    return sorted((repr(r[0]), *r[1:]) for r in df.collect())


def test_clusters_equal_brute_force(spark):
    for seed, spread in ((0, 0.05), (1, 0.6), (2, 0.0)):  # the last: few different vectors, so ties everywhere
        v = clumps(700, 64, seed, spread)
        ids = [i if i % 50 else None for i in range(len(v))]
        got = centroids.cluster(frame(spark, list(zip(ids, v.tolist()))))
        assert clusters(got) == plain_clusters(ids, v)


def test_clusters_of_odd_rows(spark):
    v = clumps(30, 64, 4)
    rows = [(i % 20, x) for i, x in enumerate(v.tolist())]  # repeated ids, fewer rows than centroids
    odd = [(100, None), (101, []), (102, v[0].tolist()[:-1]), (103, [None] + v[0].tolist()[1:]),
           (104, [float("nan")] + v[0].tolist()[1:]), (105, [float("inf")] + v[0].tolist()[1:])]
    got = centroids.cluster(frame(spark, rows + odd))
    assert clusters(got) == plain_clusters([i for i, _ in rows], v)
    empty = centroids.cluster(frame(spark, odd[:2]))
    assert empty.count() == 0 and empty.columns == got.columns
    assert centroids.cluster(frame(spark, rows), k=1).select("cluster").distinct().collect()[0][0] == 0
    with pytest.raises(Exception, match="over"):
        centroids.cluster(frame(spark, [(1, [1e30] * 64)])).collect()


def test_shallot_search_measures_less_than_a_full_scan():
    rng = np.random.default_rng(5)
    c = (rng.normal(size=(40, 64)) * 1000).astype(np.int64)
    x = c[rng.integers(0, 40, 2000)] + rng.integers(-20, 20, (2000, 64))
    near = centroids.Neighbours(c)
    want = centroids.full_scan(x, c)
    first, d1, second, d2, measured = near.search(x, want[0].copy(), (want[0] + 1) % 40)
    assert (first == want[0]).all() and (d1 == want[1]).all() and (d2 == want[3]).all()
    assert measured < len(x) * 40
    # from wrong starts too; ties go to the smaller number
    c[7] = c[3]
    near, want = centroids.Neighbours(c), centroids.full_scan(x, c)
    got = near.search(x, rng.integers(0, 20, 2000), rng.integers(20, 40, 2000))
    assert all((g == w).all() for g, w in zip(got, want))


def test_registered_clusters(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    got = QUERIES["op12_shallot_centroids"](spark, SF_SMALL)
    assert clusters(got) == plain_clusters([r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float32))


# ---------------------------------------------------------------- whitening
@pytest.mark.parametrize("spectrum,wanted", [("flat", 32), ("falling", 32), ("low rank", 12), ("repeated", 8)])
def test_leading_pairs(spectrum, wanted):
    rng = np.random.default_rng(1)
    d = 150
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    e = {"flat": 1 + rng.random(d), "falling": 0.9 ** np.arange(d), "low rank": np.r_[np.arange(1.0, 13), np.zeros(d - 12)],
         "repeated": np.r_[np.full(5, 3.0), np.ones(d - 5)]}[spectrum]
    v = (q * e) @ q.T
    calls = []
    values, vectors = whitening.leading_pairs(lambda b: calls.append(b.shape[1]) or v @ b, d, wanted)
    assert np.allclose(values, np.sort(e)[::-1][:wanted], rtol=0, atol=1e-13)
    assert np.abs(v @ vectors - vectors * values).max() < 1e-12 * e.max()
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-13


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    b = rng.standard_normal((30, 4))
    shift = np.array([0.0, 1.0, -2.0, 0.5])
    x = whitening.minres(lambda t: a @ t - t * shift, b, 60)
    assert np.abs(a @ x - x * shift - b).max() < 1e-6
    assert (whitening.minres(lambda t: a @ t, np.zeros((30, 2)), 5) == 0).all()


def check_whitened(rows, ids, vectors, components=32):
    x = np.floor(64 * vectors.astype(np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    c = x - sums / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > len(e) * 2.3e-16 * e[0]).sum()))
    assert len(rows) == n * k and {r.component for r in rows} == set(range(1, k + 1))
    assert {r.n for r in rows} == {n} and max(r.identity_error for r in rows) < 1e-10
    assert all(abs(r.explained / (e[r.component - 1] / e.sum()) - 1) < 1e-9 for r in rows)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {}).setdefault(r.component, []).append((r.whitened, int(r.deviation)))
    by_id = {}
    for i, y, centred in zip(ids, x, c):
        by_id.setdefault(i, []).append((sum((n * int(p) - int(q)) ** 2 for p, q in zip(y, sums)), centred))
    for i, found in got.items():
        for dev in [sorted(d for _, d in cell) for cell in found.values()]:
            assert dev == sorted(d for d, _ in by_id[i])
    w = np.array([[got[i][j][0][0] for j in range(1, k + 1)] for i in got])
    want = np.array([by_id[i][0][1] for i in got]) @ u[:, :k] / np.sqrt(e[:k])
    sign = np.sign((w * want).sum(axis=0))
    assert np.abs(w * sign - want).max() < 1e-6


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(3)
    v = (rng.normal(size=(400, 40)) @ rng.normal(size=(40, 40)) + 5).astype(np.float32)
    ids = list(range(400))
    check_whitened(whitening.whiten(frame(spark, list(zip(ids, v.tolist())))).collect(), ids, v)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(60, 5)).astype(np.float32)
    v[:, 4] = 2.0  # no variance: that direction is left out
    ids = list(range(59)) + [None]
    odd = [(100, None), (101, []), (103, [None] * 5), (104, [float("nan")] * 5), (105, [float("-inf")] + [0.0] * 4), (106, [1.0] * 7)]
    df = frame(spark, list(zip(ids, v.tolist())) + odd)
    rows = whitening.whiten(df).collect()
    assert {r.component for r in rows} == {1, 2, 3, 4}
    check_whitened(rows, ids, v)
    empty = whitening.whiten(frame(spark, odd[:2]))
    assert empty.count() == 0 and empty.columns == whitening.whiten(df).columns
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0])])).count() == 0


def test_registered_whitening(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    got = QUERIES["op13_jacobi_davidson_whitening"](spark, SF_SMALL)
    assert dict(got.dtypes)["deviation"] == "bigint"
    check_whitened(got.collect(), [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float32))
