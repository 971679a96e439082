"""Projections and their report against dense NumPy."""

import numpy as np
import pytest

from cohortml.operators import project as PR
from cohortml.plans import pipeline as P
from cohortml.plans.reports import projection_report, visual_report


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(200, 6)) * np.array([1.0, 2, 0.5, 1, 1, 3])
    x[:, 1] += x[:, 0] ** 2
    y = (x[:, 0] + 0.3 * rng.normal(size=200) > 0.2).astype(int)
    df = spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))],
                               "row_id long, x array<double>, label int").repartition(11)
    return df, x, y


def coordinates(df, column="x"):
    found = {r["row_id"]: r[column] for r in df.collect()}
    return np.array([found[i] for i in sorted(found)])


def up_to_sign(a, b, tolerance=1e-8):
    assert a.shape == b.shape
    sign = np.sign((a * b).sum(axis=0))
    assert np.abs(a * sign - b).max() < tolerance


def dense_kernel_pca(x, k, kernel, **options):
    full = PR.kernel_matrix(x, x, kernel, **options)
    n = len(x)
    centre = np.eye(n) - np.ones((n, n)) / n
    values, vectors = np.linalg.eigh(centre @ full @ centre)
    return vectors[:, ::-1][:, :k] * np.sqrt(values[::-1][:k])


@pytest.mark.parametrize("kernel", PR.KERNELS[:3])
def test_kernel_pca_of_all_rows_as_landmarks_is_dense_kernel_pca(rows, kernel):
    df, x, _ = rows
    p = PR.fit_kernel_pca(df, 3, kernel)
    up_to_sign(coordinates(p.transform(df)), dense_kernel_pca(x, 3, kernel, gamma=1 / 6), 1e-6)
    if kernel == "linear":
        up_to_sign(coordinates(p.transform(df)), coordinates(PR.fit_pca(df, 3).transform(df)), 1e-8)
    if kernel == "rbf":
        assert np.abs(np.abs(coordinates(p.transform(df))) - np.abs(coordinates(PR.fit_pca(df, 3).transform(df)))).max() > 0.1


def test_landmarks_give_nearly_the_same_components(rows):
    df, x, _ = rows
    want = dense_kernel_pca(x, 2, "rbf", gamma=1 / 6)
    got = coordinates(PR.fit_kernel_pca(df, 2, "rbf", n_landmarks=80).transform(df))
    assert all(abs(np.corrcoef(g, w)[0, 1]) > 0.95 for g, w in zip(got.T, want.T))
    with pytest.raises(ValueError):
        PR.fit_kernel_pca(df, 2, "nope")
    with pytest.raises(ValueError):
        PR.fit_kernel_pca(df.where("row_id < 0"), 2)


def test_pca_loadings_are_eigenvectors_of_the_covariance(spark, rows):
    df, x, _ = rows
    p = PR.fit_pca(df, 4)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    found = {(r.component, int(r.feature)): r.loading for r in p.loadings(spark).collect()}
    load = np.array([[found[f"PC{j + 1}", i] for j in range(4)] for i in range(6)])
    up_to_sign(load, vectors[:, ::-1][:, :4])
    z = coordinates(p.transform(df))
    assert np.allclose(np.cov(z.T), np.diag(values[::-1][:4]), atol=1e-8)
    assert np.allclose(z, (x - x.mean(axis=0)) @ load)


def test_projection_report(rows):
    df, x, y = rows
    chosen = [0, 1, 5]
    out = projection_report(df, chosen)
    z = (x[:, chosen] - x[:, chosen].mean(axis=0)) / x[:, chosen].std(axis=0)
    found = {(r.method, r.row_id): r for r in out.collect()}
    assert len(found) == 400
    got = {m: np.array([[found[m, i].c1, found[m, i].c2] for i in range(200)]) for m in ("pca", "kpca")}
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    up_to_sign(got["pca"], u[:, :2] * s[:2])
    up_to_sign(got["kpca"], dense_kernel_pca(z, 2, "rbf", gamma=1 / 3), 1e-6)
    assert [found["pca", i].label for i in range(200)] == y.tolist()


def test_visual_report_has_every_table_of_the_plots(rows):
    df, x, y = rows
    tr, te = df.where("row_id % 4 <> 0"), df.where("row_id % 4 = 0")
    fp = P.FittedPipeline(P.build_pipeline(family="logistic", first_filter={"function": "pearson", "mode": "k_best", "param": 3})).fit(tr)
    tables = visual_report(fp, tr, te)
    assert set(tables) == {"confusion", "report", "roc", "pr", "average_precision", "gain", "lift", "calibration", "histogram",
                           "ks_curve", "ks", "projection"}
    prob = {r.row_id: (r.prob, r.pred) for r in fp.predict(df).collect()}
    count = {(r["split"], r["true_label"], r["pred_label"]): r["count"] for r in tables["confusion"].collect()}
    for split, keep in (("train", lambda i: i % 4), ("test", lambda i: not i % 4)):
        for a in (0, 1):
            for b in (0, 1):
                assert count[split, a, b] == sum(1 for i in range(200) if keep(i) and y[i] == a and prob[i][1] == b)
    p = np.array([prob[i][0] for i in range(200)])
    gaps = [abs((p[y == 1] <= c).mean() - (p[y == 0] <= c).mean()) for c in p]
    assert tables["ks"].first()["ks"] == pytest.approx(max(gaps))
    assert tables["projection"].where("method = 'kpca'").count() == 200


def test_kernel_learner_is_saved_and_loaded(spark, rows, tmp_path):
    from cohortml.sources.files import load_model, save_model
    df, *_ = rows
    fp = P.FittedPipeline(P.build_pipeline(family="logistic", learner={"type": "kpca", "kernel": "rbf", "n_components": 3, "n_landmarks": 50})).fit(df)
    save_model(fp, str(tmp_path / "m"))
    again = load_model(spark, str(tmp_path / "m"))
    assert np.allclose(coordinates(fp.predict(df), "prob"), coordinates(again.predict(df), "prob"))
    assert again.pca.names() == ["Dimension1", "Dimension2", "Dimension3"]


def test_medians_of_many_columns(spark):
    from cohortml.operators.prep import impute_median
    rng = np.random.default_rng(0)
    v = rng.integers(0, 9, (50, 4)).astype(float)
    hole = rng.random((50, 4)) < 0.3
    hole[:, 3] = True
    df = spark.createDataFrame([(i, *[None if h else float(x) for x, h in zip(r, hs)]) for i, (r, hs) in enumerate(zip(v, hole))],
                               "row_id long, a double, b double, c double, d double")
    got = {r.row_id: r for r in impute_median(df, ["a", "b", "c", "d"]).collect()}
    for j, c in enumerate("abc"):
        median = np.median(v[~hole[:, j], j])
        assert [got[i][c] for i in range(50)] == [median if hole[i, j] else v[i, j] for i in range(50)]
    assert all(r["d"] is None for r in got.values())


def test_fold_ranking_leaves_vectors_alone(rows):
    from cohortml.operators.folds import stratified_kfold
    df, *_ = rows
    plan = stratified_kfold(df, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan  # the ranking itself is behind a checkpoint of keys and labels
    folds = stratified_kfold(df, 5)
    assert folds.columns.count("x") == 1 and folds.count() == 200
