"""Plan checks: no cartesian products in the declared-scalable queries; scans are pruned."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

SCALABLE = ["score_kruskal", "score_spearman", "score_distancecorr", "score_mutual_info_classif",
            "m_auc", "roc_curve", "gain_curve", "ks_curve", "stratified_split", "standard_scale",
            "shap_interactions", "knn_join"]


@pytest.mark.parametrize("name", SCALABLE)
def test_no_cartesian(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns(spark):
    from cohortml.sources import tables as T
    df = T.nonneg_matrix(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "l_orderkey" not in plan


def test_matrix_file_takes_no_column_per_sample(spark, tmp_path, monkeypatch):
    """More samples than a piece of a line; gaps, nulls and repeated rows; names in order; nothing is pivoted or collected by sample."""
    from cohortml.sources import files as FS
    monkeypatch.setattr(FS, "FIELDS", 7)
    rows = [(f"s{i}", f"f{j}", None if i == 5 else i + j / 8) for i in range(40) for j in range(3) if (i, j) != (9, 1)]
    df = spark.createDataFrame([*rows, rows[0], rows[0], (None, "f2", 4.0)], "sample string, feature string, value double")
    seen = []
    frame = type(df)
    plain = frame.collect
    monkeypatch.setattr(frame, "collect", lambda d: seen.append(plain(d)) or seen[-1])
    path = FS.write_matrix_csv(df, f"{tmp_path}/m")
    out = FS.read_matrix_csv(spark, path, log1p=False)
    assert sum(map(len, seen)) <= 2
    monkeypatch.undo()
    got = {(r["sample"], r["feature"]): r["value"] for r in out.collect()}
    assert out.count() == len(got) == 41 * 3
    assert got == {(s, f): None for s in [*(f"s{i}" for i in range(40)), "null"] for f in ("f0", "f1", "f2")} | {r[:2]: r[2] for r in rows} | {("null", "f2"): 4.0}
    lines = [r[0] for r in spark.read.text(path).collect()]
    assert lines[0].split(",") == ["feature", *sorted([*(f"s{i}" for i in range(40)), "null"])]
    empty = FS.write_matrix_csv(df.limit(0), f"{tmp_path}/none")
    assert FS.read_matrix_csv(spark, empty).count() == 0
