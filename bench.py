"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is materialised with the ``noop`` sink (full computation, no
output); one warm-up run, then the median of ``$BENCH_RUNS`` (default 3)
timed runs. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship",
    "stratified_split",
    "standard_scale",
    "score_pearson",
    "score_spearman",
    "score_kruskal",
    "score_distancecorr",
    "score_chi2",
    "score_f_classif",
    "score_mutual_info_classif",
    "select_k_best",
    "m_auc",
    "roc_curve",
    "roc_mean_by_family",
    "gain_curve",
    "calibration_curve",
    "shap_values",
    "shap_interactions",
    "knn_join",
    "rs_smote",
    "fam_logistic",
    "fam_rf",
    "fam_knn",
    "embed_hsic",
    "cross_validate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from cohortml.plans.flagship import flagship
    from cohortml.queries import load_all
    from cohortml.session import get_spark
    spark = get_spark(master=f"local[{cpus}]", partitions=int(cpus))
    reg = load_all()
    times = {}
    only = [x for x in os.environ.get("BENCH_ONLY", "").split(",") if x]
    for name in (only or HEADLINE):
        build = (lambda s, d: flagship(s, d)) if name == "flagship" else reg[name].spark

        def once():
            t0 = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        try:
            once()  # warm-up
            times[name] = round(statistics.median(once() for _ in range(runs)), 3)
        except Exception as e:  # noqa: BLE001 - report and keep going
            print(f"bench: {name} failed: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_sec_headline_queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus), "runs": runs, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
