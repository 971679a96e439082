"""The registered report queries run the operators' defaults and return every table."""

import inspect

import __spark_entry__ as E
from conftest import SF_SMALL

from cohortml.operators import explain
from cohortml.operators.symbolic import learn_symbolic
from cohortml.plans import q_extra


def bound(function, args, options):
    call = inspect.signature(function).bind(*args, **options)
    call.apply_defaults()
    return call.arguments


def test_defaults_are_passed(spark, monkeypatch):
    seen = []

    def note(function):
        def run(*args, **options):
            seen.append(bound(function, args, options))
            return seen
        return run

    monkeypatch.setattr(explain, "permutation_attributions", note(explain.permutation_attributions))
    E.queries()["shap_permutation"](spark, SF_SMALL)
    assert (seen[0]["n_perm"], seen[0]["n_background"]) == (4, 100)
    del seen[:]
    for name in ("learn_symbolic", "symbolic_report"):
        monkeypatch.setattr(q_extra, "learn_symbolic", lambda *a, **o: seen.append(bound(learn_symbolic, a, o)) or 1 / 0)
        try:
            E.queries()[name](spark, SF_SMALL)
        except ZeroDivisionError:
            pass
    assert [(s["population"], s["generations"]) for s in seen] == [(40, 4)] * 2


def test_all_tables_are_returned(spark):
    def names(query):
        return {r["report"] for r in E.queries()[query](spark, SF_SMALL).select("report").distinct().collect()}

    assert names("visual_report") == {"confusion", "report", "roc", "pr", "average_precision", "gain", "lift", "calibration", "histogram",
                                      "ks_curve", "ks", "projection"}
    assert names("retrieve_features") == {"first_filter", "second_filter", "shap", "shap_mean_abs"}
