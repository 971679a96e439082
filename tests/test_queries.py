"""Differential test: every query with an oracle equals its DuckDB SQL (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import oracle_check
    return oracle_check.duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    import oracle_check
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    ddf = duck.execute(SQL[name]).df()
    assert oracle_check.compare(sdf, ddf) is None


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 64 and sum(r["selected"] for r in rows) == 10
