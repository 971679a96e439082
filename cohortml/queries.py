"""Registered queries: one Spark plan and (where SQL can say it) one DuckDB oracle per operator.

Each entry reads the driver's parquet tables (through the fixtures in
:mod:`cohortml.sources.tables`) and runs over whole tables. Double columns
listed in ``rounded`` are rounded to ``DIGITS`` decimals on both sides so the
two engines' last-bit differences do not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIGITS = 6


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    rounded: tuple[str, ...] = field(default_factory=tuple)

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        if self.rounded:
            # "+ 0.0" turns a rounded -0.0 into 0.0 so both engines print the same value
            df = df.withColumns({c: F.round(F.col(c).cast("double"), DIGITS) + F.lit(0.0) for c in self.rounded})
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.rounded:
            return self.sql
        rep = ", ".join(f"round(CAST({c} AS DOUBLE), {DIGITS}) + 0.0 AS {c}" for c in self.rounded)
        return f"SELECT * REPLACE ({rep}) FROM (\n{self.sql}\n) _q"


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, rounded: tuple[str, ...] = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(rounded))
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the modules registers their queries
    from cohortml.plans import (q_evaluate, q_explain, q_extra, q_io, q_models, q_neighbors,  # noqa: F401
                                q_prep, q_univariate)
    return REGISTRY
