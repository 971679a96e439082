"""Deterministic pseudo-random numbers from row keys.

Random draws are hashes of ``(seed, key...)`` rather than ``rand()``: a lost
executor recomputes exactly the same values, and the same numbers can be
written in plain SQL (``md5`` + hex prefix), which makes splits and samples
checkable against an SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15 hex digits = 60 bits, always a positive bigint.
_HEX_DIGITS = 15
_SCALE = float(16 ** _HEX_DIGITS)


def hash_key(seed, *cols) -> Column:
    """md5 of ``seed:col1:col2...`` as a string column."""
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                  for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def hash_int(seed, *cols) -> Column:
    """60-bit non-negative integer from the key (bigint)."""
    return F.conv(F.substring(hash_key(seed, *cols), 1, _HEX_DIGITS), 16, 10).cast("bigint")


def hash_uniform(seed, *cols) -> Column:
    """Uniform value in [0, 1) from the key."""
    return hash_int(seed, *cols).cast("double") / F.lit(_SCALE)


def sql_hash_int(seed, *exprs: str) -> str:
    """DuckDB twin of :func:`hash_int` for oracle SQL."""
    inner = " || ':' || ".join([f"'{seed}'"] + [f"CAST({e} AS VARCHAR)" for e in exprs])
    return f"('0x' || substr(md5({inner}), 1, {_HEX_DIGITS}))::BIGINT"


def sql_hash_uniform(seed, *exprs: str) -> str:
    return f"(CAST({sql_hash_int(seed, *exprs)} AS DOUBLE) / {_SCALE!r})"
