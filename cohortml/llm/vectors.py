"""Vectors as NumPy matrices in Arrow batches, and sums of small arrays over a whole table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

#: Largest integer component: squares of differences of 64 such components still fit a long.
LARGEST = 1 << 27


def flat(column):
    """``(values, lengths, sound)`` of an Arrow list column: all entries as doubles in row order, the entries of
    each row, and whether the row is not null and holds neither a null nor a non-finite entry."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    values = column.flatten()
    entries = np.asarray(pc.fill_null(values.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False))
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    broken = np.bincount(row[~np.isfinite(entries)], minlength=len(lengths))
    return entries, lengths, pc.is_valid(column).to_numpy(zero_copy_only=False) & (broken == 0)


def matrix(column, dtype="int64"):
    """An Arrow list column without nulls and with rows of one length, as a matrix."""
    import numpy as np
    if not len(column):
        return np.zeros((0, 0), dtype)
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype).reshape(len(column), -1)


def lists(rows):
    """A matrix as an Arrow list array."""
    import numpy as np
    import pyarrow as pa
    n, d = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(d)), pa.array(rows.ravel()))


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: int, length: int | None = None) -> DataFrame:
    """``(key, x array<long>)``: ``floor(scale * entry)`` of every row whose vector is not null and has only
    finite entries (and ``length`` of them, if given). An integer over 2^27 is an error: exact squared
    distances would leave the range of a long."""
    schema = StructType([StructField(key, rows.schema[key].dataType), StructField("x", ArrayType(LongType()))])
    key_type = to_arrow_type(rows.schema[key].dataType)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            entries, lengths, sound = flat(b.column(1))
            if length is not None:
                sound = sound & (lengths == length)
            x = np.floor(scale * entries[np.repeat(sound, lengths)])
            if len(x) and np.abs(x).max() > LARGEST:
                raise ArithmeticError(f"a vector entry times {scale} is over {LARGEST}")
            ends = np.append(0, np.cumsum(lengths[sound])).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).filter(pa.array(sound)).cast(key_type),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int64)))], names=[key, "x"])

    return rows.select(F.col(key), F.col(vector)).mapInArrow(run, schema)


def fold(table: DataFrame, part, kind: str = "double") -> list:
    """The sum of ``part(x)`` (a flat array) over all batches ``x`` of the column ``x``; empty without rows.

    ``kind`` is ``double``, or ``string`` for exact sums of Python integers. A partition leaves one
    array; about the square root of as many tasks add those up, and only their arrays reach the driver.
    """
    schema = f"v array<{kind}>"
    width = max(1, math.isqrt(table.rdd.getNumPartitions()))

    def total(arrays):
        import numpy as np
        import pyarrow as pa
        done = None
        for a in arrays:
            done = a if done is None else ([p + q for p, q in zip(done, a)] if kind == "string" else done + a)
        if done is not None:
            out = [str(v) for v in done] if kind == "string" else np.asarray(done, np.float64).tolist()
            yield pa.RecordBatch.from_arrays([pa.array([out], pa.list_(pa.string() if kind == "string" else pa.float64()))],
                                             names=["v"])

    def read(batches):
        import numpy as np
        for b in batches:
            for v in b.column(0).to_pylist():
                yield [int(e) for e in v] if kind == "string" else np.array(v)

    sums = table.select("x").mapInArrow(lambda bs: total(part(matrix(b.column(0))) for b in bs if b.num_rows), schema)
    if width > 1:
        sums = sums.repartition(width).mapInArrow(lambda bs: total(read(bs)), schema)
    rows = [r["v"] for r in sums.collect()]
    if not rows:
        return []
    return [sum(int(r[i]) for r in rows) if kind == "string" else math.fsum(r[i] for r in rows) for i in range(len(rows[0]))]
