"""Arrow batches as matrices, and sums of bounded arrays over all rows of a table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

#: So many arrays are added up by one task, and at most so many reach the driver.
FAN_IN = 8


def list_matrix(column, dtype=np.float64) -> np.ndarray:
    """An Arrow column of equally long arrays without nulls as a matrix."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype).reshape(len(column), -1)


def fold_sum(rows: DataFrame, part) -> np.ndarray | None:
    """Sum over all Arrow batches of ``part(batch)`` (a flat array of one length); None without rows.

    Every task leaves one array; rounds of tasks add up ``FAN_IN`` of them each, so the driver never
    takes more than ``FAN_IN`` arrays, however many tasks there were.
    """
    def once(arrays):
        import pyarrow as pa
        total = None
        for a in arrays:
            total = np.array(a, np.float64) if total is None else total + a
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["v"])

    sums = rows.mapInArrow(lambda bs: once(part(b) for b in bs if b.num_rows), "v array<double>")
    n = max(1, rows.rdd.getNumPartitions())
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        sums = sums.repartition(n).mapInArrow(lambda bs: once(r for b in bs if b.num_rows for r in list_matrix(b.column(0))), "v array<double>")
    found = [np.array(r["v"]) for r in sums.collect()]
    return sum(found[1:], found[0]) if found else None


class MarginTrees:
    """Boosted trees as NumPy: per tree ``(splits, leaves)``, the probability from twice the sum of the leaves."""

    def __init__(self, trees: list):
        self.trees = trees

    def probability(self, low) -> np.ndarray:
        """``low(feature, threshold)``: the rows, of any shape, whose feature is at most the threshold."""
        total = 0.0
        for splits, leaves in self.trees:
            left = [low(f, t) for f, t in splits]
            for path, value in leaves:
                here = True
                for i, side in path:
                    here = here & (left[i] if side else ~left[i])
                total = total + here * value
        return 1.0 / (1.0 + np.exp(-2.0 * total))
