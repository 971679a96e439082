"""k-means whose number of centres grows with the rows.

Equal rows are one weighted row. Rows are dealt once into Voronoi cells around a bounded number of pivots, as in
:mod:`cohortml.operators.neighbors`; each round a centre is sent only to the cells that may hold a row nearest to it, and a
cell is searched in groups of at most about ``ROW_CHUNK`` rows. With ``far`` the largest distance from a row of the cell to
the centre that had it, plus that centre's shift since, a centre is left out if it is farther than ``far`` from
every place the cell's rows can be at (the triangle inequality and the plane between two pivots). The assignment
is exact; ties go to the smaller number. Only a number per cell reaches the driver.

The first centres are distinct rows, drawn without replacement in ``BATCHES`` parts: the first by weight, the others by
weight times squared distance to the nearest centre so far, which is k-means++ in batches.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortml.functions.arrays import list_matrix
from cohortml.functions.hashing import hash_int, hash_uniform
from cohortml.functions.ordered import row_numbers
from cohortml.operators import neighbors as N

BATCHES = 4


def _reach(dq: np.ndarray, between: np.ndarray, radius: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Which cells (columns: distances to their pivots) may hold a row that is within the cell's ``far`` of a centre."""
    i = np.arange(len(dq))
    own = dq.argmin(axis=1)
    sep = between[own]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.where(sep > 0, (dq ** 2 - dq[i, own][:, None] ** 2) / (2.0 * sep), 0.0)
    low = np.maximum(np.maximum(plane, dq - radius), 0.0)
    return (low <= far + (far + dq) * 1e-9 + 1e-12) & (radius > -np.inf)


class _Cells:
    """Weighted rows ``(x, w)`` in cells around pivots, each cell in groups of about ``ROW_CHUNK`` rows, written once."""

    def __init__(self, points: DataFrame, seed):
        spark = points.sparkSession
        points = points.withColumn("_id", F.xxhash64("x")).checkpoint(eager=True)
        self.pivots = spark.sparkContext.broadcast(N.choose_pivots(points, "_id", "x", seed=seed))
        cells = N._assign_cells(points, "x", self.pivots).checkpoint(eager=True)
        p = len(self.pivots.value)
        radius, chunks = np.full(p, -np.inf), np.zeros(p, np.int64)
        for r in cells.groupBy("cell").agg(F.max("dpiv").alias("rad"), F.count(F.lit(1)).alias("n")).collect():  # one row per pivot
            radius[r["cell"]], chunks[r["cell"]] = r["rad"], -(-r["n"] // N.ROW_CHUNK)
        self.radius, self.chunks = radius, chunks
        begin = np.cumsum(chunks) - chunks  # number of a cell's first group
        table = spark.createDataFrame([(c, int(begin[c]), int(chunks[c])) for c in range(p)], "cell int, _begin long, _n long")
        self.rows = (cells.drop("dpiv").join(F.broadcast(table), "cell")
                     .select("_id", "x", "w", "cell", (F.col("_begin") + F.pmod(hash_int("chunk", "_id"), "_n")).alias("_g"))
                     .checkpoint(eager=True))

    def unbounded(self, centres: DataFrame) -> np.ndarray:
        """``far`` without a round before: the centre nearest to the pivot is within its distance and the radius of every row."""
        pivots = self.pivots

        def least(batches):
            import pyarrow as pa
            piv = pivots.value
            best = np.full(len(piv), np.inf)
            for b in batches:
                if b.num_rows:
                    c = list_matrix(b.column(0))
                    for i in range(0, len(c), N.ROW_CHUNK):
                        best = np.minimum(best, N._pivot_distances(c[i:i + N.ROW_CHUNK], piv).min(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(piv), dtype="int32")), pa.array(best)], names=["cell", "d"])

        far = np.zeros(len(self.radius))
        for r in centres.select("c").mapInArrow(least, "cell int, d double").groupBy("cell").agg(F.min("d").alias("d")).collect():
            far[r["cell"]] = r["d"]
        return far + np.maximum(self.radius, 0.0)

    def _met(self, centres: DataFrame, far: np.ndarray):
        """Rows by group, cogrouped with the centres ``(number, c)`` that may be nearest to one of them."""
        pivots, radius, chunks = self.pivots, self.radius, self.chunks
        cell_of = np.repeat(np.arange(len(chunks)), chunks)

        def sent(batches):
            import pyarrow as pa
            piv = pivots.value
            between = N._pivot_distances(piv, piv)
            numbers = np.arange(len(cell_of), dtype=np.int64)
            step = max(1, N.PORTION // 4 // max(1, len(cell_of)))
            for b in batches:
                for i in range(0, b.num_rows, step):
                    part = b.slice(i, step)
                    keep = _reach(N._pivot_distances(list_matrix(part.column(1)), piv), between, radius, far)
                    groups = pa.array(N._lists(keep[:, cell_of], numbers), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), groups], names=["number", "c", "_gs"])

        # few centres lie in one partition, but each is compared with all pivots
        tasks = centres.sparkSession.sparkContext.defaultParallelism
        copies = (centres.select("number", "c").repartition(tasks, "number").mapInArrow(sent, "number long, c array<double>, _gs array<long>")
                  .select("number", "c", F.explode("_gs").alias("_g")))
        return self.rows.groupBy("_g").cogroup(copies.groupBy("_g"))

    def distances(self, centres: DataFrame, far: np.ndarray) -> DataFrame:
        """``(_id, x, w, cell, d2)``: the squared distance of every row to its nearest centre."""
        schema = "_id long, x array<double>, w double, cell int, d2 double"

        def run(r, c):
            import pyarrow as pa
            if not r.num_rows:
                return pa.table([pa.array([], t) for t in (pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.int32(), pa.float64())],
                                names=["_id", "x", "w", "cell", "d2"])
            _, _, d2 = _nearest(r, c)
            return pa.table([r.column("_id"), r.column("x"), r.column("w"), r.column("cell"), pa.array(d2)],
                            names=["_id", "x", "w", "cell", "d2"])
        return self._met(centres, far).applyInArrow(run, schema)

    def sums(self, centres: DataFrame, far: np.ndarray) -> DataFrame:
        """``(cell, number, total, w, far)`` per centre and group: sum and weight of its rows, and the farthest one."""
        schema = "cell int, number long, total array<double>, w double, far double"

        def run(r, c):
            import pyarrow as pa
            if not r.num_rows:
                return pa.table([pa.array([], t) for t in (pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.float64())],
                                names=["cell", "number", "total", "w", "far"])
            x, number, d2 = _nearest(r, c)
            w = r.column("w").to_numpy()
            found, at = np.unique(number, return_inverse=True)
            total, farthest = np.zeros((len(found), x.shape[1])), np.zeros(len(found))
            np.add.at(total, at, x * w[:, None])
            np.maximum.at(farthest, at, d2)
            cell = np.full(len(found), r.column("cell")[0].as_py(), "int32")
            return pa.table([pa.array(cell), pa.array(found), pa.array(list(total), pa.list_(pa.float64())),
                             pa.array(np.bincount(at, w)), pa.array(np.sqrt(farthest))], names=["cell", "number", "total", "w", "far"])
        return self._met(centres, far).applyInArrow(run, schema)

    def per_cell(self, table: DataFrame, far, shift=F.lit(0.0)) -> tuple[np.ndarray, float]:
        """The largest ``far`` of every cell, and the largest ``shift`` of all."""
        out, moved = np.zeros(len(self.radius)), 0.0
        for r in table.groupBy("cell").agg(F.max(far).alias("far"), F.max(shift).alias("shift")).collect():  # one row per pivot
            out[r["cell"]], moved = r["far"], max(moved, r["shift"])
        return out, moved


def _nearest(r, c):
    """Rows as a matrix, the number of the nearest centre of each, and the squared distance to it."""
    x = list_matrix(r.column("x").combine_chunks())
    number = c.column("number").to_numpy()
    order = np.argsort(number)
    number, m = number[order], list_matrix(c.column("c").combine_chunks())[order]
    step = max(1, N.PORTION // max(1, m.size))
    at = np.concatenate([((x[i:i + step, None, :] - m[None, :, :]) ** 2).sum(-1).argmin(axis=1) for i in range(0, len(x), step)])
    return x, number[at], ((x - m[at]) ** 2).sum(-1)


def _drawn(rows: DataFrame, share, n: int, first: int, seed: str) -> DataFrame:
    """``n`` rows or fewer as centres numbered from ``first``, drawn without replacement in proportion to ``share``."""
    keyed = rows.where(share > 0).select("_id", "x", (-F.log1p(-hash_uniform(seed, "_id")) / share).alias("_h"))
    return (row_numbers(keyed, [], ["_h", "_id"], "_n").where(F.col("_n") <= n)
            .select((F.col("_n") + F.lit(first - 1)).alias("number"), F.col("x").alias("c")).checkpoint(eager=True))


def _means(held: DataFrame) -> DataFrame:
    return (held.groupBy("number").agg(vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total"), F.sum("w").alias("w"))
            .select("number", F.transform("total", lambda v: v / F.col("w")).alias("mean")))


def cluster_means(rows: DataFrame, k: int, seed=42, rounds: int = 50, tol: float = 1e-4) -> DataFrame:
    """``(number, mean)`` of the rows of every cluster that has any, after at most ``rounds`` rounds of ``k``-means on
    ``rows`` (column ``x``); the rounds end when no centre moves by more than ``tol``. Fewer than ``k`` distinct rows are a centre each."""
    cells = _Cells(rows.groupBy("x").agg(F.count(F.lit(1)).cast("double").alias("w")), seed)
    sizes = [k // BATCHES + (i < k % BATCHES) for i in range(BATCHES)]
    centres = _drawn(cells.rows, F.col("w"), sizes[0], 0, f"{seed}:centre:0")
    far, known = cells.unbounded(centres), sizes[0]
    for i, n in enumerate(sizes[1:], 1):
        at = cells.distances(centres, far).checkpoint(eager=True)
        far, _ = cells.per_cell(at, F.sqrt("d2"))
        centres = centres.unionByName(_drawn(at, F.col("w") * F.col("d2"), n, known, f"{seed}:centre:{i}")).checkpoint(eager=True)
        known += n
    for _ in range(int(rounds)):
        held = cells.sums(centres, far).checkpoint(eager=True)
        centres = (centres.select("number", F.col("c").alias("old")).join(_means(held), "number", "left")
                   .select("number", "old", F.coalesce("mean", "old").alias("c"))
                   .select("number", "c", F.sqrt(N.sq_dist(F.col("old"), F.col("c"))).alias("shift")).checkpoint(eager=True))
        far, moved = cells.per_cell(held.join(centres.select("number", "shift"), "number"), F.col("far") + F.col("shift"), F.col("shift"))
        if moved <= tol:  # a centre without rows stays
            break
    return _means(cells.sums(centres, far))
