"""Centroid clustering with the Shallot search: exact nearest centroids behind bounds.

A row carries its centroid, the second-nearest one of its last search, an upper bound of the distance
to the first and a lower bound of the distance to all others. When centroids move, the bounds widen by
the moves; while the upper one stays below the lower one the row needs no distance. Otherwise the row
measures both remembered centroids, starts from the closer one and walks that centroid's neighbours
by rising distance. The ball that can hold a better centroid has the sum of the row's distances to the start and to
the second-best so far as its radius; it shrinks with every better find, and the walk ends at its edge.
Distances are whole numbers and are compared as such, so ties go to the smaller number.

A round writes the rows with their new bounds as a table; sums per centroid are formed within each
task, and ``k`` sums come back. The driver holds the ``k`` centroids and nothing that grows with the rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from cohortml.llm.common import remove_path, scratch_path, stored
from cohortml.llm.vectors import integer_vectors, lists, matrix

#: Bounds are widened by this much, far over the rounding of a root and a few sums.
SLACK = 1e-12


def measure(x, c):
    """Exact squared distances of the rows of ``x`` to the rows of ``c`` (one to one), as longs."""
    d = x - c
    return (d * d).sum(axis=1)


def full_scan(x, centroids):
    """``(first, d1, second, d2)`` of every row from all centroids; ``second`` is -1 if there is only one."""
    import numpy as np
    k = len(centroids)
    rows = np.arange(len(x))
    if max(np.abs(x).max(), np.abs(centroids).max()) < 1 << 20 and x.shape[1] <= 1 << 10:
        # whole numbers below 2^53 are exact in doubles
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        all_d = ((a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    else:
        all_d = np.stack([measure(x, c) for c in centroids], axis=1)
    first = all_d.argmin(axis=1)
    d1 = all_d[rows, first]
    if k == 1:
        return first, d1, np.full(len(x), -1), np.full(len(x), np.iinfo(np.int64).max)
    all_d[rows, first] = np.iinfo(np.int64).max
    second = all_d.argmin(axis=1)
    return first, d1, second, all_d[rows, second]


class Neighbours:
    """The centroids of a round, with each one's neighbours by rising distance."""

    def __init__(self, centroids):
        import numpy as np
        self.centroids = centroids
        k = len(centroids)
        gap = np.sqrt(np.stack([measure(centroids, c) for c in centroids]).astype(np.float64))
        self.order = np.argsort(gap, axis=1, kind="stable")
        self.gap = np.take_along_axis(gap, self.order, axis=1) * (1 - SLACK)
        self.k = k

    def search(self, x, first, second):
        """Nearest and second-nearest centroids of ``x``, beginning at two remembered ones: ``(first, d1, second, d2, measured)``."""
        import numpy as np
        c = self.centroids
        d1, d2 = measure(x, c[first]), measure(x, c[second])
        swap = (d2 < d1) | ((d2 == d1) & (second < first))
        first, second = np.where(swap, second, first), np.where(swap, first, second)
        d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
        start, other = first.copy(), second.copy()
        reach = np.sqrt(d1.astype(np.float64)) * (1 + SLACK)
        live, measured = np.arange(len(x)), 2 * len(x)
        for step in range(self.k):
            ball = reach[live] + np.sqrt(d2[live].astype(np.float64)) * (1 + SLACK)
            live = live[self.gap[start[live], step] <= ball]
            if not len(live):
                break
            j = self.order[start[live], step]
            new = (j != start[live]) & (j != other[live])
            at, j = live[new], j[new]
            d = measure(x[at], c[j])
            measured += len(at)
            best = (d < d1[at]) | ((d == d1[at]) & (j < first[at]))
            next_best = ~best & ((d < d2[at]) | ((d == d2[at]) & (j < second[at])))
            b = at[best]
            second[b], d2[b] = first[b], d1[b]
            first[b], d1[b] = j[best], d[best]
            m = at[next_best]
            second[m], d2[m] = j[next_best], d[next_best]
        return first, d1, second, d2, measured


def assign(x, first, second, upper, lower, moves, near: Neighbours):
    """The state of the rows after the centroids moved by ``moves``: ``(first, second, upper, lower)``."""
    import numpy as np
    if near.k == 1:
        return first, second, upper, lower
    most = np.argsort(moves)[::-1]
    others = np.where(first == most[0], moves[most[1]], moves[most[0]])
    upper = (upper + moves[first]) * (1 + SLACK)
    lower = np.maximum(lower - others, 0.0) * (1 - SLACK)
    doubt = np.flatnonzero(upper >= lower)
    if len(doubt):
        exact = np.sqrt(measure(x[doubt], near.centroids[first[doubt]]).astype(np.float64)) * (1 + SLACK)
        upper[doubt] = exact
        doubt = doubt[exact >= lower[doubt]]
    if len(doubt):
        f, d1, s, d2, _ = near.search(x[doubt], first[doubt], second[doubt])
        first[doubt], second[doubt] = f, s
        upper[doubt] = np.sqrt(d1.astype(np.float64)) * (1 + SLACK)
        lower[doubt] = np.sqrt(d2.astype(np.float64)) * (1 - SLACK)
    return first, second, upper, lower


def _sums(state: DataFrame, k: int, d: int) -> tuple[list, list]:
    """Rows and exact component sums of every centroid: added up in each task, then per centroid and component."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        count, total = np.zeros(k, np.int64), [[0] * d for _ in range(k)]
        for b in batches:
            x, first = matrix(b.column(0)), np.asarray(b.column(1))
            for j in np.unique(first).tolist():
                mine = x[first == j]
                count[j] += len(mine)
                total[j] = [p + q for p, q in zip(total[j], mine.sum(axis=0).tolist())]
        used = np.flatnonzero(count).tolist()
        yield pa.RecordBatch.from_arrays([
            pa.array(used, pa.int32()), pa.array(count[used]), pa.array([total[j] for j in used], pa.list_(pa.int64()))],
            names=["cluster", "n", "total"])

    parts = state.select("x", "cluster").mapInArrow(run, "cluster int, n long, total array<long>")
    rows = (parts.select("cluster", "n", F.posexplode("total").alias("place", "v")).groupBy("cluster", "place")
            .agg(F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect())
    counts, sums = [0] * k, [[0] * d for _ in range(k)]
    for r in rows:
        counts[r["cluster"]], sums[r["cluster"]][r["place"]] = r["n"], int(r["v"])
    return counts, sums


def cluster(rows: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, length: int = 64, seed: int = 2,
            key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every sound vector.

    A sound vector has exactly ``length`` components, none null or non-finite; a component counts as the integer
    ``floor(scale * component)``. The ``k`` vectors with the smallest SHA-256 of ``seed:key`` (ties:
    smaller integers first) are the first centroids; each round assigns all vectors and moves every
    centroid with vectors to the floor of their mean. The vectors are assigned once more at the end.

    Other vectors are dropped. Repeated rows count each; a null key is hashed as the word ``null``. With fewer
    than ``k`` vectors each is a centroid; without any the result is empty.
    """
    import numpy as np
    spark = rows.sparkSession
    state_schema = StructType([StructField(key, rows.schema[key].dataType), StructField("x", ArrayType(LongType())),
                               StructField("cluster", IntegerType()), StructField("second", IntegerType()),
                               StructField("upper", DoubleType()), StructField("lower", DoubleType())])
    key_type = to_arrow_type(rows.schema[key].dataType)
    path = scratch_path(spark, "centroids")
    state = stored(integer_vectors(rows, key, vector, scale, length), path)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))), 256)
    chosen = state.select(digest.alias("digest"), "x").orderBy("digest", "x").limit(k).collect()
    if not chosen:
        return spark.createDataFrame([], StructType([state_schema[key], *StructType.fromDDL(
            "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string").fields]))
    k = len(chosen)
    centroids = np.array([r["x"] for r in chosen], np.int64).reshape(k, length)
    moves = None

    def step(centroids, moves, fresh):
        def run(batches):
            import pyarrow as pa
            near = Neighbours(centroids)
            for b in batches:
                if not b.num_rows:
                    continue
                x = matrix(b.column(1))
                if fresh:
                    first, d1, second, d2 = full_scan(x, centroids)
                    upper, lower = np.sqrt(d1.astype(np.float64)) * (1 + SLACK), np.sqrt(d2.astype(np.float64)) * (1 - SLACK)
                else:
                    first, second, upper, lower = assign(
                        x, *[np.array(b.column(i)) for i in (2, 3, 4, 5)], moves, near)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).cast(key_type), lists(x), pa.array(first, pa.int32()), pa.array(second, pa.int32()),
                     pa.array(upper), pa.array(lower)], names=state_schema.names)
        return run

    for i in range(rounds + 1):
        now = scratch_path(spark, "centroids")
        columns = [key, "x"] if i == 0 else state_schema.names
        state = stored(state.select(*columns).mapInArrow(step(centroids, moves, i == 0), state_schema), now)
        remove_path(spark, path)
        path = now
        if i < rounds:
            counts, sums = _sums(state, k, length)
            new = np.array([[v // n for v in s] if n else c for s, n, c in zip(sums, counts, centroids.tolist())], np.int64)
            moves = np.sqrt(measure(new, centroids).astype(np.float64)) * (1 + SLACK)
            centroids = new

    def final(batches):
        import pyarrow as pa
        for b in batches:
            if b.num_rows:
                first = np.asarray(b.column(2))
                yield pa.RecordBatch.from_arrays([b.column(0).cast(key_type), b.column(2), pa.array(measure(matrix(b.column(1)), centroids[first]))],
                                                 names=[key, "cluster", "distance"])

    out_schema = StructType([state_schema[key], state_schema["cluster"], StructField("distance", LongType())])
    result = state.select(key, "x", "cluster").mapInArrow(final, out_schema)
    inertia = {r["cluster"]: int(r["v"]) for r in result.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("v")).collect()}
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return result.select(key, "cluster", "distance",
                         F.get(F.array(*[F.lit(inertia.get(j, 0)).cast("long") for j in range(k)]), F.col("cluster")).alias("cluster_inertia"),
                         F.lit(sum(inertia.values())).cast("long").alias("inertia"),
                         F.get(F.array(*[F.lit(s) for s in shas]), F.col("cluster")).alias("centroid_sha256"))
