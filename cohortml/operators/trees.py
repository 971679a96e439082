"""Growing of trees, level by level, shared by the forests and the booster.

A pass over the rows adds up histograms inside each task (NumPy, bounded by ``MOST_CELLS`` cells: the trees
of a level are taken in groups, the features in blocks). The partial sums meet by ``(tree, node, feature)``, where a task adds them up; prefix sums along
the bins and the search for the best cut run on the executors, which keep the best feature of each node. The driver
receives one row per node and shuffle partition, whatever the number of features and rows.
The totals of both children come with the split, so leaves need no pass of their own.

Nodes are numbered as in a heap: the children of ``n`` are ``2 n + 1`` (at most the cut) and ``2 n + 2``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortml.functions.arrays import list_matrix

#: Cells (trees x nodes x features x bins x statistics) that a task adds up at a time.
MOST_CELLS = 4_000_000
NO_SPLIT = -1


def children(node: int) -> tuple[int, int]:
    return 2 * node + 1, 2 * node + 2


def as_arrays(trees: list[dict], depth: int):
    """``(feature, cut)`` of all trees as ``trees x nodes`` matrices; -1 where a node does not split."""
    size = 2 ** (int(depth) + 1) - 1
    feature = np.full((len(trees), size), NO_SPLIT, np.int64)
    cut = np.zeros((len(trees), size))
    for t, tree in enumerate(trees):
        for node, (f, c) in tree["splits"].items():
            feature[t, node], cut[t, node] = f, c
    return feature, cut


def route(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """The node of every row of ``x`` in one tree (its row of both matrices)."""
    rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)
    for _ in range(int(depth)):
        f = feature[node]
        node = np.where(f >= 0, 2 * node + 1 + (x[rows, np.maximum(f, 0)] > cut[node]), node)
    return node


def quantile_cuts(df: DataFrame, vec: str, n_bins: int) -> list[list[float]]:
    """Per feature the inner cuts of ``n_bins`` quantile bins (one row per feature reaches the driver)."""
    qs = [i / n_bins for i in range(1, n_bins)]
    rows = (df.select(F.posexplode(vec).alias("f", "v")).groupBy("f")
            .agg(F.percentile_approx("v", qs, 10000).alias("c")).collect())
    cuts: list[list[float]] = [[] for _ in rows]
    for r in rows:
        cuts[r["f"]] = sorted(set(float(c) for c in r["c"]))
    return cuts


def binned(x: np.ndarray, cuts: list) -> np.ndarray:
    """For every value the number of its feature's cuts below it."""
    out = np.empty(x.shape, np.uint8)
    for f, c in enumerate(cuts):
        out[:, f] = np.searchsorted(c, x[:, f], side="left")
    return out


def byte_matrix(column) -> np.ndarray:
    """An Arrow column of equally long binary values as a matrix of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def best_splits(rows: DataFrame, histograms: Callable, n_bins: int, n_stats: int, gain: Callable) -> dict:
    """``{(tree, node): (gain, feature, bin, left totals, node totals)}`` of every node with rows.

    ``histograms``: from the Arrow batches of a task to ``(tree, node, feature, cells)`` arrays, cells being
    ``bins x statistics``. ``gain(left, total, tree)`` on ``(rows, bins, statistics)`` arrays gives the gain, ``-inf`` where
    a cut is not allowed. A node without an allowed cut has a gain of ``-inf``. Ties go to the smaller feature and bin.
    """
    width = n_bins * n_stats

    def partial(batches):
        import pyarrow as pa
        for tree, node, feature, cells in histograms(batches):
            for i in range(0, len(tree), 4096):
                part = np.ascontiguousarray(cells[i:i + 4096], np.float64).reshape(-1, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tree[i:i + 4096], pa.int32()), pa.array(node[i:i + 4096], pa.int32()), pa.array(feature[i:i + 4096], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * np.int32(width)), pa.array(part.ravel()))],
                    names=["tree", "node", "feature", "cells"])

    def summed(batches):
        """Keys and cells of the partition's sums: at most ``MOST_CELLS`` of them exist in a pass."""
        codes, cells, waiting = [], [], 0

        def reduce():
            distinct, place = np.unique(np.concatenate(codes), return_inverse=True)
            total = np.zeros((len(distinct), width))
            np.add.at(total, place, np.concatenate(cells))
            return distinct, total

        for b in batches:
            if b.num_rows:
                tree, node, feature = (np.asarray(b.column(i)).astype(np.int64) for i in range(3))
                codes.append((tree << 44) | (node << 24) | feature)
                cells.append(list_matrix(b.column(3)))
                waiting += b.num_rows
                if waiting > 1 << 15:
                    one, two = reduce()
                    codes, cells, waiting = [one], [two], 0
        return reduce() if codes else (np.zeros(0, np.int64), np.zeros((0, width)))

    def search(batches):
        import pyarrow as pa
        code, cells = summed(batches)
        tree, node, feature = code >> 44, (code >> 24) & 0xFFFFF, code & 0xFFFFFF
        left = np.cumsum(cells.reshape(-1, n_bins, n_stats), axis=1)
        total = left[:, -1:, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            found = gain(left[:, :-1, :], total, tree) if len(code) else np.zeros((0, 1))
        found = np.where(np.isnan(found), -np.inf, found)
        at = found.argmax(axis=1)
        gains = found[np.arange(len(at)), at]
        # the best feature of each node in this partition; ties go to the smaller one
        order = np.lexsort((feature, -gains, code >> 24))
        first = order[np.append(True, np.diff(code[order] >> 24) != 0)] if len(order) else order
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip((tree[first], node[first], feature[first], gains[first], at[first], left[first, at[first]].tolist(),
                                             total[first, 0].tolist()),
                                            (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64())))],
            names=["tree", "node", "feature", "gain", "bin", "left", "total"])

    best: dict = {}
    found = (rows.mapInArrow(partial, "tree int, node int, feature int, cells array<double>").repartition("tree", "node", "feature")
             .mapInArrow(search, "tree int, node int, feature int, gain double, bin int, left array<double>, total array<double>"))
    for r in found.collect():
        node = (r["tree"], r["node"])
        if node not in best or (r["gain"], -r["feature"]) > (best[node][0], -best[node][1]):
            best[node] = (r["gain"], r["feature"], r["bin"], np.array(r["left"]), np.array(r["total"]))
    return best
