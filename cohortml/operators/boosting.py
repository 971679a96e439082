"""Second-order gradient boosting with L1/L2 leaf penalties and a split penalty.

Spark's ``GBTClassifier`` has no alpha / lambda / gamma, so trees are grown
here, level by level (see :mod:`cohortml.operators.trees`):

* features are cut into quantile bins once (``percentile_approx`` per
  feature over the LONG layout) and every row keeps one byte per feature;
* per level, sums of g and h per (node, feature, bin) are added up in the tasks and searched for the
  best cut on the executors; one row per node reaches the driver. Wide tables take their features in blocks;
* leaf values are ``-lr * S(G, alpha) / (H + lambda)`` with ``S`` the soft threshold;
* the margins are written with the rows every ``WRITE_EVERY`` trees; in between a pass adds the newer trees itself.

g = p - y, h = p (1 - p); gain = 1/2 [S(G_L)^2/(H_L+l) + S(G_R)^2/(H_R+l) - S(G)^2/(H+l)] - gamma.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortml.functions.hashing import hash_uniform
from cohortml.operators import trees as TR

#: Defaults of ``n_bins`` (quantile bins per feature) and ``min_child_weight`` (least Hessian sum of a child).
N_BINS = 32
MIN_CHILD_WEIGHT = 1.0
WRITE_EVERY = 16


def _soft(g, alpha):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def _margins(codes: np.ndarray, start, trees: list[dict], depth: int) -> np.ndarray:
    """``start`` plus the leaf values of ``trees`` for rows of bins."""
    feature, cut = TR.as_arrays(trees, depth)
    value = np.zeros(feature.shape)
    for t, tree in enumerate(trees):
        for node, v in tree["leaves"].items():
            value[t, node] = v
    out = np.array(start, np.float64) * np.ones(len(codes))
    for f, c, v in zip(feature, cut, value):
        out += v[TR.route(codes, f, c, depth)]
    return out


class BoostedTrees:
    def __init__(self, cuts, trees, base, depth):
        self.cuts, self.trees, self.base, self.depth = cuts, trees, base, depth

    def predict(self, df: DataFrame, vec: str = "x", key: str = "row_id", label: str = "label") -> DataFrame:
        cuts, trees, base, depth = self.cuts, self.trees, self.base, self.depth
        d = df.select(key, label, vec)
        schema = T.StructType([d.schema[key], d.schema[label], T.StructField("m", T.DoubleType())])

        def run(batches):
            import pyarrow as pa
            for b in batches:
                if b.num_rows:
                    codes = TR.binned(TR.list_matrix(b.column(2)), cuts)
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(_margins(codes, base, trees, depth))],
                                                     names=[key, label, "m"])

        prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("m")))
        return (d.mapInArrow(run, schema).select(key, label, prob.alias("prob"))
                .withColumn("pred", (F.col("prob") > 0.5).cast("int")))


def fit_xgboost(df: DataFrame, n_estimators: int = 100, max_depth: int = 3, learning_rate: float = 0.1,
                reg_alpha: float = 0.0, reg_lambda: float = 1.0, subsample: float = 1.0, gamma: float = 0.0,
                seed: int = 42, n_bins: int = N_BINS, min_child_weight: float = MIN_CHILD_WEIGHT, **_):
    from cohortml.operators.models import FittedModel
    max_depth = int(max_depth)
    d0 = df.select("row_id", "x", F.col("label").cast("double").alias("y")).checkpoint(eager=True)
    cuts = TR.quantile_cuts(d0, "x", n_bins)
    p0 = float(d0.agg(F.avg("y")).first()[0])
    p0 = min(max(p0, 1e-6), 1 - 1e-6)
    base = math.log(p0 / (1 - p0))
    stored = T.StructType([d0.schema["row_id"], T.StructField("y", T.DoubleType()), T.StructField("codes", T.BinaryType()),
                           T.StructField("m", T.DoubleType())])

    def code(batches):
        import pyarrow as pa
        for b in batches:
            if b.num_rows:
                codes = TR.binned(TR.list_matrix(b.column(1)), cuts)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([c.tobytes() for c in codes], pa.binary()),
                                                  pa.array(np.full(len(codes), base))], names=stored.names)

    def add(newer):
        def run(batches):
            import pyarrow as pa
            for b in batches:
                if b.num_rows:
                    m = _margins(TR.byte_matrix(b.column(2)), np.asarray(b.column(3)), newer, max_depth)
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(m)], names=stored.names)
        return run

    floor = max(min_child_weight, 1e-12)

    def gain(left, total, _tree):
        gl, hl, gt, ht = left[..., 0], left[..., 1], total[..., 0], total[..., 1]
        gr, hr = gt - gl, ht - hl
        found = 0.5 * (_soft(gl, reg_alpha) ** 2 / (hl + reg_lambda) + _soft(gr, reg_alpha) ** 2 / (hr + reg_lambda)
                       - _soft(gt, reg_alpha) ** 2 / (ht + reg_lambda)) - gamma
        return np.where((hl >= floor) & (hr >= floor), found, -np.inf)

    def leaf(stats):
        return float(-learning_rate * _soft(stats[0], reg_alpha) / (stats[1] + reg_lambda))

    rows = d0.mapInArrow(code, stored).checkpoint(eager=True)
    trees: list[dict] = []
    written = 0
    for t in range(int(n_estimators)):
        if len(trees) - written >= WRITE_EVERY:
            rows = rows.mapInArrow(add(trees[written:]), stored).checkpoint(eager=True)
            written = len(trees)
        cur = rows if subsample >= 1.0 else rows.where(hash_uniform(f"{seed}:{t}", "row_id") < F.lit(float(subsample)))
        tree = {"splits": {}, "leaves": {}, "gains": {}}
        stats = {}
        nodes = [0]
        for level in range(max_depth):
            best: dict = {}
            block = max(1, TR.MOST_CELLS // (len(nodes) * n_bins * 2))
            for first in range(0, len(cuts), block):
                some = range(first, min(len(cuts), first + block))
                for (_, node), s in TR.best_splits(cur, _histograms(tree, nodes, some, n_bins, trees[written:], max_depth, level),
                                                   n_bins, 2, gain).items():
                    if node not in best or s[0] > best[node][0]:
                        best[node] = s
            nodes = []
            for node, (found, feature, at, left, total) in best.items():
                stats.setdefault(node, total)
                if not found > 0:
                    continue
                tree["splits"][node] = (int(feature), int(at))
                tree["gains"][node] = float(found) + gamma
                for child, s in zip(TR.children(node), (left, total - left)):
                    stats[child] = s
                    nodes.append(child)
            if not nodes:
                break
        tree["leaves"] = {node: leaf(s) for node, s in stats.items() if node not in tree["splits"]}
        trees.append(tree)
    return FittedModel("xgboost", BoostedTrees(cuts, trees, base, max_depth), {"n_estimators": n_estimators, "max_depth": max_depth})


def _histograms(tree, nodes, features, n_bins, newer, depth, level):
    """Sums of g and h per (open node, feature, bin) of a task's rows."""
    feature, cut = TR.as_arrays([tree], level)
    slots = np.full(2 ** (level + 1) - 1, -1, np.int64)
    slots[nodes] = np.arange(len(nodes))
    width, first = len(features), features.start

    def run(batches):
        g_cells = np.zeros(len(nodes) * width * n_bins)
        h_cells = np.zeros_like(g_cells)
        for b in batches:
            if not b.num_rows:
                continue
            codes = TR.byte_matrix(b.column(2))
            p = 1.0 / (1.0 + np.exp(-_margins(codes, np.asarray(b.column(3)), newer, depth)))
            at = slots[TR.route(codes, feature[0], cut[0], level)]
            mine = np.flatnonzero(at >= 0)
            if not len(mine):
                continue
            g, h = (p - np.asarray(b.column(1)))[mine], (p * (1.0 - p))[mine]
            where = ((at[mine, None] * width + np.arange(width)) * n_bins + codes[mine, first:first + width]).ravel()
            g_cells += np.bincount(where, weights=np.repeat(g, width), minlength=len(g_cells))
            h_cells += np.bincount(where, weights=np.repeat(h, width), minlength=len(h_cells))
        cells = np.stack([g_cells, h_cells], axis=-1).reshape(len(nodes) * width, n_bins * 2)
        used = np.flatnonzero(cells.any(axis=1))
        if len(used):
            yield np.zeros(len(used), np.int64), np.array(nodes)[used // width], used % width + first, cells[used]
    return run


def split_gain_importance(model: BoostedTrees, n_features: int) -> list[float]:
    """Mean loss reduction of a feature's splits, normalised to one."""
    gain, count = np.zeros(n_features), np.zeros(n_features)
    for t in model.trees:
        for node, (f, _) in t["splits"].items():
            gain[f] += t["gains"][node]
            count[f] += 1
    mean = gain / np.maximum(count, 1)
    s = mean.sum()
    return [float(v) for v in (mean / s if s > 0 else mean)]
