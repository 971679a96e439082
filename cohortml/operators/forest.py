"""Random forests on class-balanced bootstraps, and extremely randomised trees.

All trees of a forest grow together, a level per pass (see :mod:`cohortml.operators.trees`). The number of times a
row is drawn into a tree is a Poisson variate of a hash of (seed, tree, row), with the mean that gives each class
the same expected number of draws; so a row needs no other row to know its draws, and a recomputed task draws the
same. On top, classes weigh the same in every tree: weights are draws times ``n / (classes * n_class)`` of the tree.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortml.operators import trees as TR

N_BINS = 32
#: Smallest gain that counts as one.
LEAST_GAIN = 1e-12


def uniform(key: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit keys and salts (a chain of the splitmix64 finaliser)."""
    z = np.asarray(key).astype(np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        for s in salt:
            z = z ^ np.uint64((int(s) + 0x9E3779B97F4A7C15) % (1 << 64))
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def poisson_table(mean: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2, ... until they are one to rounding."""
    p, total, out = math.exp(-mean), 0.0, []
    k = 0
    while total < 1.0 - 1e-15 and k < 200:
        total += p
        out.append(total)
        k += 1
        p *= mean / k
    return np.array(out[:-1])


def draws(key: np.ndarray, label: np.ndarray, tree: int, tables: list | None, seed: int) -> np.ndarray:
    """How often each row is drawn into ``tree``; once each without ``tables`` (one per class)."""
    if tables is None:
        return np.ones(len(key), np.int64)
    u = uniform(key, seed, tree)
    out = np.zeros(len(key), np.int64)
    for c, table in enumerate(tables):
        mine = label == c
        out[mine] = np.searchsorted(table, u[mine], side="right")
    return out


def subset(n_features: int, k: int, seed: int, tree: int, node: int) -> np.ndarray:
    """The ``k`` features that a node looks at, in rising order."""
    return np.sort(np.random.default_rng([seed, tree, node]).choice(n_features, k, replace=False))


def gini_gain(left, total, weight, least_leaf):
    """Decrease of weighted Gini impurity per cut; ``left`` and ``total`` hold draws per class."""
    right = total - left
    n_left, n_right = left.sum(axis=-1), right.sum(axis=-1)
    wl, wr = left * weight, right * weight
    sl, sr = wl.sum(axis=-1), wr.sum(axis=-1)
    s = sl + sr
    w = wl + wr
    # a node's weight times its impurity is s - sum(w^2) / s
    gain = (wl ** 2).sum(axis=-1) / sl + (wr ** 2).sum(axis=-1) / sr - (w ** 2).sum(axis=-1) / s
    return np.where((n_left >= least_leaf) & (n_right >= least_leaf), gain, -np.inf)


class Forest:
    """Trees with real thresholds; a leaf holds the class weights of its rows."""

    def __init__(self, trees: list[dict], depth: int, n_classes: int):
        self.trees, self.depth, self.n_classes = trees, int(depth), int(n_classes)

    def importances(self, n_features: int) -> list[float]:
        """Impurity decreases per feature, normalised per tree, averaged over trees."""
        out = np.zeros(n_features)
        for t in self.trees:
            one = np.zeros(n_features)
            for node, (f, _) in t["splits"].items():
                one[f] += t["gains"][node]
            out += one / one.sum() if one.sum() > 0 else one
        s = out.sum()
        return [float(v) for v in (out / s if s > 0 else out)]

    def predict(self, df: DataFrame, vec: str = "x", key: str = "row_id", label: str = "label") -> DataFrame:
        """Mean over the trees of the share of class 1 in the row's leaf."""
        feature, cut = TR.as_arrays(self.trees, self.depth)
        share = np.zeros(feature.shape)
        for t, tree in enumerate(self.trees):
            for node, w in tree["leaves"].items():
                share[t, node] = w[1] / sum(w) if len(w) > 1 and sum(w) else 0.0
        depth = self.depth
        d = df.select(key, label, vec)
        schema = T.StructType([d.schema[key], d.schema[label], T.StructField("prob", T.DoubleType())])

        def run(batches):
            import pyarrow as pa
            for b in batches:
                if not b.num_rows:
                    continue
                x = TR.list_matrix(b.column(2))
                p = np.zeros(len(x))
                for f, c, s in zip(feature, cut, share):
                    p += s[TR.route(x, f, c, depth)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p / max(len(feature), 1))], names=[key, label, "prob"])

        return d.mapInArrow(run, schema).withColumn("pred", (F.col("prob") > 0.5).cast("int"))


def grow_forest(df: DataFrame, n_estimators: int = 100, max_depth: int = 4, min_samples_split: int = 2, min_samples_leaf: int = 1,
                max_samples: float = 1.0, bootstrap: bool = True, random_cuts: bool = False, n_bins: int = N_BINS,
                max_features: int | None = None, seed: int = 42) -> Forest:
    """A forest on ``(row_id, x, label)``; ``max_features`` defaults to the root of the number of features.

    With ``bootstrap``, a tree draws ``max_samples`` times the size of the smallest class from every
    class, with replacement. With ``random_cuts`` a node looks at one uniform cut between the least and the
    largest value of its rows per feature, else at the cuts of ``n_bins`` quantile bins. A node that finds no cut among
    its features is a leaf. Rows with the same ``row_id`` are drawn alike; a table with one class gives one leaf per tree.
    """
    spark = df.sparkSession
    d = df.select(F.xxhash64("row_id").alias("key"), "x", F.col("label").cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in d.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        raise ValueError("no rows to grow a forest on")
    k = max(max(sizes) + 1, 2)
    tables = None
    if bootstrap:
        drawn = max_samples * min(sizes.values())
        tables = [poisson_table(drawn / sizes[c]) if c in sizes else np.array([1.0]) for c in range(k)]
    if random_cuts:
        rows, cuts = d.checkpoint(eager=True), None
        n_features = len(rows.select("x").first()["x"])
    else:
        d = d.checkpoint(eager=True)
        cuts = TR.quantile_cuts(d, "x", n_bins)
        n_features = len(cuts)
        coded = T.StructType([d.schema["key"], T.StructField("codes", T.BinaryType()), d.schema["label"]])

        def code(batches):
            import pyarrow as pa
            for b in batches:
                if b.num_rows:
                    codes = TR.binned(TR.list_matrix(b.column(1)), cuts)
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.tobytes() for c in codes], pa.binary()), b.column(2)], names=coded.names)

        rows = d.mapInArrow(code, coded).checkpoint(eager=True)
    looked = min(n_features, max_features or max(1, math.isqrt(n_features)))
    bins = 2 if random_cuts else n_bins
    grown = [{"splits": {}, "leaves": {}, "gains": {}, "_codes": {}} for _ in range(int(n_estimators))]
    totals: dict = {}  # (tree, node) -> draws per class
    weights: dict = {}  # tree -> weight of a draw per class
    open_nodes = [(t, 0) for t in range(int(n_estimators))]
    for level in range(int(max_depth)):
        # whole trees together, so that a row is routed once per tree and pass
        groups, cells = [[]], 0
        for tree in sorted({t for t, _ in open_nodes}):
            nodes = [n for t, n in open_nodes if t == tree]
            if groups[-1] and cells + len(nodes) * looked * bins * k > TR.MOST_CELLS:
                groups.append([])
                cells = 0
            groups[-1].append((tree, nodes))
            cells += len(nodes) * looked * bins * k
        next_nodes = []
        for group in groups:
            if not group:
                continue
            found, chosen = _level(rows, group, grown, tables, weights, level, looked, n_features, bins, k, min_samples_leaf, random_cuts, seed)
            for tree, nodes in group:
                for node in nodes:
                    gain, feature, at, left, total = found.get((tree, node), (-np.inf, -1, 0, np.zeros(k), np.zeros(k)))
                    if node == 0:
                        weights[tree] = _class_weights(total)
                        totals[tree, 0] = total
                    if total.sum() < min_samples_split or not gain > LEAST_GAIN:
                        continue
                    cut = chosen[tree, node][feature] if random_cuts else cuts[feature][at]
                    grown[tree]["splits"][node] = (int(feature), float(cut))
                    grown[tree]["_codes"][node] = (int(feature), float(cut) if random_cuts else int(at))
                    grown[tree]["gains"][node] = float(gain)
                    for child, stats in zip(TR.children(node), (left, total - left)):
                        totals[tree, child] = stats
                        if level + 1 < max_depth and (stats > 0).sum() > 1:
                            next_nodes.append((tree, child))
        open_nodes = next_nodes
    for (tree, node), stats in totals.items():
        if node not in grown[tree]["splits"]:
            grown[tree]["leaves"][node] = [float(v) for v in stats * weights[tree]]
    for t in grown:
        del t["_codes"]
    return Forest(grown, max_depth, k)


def _class_weights(total: np.ndarray) -> np.ndarray:
    """Balanced weights ``n / (classes * n_class)`` from draws per class (the last axis)."""
    present = total > 0
    n = total.sum(axis=-1, keepdims=True)
    return np.where(present, n / (np.maximum(present.sum(axis=-1, keepdims=True), 1) * np.maximum(total, 1e-300)), 0.0)


def _level(rows, group, grown, tables, weights, level, looked, n_features, bins, k, least_leaf, random_cuts, seed):
    """Best splits of the open nodes of some trees, and their random cuts ``{(tree, node): {feature: cut}}``."""
    order = [(t, n) for t, nodes in group for n in nodes]
    slot = {tn: i for i, tn in enumerate(order)}
    features = np.stack([subset(n_features, looked, seed, t, n) for t, n in order])
    split_feature, split_cut = TR.as_arrays([{"splits": grown[t]["_codes"]} for t, _ in group], level)
    size = 2 ** (level + 1) - 1
    slots = np.full((len(group), size), -1, np.int64)
    for g, (t, nodes) in enumerate(group):
        for n in nodes:
            slots[g, n] = slot[t, n]
    ids = [t for t, _ in group]

    def placed(batches):
        """Per batch and tree: ``(slots, values, labels, draws)`` of the rows that are in an open node."""
        for b in batches:
            if not b.num_rows:
                continue
            key, label = np.asarray(b.column(0)), np.asarray(b.column(2))
            x = TR.list_matrix(b.column(1)) if random_cuts else TR.byte_matrix(b.column(1))
            for g, t in enumerate(ids):
                times = draws(key, label, t, tables, seed)
                at = slots[g, TR.route(x, split_feature[g], split_cut[g], level)]
                mine = np.flatnonzero((times > 0) & (at >= 0))
                if len(mine):
                    yield at[mine], x[mine], label[mine], times[mine]

    flat = ([t for t, _ in order for _ in range(looked)], [n for _, n in order for _ in range(looked)], features.ravel().tolist())
    chosen = {}
    cut_at = None
    if random_cuts:
        def ends(batches):
            import pyarrow as pa
            low, high = np.full(features.shape, np.inf), np.full(features.shape, -np.inf)
            for at, x, _, _ in placed(batches):
                v = np.take_along_axis(x, features[at], axis=1)
                np.minimum.at(low, at, v)
                np.maximum.at(high, at, v)
            seen = np.flatnonzero(low.ravel() <= high.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(low.ravel()[seen]), pa.array(high.ravel()[seen])],
                                             names=["place", "low", "high"])

        low, high = np.zeros(features.size), np.zeros(features.size)
        for r in (rows.mapInArrow(ends, "place int, low double, high double").groupBy("place")
                  .agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()):
            low[r["place"]], high[r["place"]] = r["low"], r["high"]
        u = np.concatenate([uniform(f, seed, t, n, 1) for (t, n), f in zip(order, features)])
        cut_at = (low + u * (high - low)).reshape(features.shape)
        cut_at = np.where(cut_at >= high.reshape(features.shape), low.reshape(features.shape), cut_at)
        chosen = {tn: dict(zip(f.tolist(), c.tolist())) for tn, f, c in zip(order, features, cut_at)}

    def histograms(batches):
        cells = np.zeros(len(order) * looked * bins * k, np.int64)
        spread = np.arange(looked)
        for at, x, label, times in placed(batches):
            v = np.take_along_axis(x, features[at], axis=1)
            code = (v > cut_at[at]).astype(np.int64) if random_cuts else v.astype(np.int64)
            where = (((at[:, None] * looked + spread) * bins + code) * k + label[:, None]).ravel()
            cells += np.bincount(where, weights=np.repeat(times, looked), minlength=len(cells)).astype(np.int64)
        shaped = cells.reshape(len(order) * looked, bins * k)
        used = np.flatnonzero(shaped.any(axis=1))
        if len(used):
            yield np.array(flat[0])[used], np.array(flat[1])[used], np.array(flat[2])[used], shaped[used]

    known = None if level == 0 else np.array([weights[t] for t in ids])
    place = {t: i for i, t in enumerate(ids)}

    def gain(left, total, tree):
        # at the root the weights follow from the totals, deeper they are the tree's
        weight = _class_weights(total) if known is None else known[[place[t] for t in tree.tolist()]][:, None, :]
        return gini_gain(left, total, weight, least_leaf)

    return TR.best_splits(rows, histograms, bins, k, gain), chosen
