"""Symbolic features by genetic programming, scored on Spark.

Programs are small expression trees over the feature array (add, sub, mul,
protected division: |d| < 0.001 gives 1). Every program is a Spark column;
a whole generation is scored in one aggregate pass as |corr(program, y)|.
Evolution of the (tiny) trees happens on the driver with a seeded RNG. The
result keeps the best programs and then drops the most correlated ones until
``n_components`` remain.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortml.functions import safe_corr

OPS = ("add", "sub", "mul", "div")


def _rand_tree(r: random.Random, d: int, depth: int):
    if depth == 0 or r.random() < 0.3:
        return ("x", r.randrange(d))
    return (r.choice(OPS), _rand_tree(r, d, depth - 1), _rand_tree(r, d, depth - 1))


def to_column(t, vec: str = "x") -> Column:
    if t[0] == "x":
        return F.element_at(F.col(vec), t[1] + 1)
    a, b = to_column(t[1], vec), to_column(t[2], vec)
    if t[0] == "add":
        return a + b
    if t[0] == "sub":
        return a - b
    if t[0] == "mul":
        return a * b
    return F.when(F.abs(b) > F.lit(0.001), a / b).otherwise(F.lit(1.0))


def to_text(t, names=None) -> str:
    if t[0] == "x":
        return names[t[1]] if names else f"X{t[1]}"
    return f"{t[0]}({to_text(t[1], names)}, {to_text(t[2], names)})"


def _subtrees(t, path=()):
    yield path, t
    if t[0] != "x":
        yield from _subtrees(t[1], path + (1,))
        yield from _subtrees(t[2], path + (2,))


def _replace(t, path, new):
    if not path:
        return new
    parts = list(t)
    parts[path[0]] = _replace(t[path[0]], path[1:], new)
    return tuple(parts)


def _fitness(df: DataFrame, progs, vec: str, label: str, batch: int = 100):
    out = []
    y = F.col(label).cast("double")
    for i in range(0, len(progs), batch):
        row = df.agg(*[safe_corr(to_column(p, vec), y).alias(f"c{j}") for j, p in enumerate(progs[i:i + batch])]).first()
        out += [abs(v) if v is not None and v == v else 0.0 for v in row]
    return out


class SymbolicFeatures:
    def __init__(self, programs, fitness):
        self.programs, self.fitness = programs, fitness

    def names(self) -> list[str]:
        return [to_text(p) for p in self.programs]

    def transform(self, df: DataFrame, vec: str = "x") -> DataFrame:
        return df.withColumn(vec, F.array(*[to_column(p, vec) for p in self.programs]))

    def report(self, spark, names=None) -> DataFrame:
        rows = [(i, to_text(p, names), float(f)) for i, (p, f) in enumerate(zip(self.programs, self.fitness))]
        return spark.createDataFrame(rows, "component int, expression string, fitness double")


def learn_symbolic(df: DataFrame, n_components: int = 2, population: int = 40, generations: int = 4,
                   hall_of_fame: int = 10, seed: int = 42, vec: str = "x", label: str = "label") -> SymbolicFeatures:
    d = int(df.select(F.size(vec)).first()[0])
    r = random.Random(seed)
    pop = [_rand_tree(r, d, 3) for _ in range(population)]
    fit = _fitness(df, pop, vec, label)
    for _ in range(generations):
        ranked = [p for _, p in sorted(zip(fit, range(len(pop))), key=lambda t: -t[0])]
        parents = [pop[i] for i in ranked[: max(2, population // 2)]]
        children = []
        while len(children) < population - len(parents):
            a, b = r.choice(parents), r.choice(parents)
            pa, _ = r.choice(list(_subtrees(a)))
            _, sb = r.choice(list(_subtrees(b)))
            child = _replace(a, pa, sb) if r.random() < 0.7 else _replace(a, pa, _rand_tree(r, d, 2))
            children.append(child)
        pop = parents + children
        fit = _fitness(df, pop, vec, label)
    order = sorted(range(len(pop)), key=lambda i: -fit[i])
    hof, seen = [], set()
    for i in order:
        key = to_text(pop[i])
        if key not in seen:
            seen.add(key)
            hof.append(i)
        if len(hof) == hall_of_fame:
            break
    # pairwise correlation among the hall of fame, one aggregate pass
    cols = [to_column(pop[i], vec) for i in hof]
    pairs = [(a, b) for a in range(len(hof)) for b in range(a + 1, len(hof))]
    corr = np.eye(len(hof))
    if pairs:
        row = df.agg(*[safe_corr(cols[a], cols[b]).alias(f"p{k}") for k, (a, b) in enumerate(pairs)]).first()
        for k, (a, b) in enumerate(pairs):
            v = row[k]
            corr[a, b] = corr[b, a] = abs(v) if v is not None and v == v else 0.0
    keep = list(range(len(hof)))
    while len(keep) > n_components:
        sub = corr[np.ix_(keep, keep)] - np.eye(len(keep))
        a, b = np.unravel_index(np.argmax(sub), sub.shape)
        worst = keep[a] if fit[hof[keep[a]]] < fit[hof[keep[b]]] else keep[b]
        keep.remove(worst)
    chosen = [hof[i] for i in keep]
    return SymbolicFeatures([pop[i] for i in chosen], [fit[i] for i in chosen])
