"""HSIC Lasso feature selection in block form (Yamada 2014; block HSIC Lasso, Climente-Gonzalez 2019).

minimise 1/2 || L - sum_k a_k K_k ||_F^2 + lam sum_k a_k,  a >= 0,

with K_k a Gaussian kernel (sigma = 1) on the z-scored feature k and L a
delta kernel on the class (``1/n_c`` for a pair in class c) or a Gaussian
kernel on the z-scored target; every kernel is centred and scaled to unit
Frobenius norm. Rows are dealt into blocks of ``B`` rows by a hashed order
(``M`` independent orders); every row is in exactly one block of each order. A
grouped pandas function sums the ``d x d`` Gram contributions and the ``d``
kernel-target products of up to 64 blocks; Spark sums the groups. The driver
holds the ``d x d`` matrix, whose size is the width and not the rows. The small
nonnegative lasso path runs on the driver until ``num_feat`` features are
active; importance = a / a of the first feature to enter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortml.functions.hashing import hash_int
from cohortml.functions.ordered import row_numbers

#: Kernel values of one block (features x rows x rows) that ``B=0`` aims at: 128 MB of doubles.
BLOCK_VALUES = 16_000_000
#: Blocks whose Gram matrices are summed inside one task.
BLOCKS_PER_GROUP = 64


def _centre_norm(K: np.ndarray) -> np.ndarray:
    """H K H / ||H K H||_F for a stack of kernels (k, B, B)."""
    Kc = K - K.mean(axis=1, keepdims=True) - K.mean(axis=2, keepdims=True) + K.mean(axis=(1, 2), keepdims=True)
    nrm = np.sqrt((Kc * Kc).sum(axis=(1, 2)))
    return Kc / np.where(nrm > 0, nrm, 1.0)[:, None, None]


def _block_stats(mode: str, d: int):
    """Sum over the blocks of one group: a row per feature, with its Gram row and its target product."""
    def one(x, y):
        K = np.exp(-((x[:, :, None] - x[:, None, :]) ** 2) / 2.0)
        Kn = _centre_norm(K).reshape(d, -1)
        if mode == "classification":
            same = y[:, None] == y[None, :]
            L = same / same.sum(axis=1)[:, None]
        else:
            L = np.exp(-((y[:, None] - y[None, :]) ** 2) / 2.0)
        Ln = _centre_norm(L[None, :, :]).reshape(-1)
        return np.column_stack([Kn @ Kn.T, Kn @ Ln])

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((d, d + 1))
        for _, block in pdf.groupby("_b"):
            total += one(np.array(block["x"].tolist(), dtype=float).reshape(len(block), d).T, block["y"].to_numpy())
        return pd.DataFrame({"i": np.arange(d, dtype="int32"), "s": list(total)})
    return fn


def nonneg_lasso_path(Q: np.ndarray, b: np.ndarray, num_feat: int, steps: int = 200, sweeps: int = 200):
    """Decrease lambda from max(b) and solve 1/2 a'Qa - b'a + lam sum(a), a >= 0, by
    coordinate descent with warm starts; stop when ``num_feat`` features are active.
    Returns (coefficients, features in order of entry)."""
    d = len(b)
    a = np.zeros(d)
    order: list[int] = []
    lam_max = float(np.max(b)) if d else 0.0
    if lam_max <= 0:
        return a, order
    diag = np.where(np.diag(Q) > 0, np.diag(Q), 1.0)
    for lam in lam_max * np.logspace(0, -4, steps):
        for _ in range(sweeps):
            prev = a.copy()
            # only coordinates that are positive or would become so can move
            for k in np.flatnonzero((a > 0) | (b - lam - Q @ a > 0)):
                r = b[k] - lam - (Q[k] @ a - Q[k, k] * a[k])
                a[k] = max(0.0, r / diag[k])
            if np.max(np.abs(a - prev)) < 1e-12:
                break
        for k in np.argsort(-a):
            if a[k] > 0 and k not in order:
                order.append(int(k))
        if len([k for k in order if a[k] > 0]) >= num_feat:
            break
    return a, order


def hsic_importances(df: DataFrame, num_feat: int = 20, B: int = 20, M: int = 1, mode: str = "classification",
                     seed: int = 42, vec: str = "x", label: str = "label") -> list[float]:
    if int(num_feat) != num_feat or num_feat <= 0:
        raise ValueError("HSIC selection needs an integer number of features")
    d = int(df.select(F.size(vec)).first()[0])
    stats = (df.select(F.posexplode(vec).alias("i", "v")).groupBy("i")
             .agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect())  # one row per feature
    mean, sd = np.zeros(d), np.ones(d)
    for r in stats:
        mean[r["i"]], sd[r["i"]] = r["m"], (r["s"] or 1.0)
    mu = F.array(*[F.lit(float(v)) for v in mean])
    sg = F.array(*[F.lit(float(v)) for v in sd])
    z = df.select("row_id", F.transform(vec, lambda v, i: (v - F.element_at(mu, i + 1)) / F.element_at(sg, i + 1))
                  .alias("x"), F.col(label).alias("y"))
    if mode != "classification":
        ys = z.agg(F.avg("y").alias("m"), F.stddev_pop("y").alias("s")).first()
        z = z.withColumn("y", (F.col("y") - F.lit(ys["m"])) / F.lit(ys["s"] or 1.0))
    n = z.count()
    if B == 0:  # the default of the method: one block, or blocks whose kernels stay near BLOCK_VALUES
        B, M = max(20, int((BLOCK_VALUES / max(d, 1)) ** 0.5)), 1
    n_blocks = max(1, -(-n // int(B)))
    parts = []
    for m in range(int(M)):
        pos = row_numbers(z.withColumn("_h", hash_int(f"{seed}:{m}", "row_id")), [], ["_h", "row_id"], "_p")
        # blocks of at most B rows whose sizes differ by one at most: every row is in one of them
        blocks = pos.withColumn("_b", F.floor((F.col("_p") - 1) * F.lit(n_blocks) / F.lit(n)).cast("long"))
        parts.append(blocks.withColumn("_m", F.lit(m)).select("_m", "_b", "x", "y"))
    allb = parts[0]
    for p in parts[1:]:
        allb = allb.unionByName(p)
    grouped = allb.withColumn("_g", F.floor(F.col("_b") / F.lit(BLOCKS_PER_GROUP)))
    per_group = grouped.groupBy("_m", "_g").applyInPandas(_block_stats(mode, d), "i int, s array<double>")
    rows = (per_group.groupBy("i").agg(Summarizer.sum(array_to_vector("s")).alias("t")).collect())  # one row per feature
    total = np.zeros((d, d + 1))
    for r in rows:
        total[r["i"]] = r["t"].toArray()
    Q, b = total[:, :d], total[:, d]
    a, order = nonneg_lasso_path(Q, b, int(num_feat))
    chosen = [k for k in order if a[k] > 0][: int(num_feat)]
    imp = np.zeros(d)
    if chosen:
        first = a[chosen[0]]
        for k in chosen:
            imp[k] = a[k] / first
    return [float(v) for v in imp]


def hsic_select(df: DataFrame, num_feat: int = 20, **kw) -> list[int]:
    imp = hsic_importances(df, num_feat, **kw)
    return [i for i, v in enumerate(imp) if v > 0]
