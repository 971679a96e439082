"""Projections: PCA of centred data, landmark kernel PCA, loadings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortml.functions.arrays import fold_sum, list_matrix
from cohortml.functions.hashing import hash_int


class PCAProjection:
    """Centre with the training means, project on ``k`` components.

    Spark's ``PCA`` projects rows as given, so rows are centred first. The
    sign of each component is fixed so that its largest-magnitude loading is
    positive (NumPy-style SVD signs are arbitrary).
    """

    def __init__(self, mean, model, signs):
        self.mean, self.model, self.signs = mean, model, signs

    def names(self) -> list[str]:
        return [f"PC{j + 1}" for j in range(len(self.signs))]

    def _centre(self, d: DataFrame, vec: str = "x") -> DataFrame:
        m = F.array(*[F.lit(float(v)) for v in self.mean])
        return d.withColumn(vec, F.transform(vec, lambda v, i: v - F.element_at(m, i + 1)))

    def transform(self, d: DataFrame, vec: str = "x") -> DataFrame:
        c = self._centre(d, vec).withColumn("_f", array_to_vector(vec))
        out = self.model.setInputCol("_f").setOutputCol("_p").transform(c)
        s = F.array(*[F.lit(float(v)) for v in self.signs])
        proj = F.transform(vector_to_array("_p"), lambda v, i: v * F.element_at(s, i + 1))
        return out.withColumn(vec, proj).drop("_f", "_p")

    def loadings(self, spark, names=None) -> DataFrame:
        pc = self.model.pc.toArray() * np.array(self.signs)[None, :]
        rows = [(f"PC{j + 1}", str(names[i] if names else i), float(pc[i, j]))
                for j in range(pc.shape[1]) for i in range(pc.shape[0])]
        return spark.createDataFrame(rows, "component string, feature string, loading double")


KERNELS = ("linear", "rbf", "poly", "sigmoid", "cosine")


def kernel_matrix(a: np.ndarray, b: np.ndarray, kernel: str, gamma: float, degree: float = 3.0, coef0: float = 1.0) -> np.ndarray:
    """Kernel values of the rows of ``a`` and ``b``."""
    if kernel == "cosine":
        def unit(x):
            n = np.linalg.norm(x, axis=1, keepdims=True)
            return x / np.where(n > 0, n, 1.0)
        return unit(a) @ unit(b).T
    dot = a @ b.T
    if kernel == "linear":
        return dot
    if kernel == "poly":
        return (gamma * dot + coef0) ** degree
    if kernel == "sigmoid":
        return np.tanh(gamma * dot + coef0)
    return np.exp(-gamma * np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2.0 * dot, 0.0))


class KernelProjection:
    """Kernel PCA through landmarks: coordinates ``(K(x, landmarks) - mean) W`` of the leading components."""

    def __init__(self, landmarks, weights, mean, kernel: str, options: dict):
        self.landmarks, self.weights, self.mean = np.asarray(landmarks), np.asarray(weights), np.asarray(mean)
        self.kernel, self.options = kernel, dict(options)

    def names(self) -> list[str]:
        return [f"Dimension{j + 1}" for j in range(self.weights.shape[1])]

    def transform(self, d: DataFrame, vec: str = "x") -> DataFrame:
        landmarks, weights, mean, kernel, options = self.landmarks, self.weights, self.mean, self.kernel, self.options

        @F.pandas_udf("array<double>")
        def project(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list((kernel_matrix(np.stack(x.to_list()).astype(np.float64), landmarks, kernel, **options) - mean) @ weights))

        return d.withColumn(vec, project(vec))

    def loadings(self, spark, names=None) -> DataFrame:
        """The weight of each landmark in each component (kernel components have no feature loadings)."""
        rows = [(n, f"landmark_{i}", float(v)) for j, n in enumerate(self.names()) for i, v in enumerate(self.weights[:, j])]
        return spark.createDataFrame(rows, "component string, feature string, loading double")


def fit_kernel_pca(d: DataFrame, k: int, kernel: str = "rbf", n_landmarks: int = 512, seed: int = 42, vec: str = "x", key: str = "row_id",
                   gamma: float | None = None, degree: float = 3.0, coef0: float = 1.0) -> KernelProjection:
    """Kernel PCA of all rows in the span of ``n_landmarks`` rows (the first ones in hash order).

    With ``K`` the kernel of the landmarks and ``K = U L U^T``, a row's features are ``L^-1/2 U^T k(x)``; their
    inner products are the kernel's best approximation from the landmarks, and the kernel itself if every
    row is a landmark. Mean and covariance of the features are sums over all rows (this is the double
    centring of the kernel), so one pass with arrays of ``n_landmarks^2`` and a small eigenproblem give the components.
    ``gamma`` defaults to one over the number of features. Directions of ``K`` below rounding are left out, and
    the largest landmark weight of each component is positive.
    """
    if kernel not in KERNELS:
        raise ValueError(f"unknown kernel {kernel!r}")
    chosen = [r[vec] for r in d.select(key, vec).orderBy(hash_int(seed, key), F.col(key)).limit(int(n_landmarks)).collect()]
    if not chosen:
        raise ValueError("no rows to fit on")
    landmarks = np.array(chosen, np.float64).reshape(len(chosen), -1)
    options = {"gamma": float(gamma) if gamma is not None else 1.0 / max(landmarks.shape[1], 1), "degree": float(degree), "coef0": float(coef0)}
    values, vectors = np.linalg.eigh(kernel_matrix(landmarks, landmarks, kernel, **options))
    sound = values > max(values[-1], 0.0) * len(values) * np.finfo(float).eps * 16
    to_features = vectors[:, sound] / np.sqrt(values[sound])
    m = to_features.shape[1]

    def part(batch):
        f = kernel_matrix(list_matrix(batch.column(0)), landmarks, kernel, **options) @ to_features
        return np.concatenate([[len(f)], f.sum(axis=0), (f.T @ f).ravel()])

    total = fold_sum(d.select(vec), part)
    mean = total[1:m + 1] / total[0]
    spread, turn = np.linalg.eigh(total[m + 1:].reshape(m, m) / total[0] - np.outer(mean, mean))
    turn = turn[:, ::-1][:, :min(int(k), m)]
    weights = to_features @ turn
    weights = weights * np.where(weights[np.abs(weights).argmax(axis=0), np.arange(weights.shape[1])] < 0, -1.0, 1.0)
    # the mean feature, as the kernel values it stands for: (k(x) - centre) W is the centred projection
    centre = np.linalg.lstsq(to_features.T, mean, rcond=None)[0]
    return KernelProjection(landmarks, weights, centre, kernel, options)


def fit_pca(d: DataFrame, k: int, kernel: str = "pca", vec: str = "x", seed: int = 42, kpca_kernel: str = "linear", **options):
    """``kernel``: ``pca``, or ``kpca`` with ``kpca_kernel`` (its coordinates with ``linear`` are those of PCA) and
    the options of :func:`fit_kernel_pca`."""
    if kernel == "kpca":
        return fit_kernel_pca(d, k, kpca_kernel, seed=seed, vec=vec, **options)
    if kernel != "pca" or options:
        raise ValueError(f"unknown learner {kernel!r} or options {sorted(options)}")
    stats = (d.select(F.posexplode(vec).alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"))
             .collect())  # one row per feature
    mean = np.zeros(len(stats))
    for r in stats:
        mean[r["i"]] = r["m"]
    m = F.array(*[F.lit(float(v)) for v in mean])
    c = d.select(array_to_vector(F.transform(vec, lambda v, i: v - F.element_at(m, i + 1))).alias("_f"))
    k = int(min(k, len(mean)))
    model = PCA(k=k, inputCol="_f", outputCol="_p").fit(c)
    pc = model.pc.toArray()
    signs = [1.0 if pc[np.argmax(np.abs(pc[:, j])), j] >= 0 else -1.0 for j in range(k)]
    return PCAProjection(mean, model, signs)
