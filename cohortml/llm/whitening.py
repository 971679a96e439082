"""Whitening by the leading eigenvectors of the covariance, found with a block Jacobi-Davidson method.

The covariance is never formed. Its product with a block of vectors is one pass over the table: a
task centres its rows (by the exact mean, before anything is multiplied) and adds up
``centred^T (centred block)``. Only arrays of the size of the block come back, so the driver's work
and memory depend on the length of the vectors and the number of components, not on the rows.

Rayleigh-Ritz on the subspace gives approximate pairs. Leading pairs whose residual has reached
double precision are locked. For each of the others the correction equation, projected off the locked
pairs and the pair itself, is solved roughly by MINRES; all equations advance side by side, so that one
inner step is one pass for all of them. The corrections extend the subspace, which is thinned to the
best Ritz vectors when it has grown too wide.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, StructField, StructType

from cohortml.llm.common import scratch_path, stored
from cohortml.llm.vectors import fold, integer_vectors, lists, matrix

INNER_STEPS = 8
MOST_ROUNDS = 60


# ---------------------------------------------------------------- eigenpairs
def minres(apply, rhs, steps: int):
    """``steps`` steps of MINRES for every column of ``rhs`` at once; ``apply`` maps a block to a block."""
    import numpy as np

    def norm(a):
        return np.sqrt((a * a).sum(axis=0))

    def over(a, b):
        return np.divide(a, b, out=np.zeros_like(a), where=b > 0)

    beta = norm(rhs)
    small = 1e-14 * beta
    v, v_old = over(rhs, np.broadcast_to(beta, rhs.shape)), np.zeros_like(rhs)
    w, w_old, x = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    c, c_old, s, s_old = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    eta, alive = beta.copy(), beta > 0
    for _ in range(steps):
        if not alive.any():
            break
        a = apply(v)
        alpha = (v * a).sum(axis=0)
        a = a - alpha * v - beta * v_old
        beta_new = norm(a)
        delta = c * alpha - c_old * s * beta
        rho1 = np.hypot(delta, beta_new)
        rho2 = s * alpha + c_old * c * beta
        rho3 = s_old * beta
        alive &= rho1 > small
        w_new = np.where(alive, over(v - rho3 * w_old - rho2 * w, np.broadcast_to(rho1, v.shape)), 0.0)
        c_old, s_old, c, s = c, s, over(delta, rho1), over(beta_new, rho1)
        x = x + c * eta * w_new
        eta = -s * eta
        w_old, w = w, w_new
        alive &= beta_new > small
        v_old, v = v, np.where(alive, over(a, np.broadcast_to(beta_new, a.shape)), 0.0)
        beta = beta_new
    return x


def orthonormal(block, basis, most: int):
    """Up to ``most`` orthonormal columns that span ``block`` beside ``basis``."""
    import numpy as np
    size = np.linalg.norm(block, axis=0)
    block = block[:, size > 0] / size[size > 0]
    keep = []
    for j in range(block.shape[1]):
        t = block[:, j]
        for _ in range(3):
            for q in ([basis] if basis.shape[1] else []) + ([np.stack(keep, axis=1)] if keep else []):
                t = t - q @ (q.T @ t)
            length = np.linalg.norm(t)
            if length < 1e-10:
                break
            t = t / length
        else:
            keep.append(t)
        if len(keep) == most:
            break
    return np.stack(keep, axis=1) if keep else np.zeros((basis.shape[0], 0))


def leading_pairs(product, d: int, wanted: int, seed: int = 0, steps: int = INNER_STEPS, tolerance: float | None = None):
    """``(values, vectors)``: the ``wanted`` largest eigenpairs of the symmetric positive ``product`` on ``d`` entries.

    ``product`` maps a ``d x m`` block to a block. Every residual is at most ``tolerance`` times the
    largest value (default: 64 sqrt(d) units of double rounding). Raises if that is not reached.
    """
    import numpy as np
    tolerance = 64 * math.sqrt(d) * np.finfo(float).eps if tolerance is None else tolerance
    rng = np.random.default_rng(seed)
    widest = min(d, 4 * wanted + 8)
    basis = orthonormal(rng.standard_normal((d, min(d, wanted + 8))), np.zeros((d, 0)), min(d, wanted + 8))
    image = product(basis)
    for _ in range(MOST_ROUNDS):
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        theta, u = values[:wanted], basis @ turn[:, :wanted]
        rest = image @ turn[:, :wanted] - u * theta
        size = np.linalg.norm(rest, axis=0)
        bad = np.flatnonzero(size > tolerance * max(theta[0], 0.0))
        if not len(bad):
            return theta, u
        locked = bad[0]
        if basis.shape[1] == d:
            # a whole basis: what is left is rounding in the images, so they are taken anew along the Ritz vectors
            basis = np.linalg.qr(basis @ turn)[0]
            image = product(basis)
            continue
        free = min(d, widest) - basis.shape[1]
        if free < len(bad) and widest < d:
            keep = min(basis.shape[1], 2 * wanted)
            basis, image = basis @ turn[:, :keep], image @ turn[:, :keep]
            free = widest - keep
        own, shift = u[:, bad], theta[bad]
        lock = u[:, :locked]

        def project(t):
            t = t - lock @ (lock.T @ t)
            return t - own * (own * t).sum(axis=0)

        def corrected(t):
            t = project(t)
            return project(product(t) - t * shift)

        more = orthonormal(minres(corrected, -project(rest[:, bad]), steps), basis, free)
        if not more.shape[1]:
            more = orthonormal(rng.standard_normal((d, 1)), basis, 1)
        basis, image = np.hstack([basis, more]), np.hstack([image, product(more)])
    raise ArithmeticError(f"residuals over {tolerance} after {MOST_ROUNDS} rounds")


# ---------------------------------------------------------------- whitening
def _centred(x, shift, rest):
    """Rows less the exact mean ``shift + rest`` (whole and fractional part), rounded once."""
    import numpy as np
    return (x - shift).astype(np.float64) - rest


def whiten(rows: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000, key: str = "vec_id",
           vector: str = "embedding", steps: int = INNER_STEPS) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` for every sound row and component.

    An entry ``c`` counts as the integer ``x = floor(scale * c) + offset``; covariances have divisor ``n``
    and are centred before multiplying. ``deviation`` (decimal) is the exact sum of ``(n x - S)^2``,
    ``whitened`` the projection of ``x - S/n`` over the root of the eigenvalue, ``explained`` the
    eigenvalue's share of the trace, ``identity_error`` the largest entry of the covariance of
    ``whitened`` less the identity, measured in a pass of its own.

    Rows whose vector is null or holds a null, infinite or NaN entry are dropped, and so are empty vectors
    and, if lengths differ, those of other than the most frequent length (the longer one of a tie). Repeated rows are rows
    of their own, a null key is an ordinary value. Components whose eigenvalue is zero to rounding are left
    out, as nothing can be divided by it; without rows or without any variance the result is empty.
    """
    import numpy as np
    spark = rows.sparkSession
    table = stored(integer_vectors(rows, key, vector, scale), scratch_path(spark, "whitening"))
    schema = StructType([StructField(key, rows.schema[key].dataType), StructField("deviation", DecimalType(38, 0)),
                         StructField("whitened", ArrayType(DoubleType()))])

    length = table.where("size(x) > 0").groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return _empty(rows, key)
    d = length["d"]
    table = table.where(F.size("x") == d)

    def moments(x):
        big = x.astype(object)
        return [len(x), *big.sum(axis=0), *(big * big).sum(axis=0)] if np.abs(x).max() >= 1 << 20 else \
            [len(x), *map(int, x.sum(axis=0)), *map(int, (x * x).sum(axis=0))]

    total = fold(table, moments, "string")
    n, sums, squares = total[0], total[1:d + 1], total[d + 1:]
    shift = np.array([round(s / n) if abs(s) < 1 << 52 else s // n for s in sums], np.int64)
    left = [s - n * int(m) for s, m in zip(sums, shift)]
    rest = np.array([r / n for r in left])
    trace = sum(n * q - s * s for q, s in zip(squares, sums)) / (n * n)
    if trace == 0:
        return _empty(rows, key)

    def product(block):
        def part(x):
            c = _centred(x, shift, rest)
            return (c.T @ (c @ block)).ravel()

        return np.array(fold(table, part)).reshape(block.shape) / n

    wanted = min(components, d)
    values, vectors = leading_pairs(product, d, wanted, steps=steps)
    sound = values > d * np.finfo(float).eps * values[0]
    values, vectors = values[sound], vectors[:, sound]
    turn = vectors / np.sqrt(values)

    def spread(x):
        w = _centred(x, shift, rest) @ turn
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    k = len(values)
    spreads = np.array(fold(table, spread)) / n
    mean = spreads[:k]
    error = float(np.abs(spreads[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())
    key_type = to_arrow_type(rows.schema[key].dataType)
    remainder = np.array(left, object)
    squared = sum(r * r for r in left)
    small = all(abs(r) < 1 << 40 for r in left)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(1))
            moved = x - shift
            w = (moved.astype(np.float64) - rest) @ turn
            # (n x - S)^2 = n^2 m^2 - 2 n m r + r^2 with m = x - shift and r = S - n shift, in whole numbers
            if small and np.abs(moved).max() < 1 << 16:
                one, two = (moved * moved).sum(axis=1).tolist(), (moved @ remainder.astype(np.int64)).tolist()
            else:
                one = [sum(e * e for e in r) for r in moved.tolist()]
                two = [sum(int(e) * f for e, f in zip(r, left)) for r in moved.tolist()]
            exact = [n * n * p - 2 * n * q + squared for p, q in zip(one, two)]
            from decimal import Decimal
            yield pa.RecordBatch.from_arrays([b.column(0).cast(key_type), pa.array(map(Decimal, exact), pa.decimal128(38, 0)),
                                              lists(w)], names=[key, "deviation", "whitened"])

    shares = F.array(*[F.lit(float(v / trace)) for v in values])
    out = table.select(key, "x").mapInArrow(run, schema).select(key, "deviation", F.posexplode("whitened").alias("place", "value"))
    return out.select(key, (F.col("place") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                      F.col("value").alias("whitened"), F.get(shares, F.col("place")).alias("explained"),
                      F.lit(error).alias("identity_error"))


def _empty(rows: DataFrame, key: str) -> DataFrame:
    return rows.sparkSession.createDataFrame([], StructType([
        StructField(key, rows.schema[key].dataType),
        *StructType.fromDDL("component int, n long, deviation decimal(38,0), whitened double, explained double, "
                            "identity_error double").fields]))
