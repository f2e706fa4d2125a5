"""Embedding whitening (operator 11): Chebyshev-filtered subspace iteration.

Entries become integers ``x = floor(SCALE * c) + OFFSET``. The covariance ``V`` of all vectors
(divisor n) is never formed: it is only applied to a block ``Q`` of few columns. One such pass
is a Spark job: every task adds up ``Yᵀ(YQ)`` of its rows ``Y = (n x - S) / n`` (centred from
exact integers before anything is multiplied) and the partial sums, of the size of Q, are
added by a shuffle on the row number.

1. A few Lanczos steps bound the spectrum from both sides.
2. A Chebyshev polynomial of V (three-term recurrence, one pass a degree) damps the interval
   below the least Ritz value of the block; QR and Rayleigh-Ritz follow on the driver (d x b numbers).
   The degree is kept so low that the leading direction cannot drown the others; pairs
   that have settled are locked and projected out of the filter.
3. This goes on until all wanted pairs are certified: residuals ``|Vq - eq|`` of at most
   ``RESIDUAL * d * eps * e1``, checked in a pass of its own. Not settling raises.

Rows whose vector is null, or holds null or non-finite entries, are dropped, and so are
vectors whose length is not the commonest one (of equally common ones the longest). Components with
a variance of nothing (below ``RANK`` of the greatest) cannot be whitened and are left out: equal
vectors or a single one give no rows, and neither does an empty table. Equal eigenvalues come in any
order, the same for all rows. Repeated rows and null ids stay; extra columns are ignored.
Entries beyond 2^40 raise. A vector is whole in one task, however long; Q has as
many rows as a vector has entries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table

SCALE, OFFSET, MOST = 1024, 100_000, 1 << 50
#: Vectors that one stored block holds.
BLOCK_ROWS = 4096
GUARD, LANCZOS_STEPS, MAX_ROUNDS, SEED = 8, 8, 200, 11
#: Greatest growth that a filter may give the leading pair over the damped interval.
MOST_GROWTH, MOST_DEGREE = 1e10, 24
RESIDUAL, RANK = 8, 1e-11


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``_id, _x`` of the rows that count; ``_x`` holds the integers."""
    v = F.col("_v")
    rows = vectors.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("_v"))
    whole = v.isNotNull() & F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = rows.filter(F.coalesce(whole, F.lit(False)))
    size = rows.groupBy(F.size("_v").alias("_d")).count().orderBy(F.desc("count"), F.desc("_d")).first()
    rows = rows.filter(F.size("_v") == (size["_d"] if size else 0))
    return rows.select("_id", F.transform(v, lambda c: F.floor(c * F.lit(float(SCALE))) + F.lit(OFFSET)).alias("_x"))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if x.size and max(int(x.max()), -int(x.min())) > MOST:
        raise ValueError("an embedding entry is too large to be whitened in double precision")
    return x.reshape(rows, -1)


def _blocks(rows: DataFrame) -> DataFrame:
    """``n, x, s``: blocks of vectors as bytes (int64) with their number and sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.column(0).slice(at, BLOCK_ROWS)
                x = _matrix(part, len(part))
                yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), pa.array([x.tobytes()], pa.binary()), pa.array([x.sum(0).tolist()], pa.list_(pa.int64()))], names=["n", "x", "s"])

    return shared_table(rows.select("_x").mapInArrow(run, "n long, x binary, s array<long>"), "whitening-blocks")


class _Centre:
    """``n x - S`` exactly, and the centred vectors in double precision."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.wide = n * MOST >= 1 << 62 and (n * max(1, max(map(abs, sums), default=0) // n + (1 << 31)) >= 1 << 61)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        most = max(int(x.max()), -int(x.min())) if x.size else 0
        if self.wide or self.n * most >= 1 << 61:
            return self.n * x.astype(object) - np.array(self.sums, dtype=object)
        return self.n * x - np.array(self.sums, np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n


def _sum_pass(blocks: DataFrame, centre: _Centre, body: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all blocks of ``body(Y)``, a matrix of the given shape, whatever the number of rows."""
    rows, cols = shape
    d = len(centre.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for cell in batch.column(0):
                total += body(centre(np.frombuffer(cell.as_py(), np.int64).reshape(-1, d)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows), pa.int32()), *[pa.array(total[:, j]) for j in range(cols)]], names=["i", *[f"c{j}" for j in range(cols)]])

    parts = blocks.select("x").mapInArrow(run, "i int, " + ", ".join(f"c{j} double" for j in range(cols)))
    out = np.zeros(shape)
    for r in parts.groupBy("i").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(cols)]).collect():  # as many rows as the matrix has
        out[r["i"]] = r[1:]
    return out


def _lanczos_bounds(times: Callable[[np.ndarray], np.ndarray], d: int, rng: np.random.Generator) -> tuple[float, float]:
    """Lower and upper bounds of the spectrum from a few Lanczos steps (full reorthogonalisation)."""
    q = rng.standard_normal((d, 1))
    basis = q / np.linalg.norm(q)
    alpha, beta = [], []
    for _ in range(min(LANCZOS_STEPS, d)):
        w = times(basis[:, -1:])
        alpha.append(float(basis[:, -1] @ w[:, 0]))
        for _ in range(2):
            w -= basis @ (basis.T @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(map(abs, alpha)):
            break
        basis = np.hstack([basis, w / beta[-1]])
    theta = np.linalg.eigvalsh(np.diag(alpha) + np.diag(beta[: len(alpha) - 1], 1) + np.diag(beta[: len(alpha) - 1], -1))
    return max(0.0, float(theta[0]) - beta[-1]), float(theta[-1]) + beta[-1]


def _filter(times, q: np.ndarray, degree: int, low: float, cut: float, top: float) -> np.ndarray:
    """Chebyshev polynomial of V on ``q``: small on [low, cut], of size one at ``top``."""
    half, centre = (cut - low) / 2, (cut + low) / 2
    sigma = first = half / (top - centre)
    before, now = q, (times(q) - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        nxt = 1 / (2 / first - sigma)
        before, now = now, (times(now) - centre * now) * (2 * nxt / half) - sigma * nxt * before
        sigma = nxt
    return now


def leading_pairs(times: Callable[[np.ndarray], np.ndarray], d: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues of the symmetric positive semidefinite operator
    ``times``, their unit vectors as columns, and the certified residual norms."""
    rng = np.random.default_rng(SEED)
    eps = np.finfo(float).eps
    width = min(d, 2 * k + GUARD)

    def ritz(q):
        w = times(q)
        h = q.T @ w
        theta, u = np.linalg.eigh((h + h.T) / 2)
        order = np.argsort(-theta, kind="stable")
        theta, u = theta[order], u[:, order]
        return theta, q @ u, np.linalg.norm(w @ u - (q @ u) * theta, axis=0)

    q = np.eye(d) if width == d else np.linalg.qr(rng.standard_normal((d, width)))[0]
    theta, q, residual = ritz(q)
    if theta[0] <= 0:
        return theta[:k], q[:, :k], residual[:k]
    low, high = (0.0, theta[0]) if width == d else _lanczos_bounds(times, d, rng)
    for _ in range(MAX_ROUNDS):
        most = RESIDUAL * d * eps * theta[0]
        if all(residual[:k] <= most):
            return theta[:k], q[:, :k], residual[:k]
        done = 0
        while done < k and residual[done] <= most:
            done += 1
        locked, free = q[:, :done], q[:, done:]

        def rest(y):
            w = times(y)
            return w - locked @ (locked.T @ w) if done else w  # noqa: B023

        cut, top = theta[-1], theta[done]
        floor = min(low, 0.5 * cut)
        if cut - floor <= RANK * theta[0] or top <= cut:
            grown = rest(free)  # nothing to damp but rounding: a plain power step
        else:
            far = (2 * top - cut - floor) / (cut - floor)
            degree = int(np.clip(np.arccosh(MOST_GROWTH) / np.arccosh(max(far, 1 + 1e-6)), 2, MOST_DEGREE))
            grown = _filter(rest, free, degree, floor, cut, max(top, min(high, theta[0]) if not done else top))
        theta, q, residual = ritz(np.linalg.qr(np.hstack([locked, grown]))[0])
    raise RuntimeError(f"eigenpairs not certified after {MAX_ROUNDS} rounds, residuals {residual[:k]}")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 8) -> DataFrame:
    """One row per usable vector and component: ``id_col, component, n, deviation`` (decimal, exact),
    ``whitened, explained, identity_error, eigenvalue, residual``."""
    rows = _usable(vectors, id_col, vec_col)
    kind = rows.schema["_id"].dataType.simpleString()
    form = f"_id {kind}, _dev string, _z array<double>"
    blocks = _blocks(rows)
    n = blocks.agg(F.sum("n")).first()[0] or 0
    sums = [int(r["s"]) for r in blocks.select(F.posexplode("s").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()]
    d = len(sums)
    eigen, axes, residual, trace, identity = np.zeros(0), np.zeros((d, 0)), np.zeros(0), 0.0, 0.0
    centre = _Centre(max(n, 1), sums)
    if n and d:
        trace = float(_sum_pass(blocks, centre, lambda y: np.array([[float((y * y).sum())]]), (1, 1))[0, 0]) / n
    if trace > 0:
        eigen, axes, residual = leading_pairs(lambda q: _sum_pass(blocks, centre, lambda y: y.T @ (y @ q), q.shape) / n, d, min(k, d))
        real = eigen > RANK * eigen[0]
        eigen, axes, residual = eigen[real], axes[:, real], residual[real]
    m = len(eigen)
    axes = axes / np.sqrt(eigen) if m else axes
    if m:
        def moments(y):
            z = y @ axes
            return np.vstack([z.T @ z, z.sum(0)])

        total = _sum_pass(blocks, centre, moments, (m + 1, m)) / n
        identity = float(np.abs(total[:m] - np.outer(total[m], total[m]) - np.eye(m)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = centre.scaled(_matrix(batch.column(1), batch.num_rows))
            if y.dtype != object and (not y.size or float(np.abs(y).max()) ** 2 * d < 2.0**62):
                deviation = (y * y).sum(1)
            else:
                deviation = (y.astype(object) ** 2).sum(1)
            z = (y.astype(np.float64) / centre.n) @ axes
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([str(v) for v in deviation], pa.string()),
                                              pa.array(z.tolist(), pa.list_(pa.float64()))], names=["_id", "_dev", "_z"])

    each = rows.mapInArrow(run, form) if m else rows.select("_id", F.lit("0").alias("_dev"), F.array().cast("array<double>").alias("_z"))
    const = lambda values: F.get(F.array(*[F.lit(float(v)) for v in values]) if len(values) else F.array().cast("array<double>"), F.col("_j"))
    return each.select("_id", "_dev", F.posexplode("_z").alias("_j", "_w")).select(
        F.col("_id").alias(id_col), (F.col("_j") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
        F.col("_dev").cast("decimal(38,0)").alias("deviation"), F.col("_w").alias("whitened"),
        const(eigen / trace if m else []).alias("explained"), F.lit(identity).alias("identity_error"),
        const(eigen).alias("eigenvalue"), const(residual).alias("residual"))
