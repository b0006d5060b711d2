"""Whitening of embeddings by spectral divide-and-conquer.

Vectors become whole numbers, ``floor(SCALE * c) + OFFSET``; each different vector counts once in mean and covariance. The covariance is summed by
tasks over vectors from which the mean was taken first. Its eigenvectors come from polar decompositions: with ``A - sI = U H``, ``(U + I) / 2``
projects on the eigenvectors above the shift ``s``; an orthonormal basis of its range and of its complement splits ``A`` in two blocks, and each is
split again until single components are left. The polar factor is found by dynamically weighted Halley steps on QR factorisations, at most six or
seven whatever the conditioning. Only matrices of dimension x dimension numbers ever reach the driver or travel to the tasks (33 kB at 64
dimensions, 34 MB at 2,048).

Rows whose vector is null, or holds null, NaN or infinite entries, are dropped, and so are those of another length than the most frequent one (the
longer on a tie). Repeated vectors count once, and each of their rows is returned. Components without variance (below ``TINY`` of the largest) can't
be whitened and are left out, so one different vector alone, or an empty table, gives no rows. Other columns aren't read. A ``deviation`` beyond 64 bits
is an error, not a wrong number; so is an entry beyond 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import staged

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
TINY = 1e-12
ROWS_AT_ONCE = 4096


def polar(a: np.ndarray, low: float) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix of norm 1 at most whose singular values are ``low`` or more."""
    x, eye = a, np.eye(len(a))
    for _ in range(12):
        if abs(1 - low) < 1e-15:
            break
        d = np.cbrt(4 * (1 - low**2) / low**4)
        h = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + d)))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
        step = b / c * x + (h - b / c) / np.sqrt(c) * q[:len(a)] @ q[len(a):].T
        step = (step + step.T) / 2
        moved, x = np.linalg.norm(step - x), step
        low = min(low * (h + b * low**2) / (1 + c * low**2), 1.0)
        if moved < 1e-14 * np.sqrt(len(a)):
            break
    return x


def _shifts(a: np.ndarray) -> list[tuple[float, float, float]]:
    """(bound below of the relative gap, shift, norm) of shifts around the mean eigenvalue, the widest gap first.

    The mean lies between the least and the greatest eigenvalue, the others split clusters beside it.
    """
    n, mean = len(a), np.trace(a) / len(a)
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    out = []
    for shift in [mean, float(np.median(np.diag(a))), *(mean + f * spread for f in (-0.5, -0.2, -0.07, 0.07, 0.2, 0.5))]:
        moved = a - shift * np.eye(n)
        norm = np.sqrt(np.linalg.norm(moved, 1) * np.linalg.norm(moved, np.inf))
        r = np.linalg.qr(moved / norm, mode="r")
        if np.abs(np.diag(r)).min() > 1e-15:
            out.append((1 / np.linalg.norm(np.linalg.inv(r)), shift, norm))
    return sorted(out, reverse=True)


def spectral_split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two complementary invariant subspaces; None if all eigenvalues are the same."""
    n, rng = len(a), np.random.default_rng(0)
    for low, shift, norm in _shifts(a):
        projector = (polar((a - shift * np.eye(n)) / norm, max(low, 1e-15)) + np.eye(n)) / 2
        k = round(float(np.trace(projector)))
        if not 0 < k < n:
            continue
        q, _ = np.linalg.qr(projector @ rng.standard_normal((n, k)))
        q, _ = np.linalg.qr(projector @ q)
        other = rng.standard_normal((n, n - k))
        for _ in range(2):
            other -= projector @ other
            other -= q @ (q.T @ other)
            other, _ = np.linalg.qr(other)
        if np.linalg.norm(other.T @ a @ q) <= 1e-12 * np.linalg.norm(a):
            return q, other
    return None


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    whole = np.linalg.norm(a)

    def solve(block: np.ndarray, basis: np.ndarray) -> list[tuple[float, np.ndarray]]:
        block = (block + block.T) / 2
        apart = block - np.diag(np.diag(block))
        split = spectral_split(block) if len(block) > 1 and np.linalg.norm(apart) > 1e-16 * whole else None
        if split is None:
            return [(block[k, k], basis[:, k]) for k in range(len(block))]
        return [x for half in split for x in solve(half.T @ block @ half, basis @ half)]

    found = sorted(solve(a, np.eye(len(a))), key=lambda x: -x[0])
    vectors = np.stack([v for _, v in found], axis=1)
    return np.array([v @ a @ v for v in vectors.T]), vectors


def quantised(df: DataFrame, vector: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, int]:
    """vec_id and x, the whole numbers of each valid vector as little-endian 64-bit integers; their number per vector."""
    v = F.col(f"`{vector}`").cast("array<double>")
    sound = v.isNotNull() & F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    rows = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), v.alias("v")).where(sound)
    rows = staged(rows.select("vec_id", F.transform("v", lambda c: F.floor(SCALE * c).cast("long") + OFFSET).alias("x")), "whitening-rows")
    sizes = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = sizes["dims"] if sizes else 0
    return rows.where(F.size("x") == dims), dims


def matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(low, ROWS_AT_ONCE)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(part.num_rows, dims)


def summed(rows: DataFrame, dims: int, of, width: int) -> tuple[int, np.ndarray]:
    """Rows, and the sum over all rows of ``of(x)`` (``width`` numbers per task), added position by position."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for _, x in matrices(batches, dims):
            n, part = n + len(x), of(x)
            total = part if total is None else total + part
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n] * width, pa.int64()), pa.array(range(width), pa.int32()), pa.array(total.ravel())], names=["n", "at", "value"])

    number = "long" if of(np.zeros((1, dims), np.int64)).dtype == np.int64 else "double"
    parts = rows.select("x").mapInArrow(run, f"n long, at int, value {number}").groupBy("at").agg(F.sum("n").alias("n"), F.sum("value").alias("value")).collect()
    values = np.zeros(width, np.int64 if number == "long" else float)
    for row in parts:  # dims or dims * dims numbers
        values[row["at"]] = row["value"]
    return (parts[0]["n"] if parts else 0), values


class Centred:
    """Mean of the fit list as whole part and rest, so that vectors lose no digits when it is taken off."""

    def __init__(self, n: int, sums: np.ndarray):
        self.whole = sums // n
        self.rest = (sums - self.whole * n) / n

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest


def covariance(rows: DataFrame, n: int, dims: int, view) -> np.ndarray:
    """Covariance, divisor n, of ``view(x)``, whose mean is 0 up to rounding."""
    size = view(np.zeros((1, dims), np.int64)).shape[1]
    _, sums = summed(rows, dims, lambda x: np.concatenate([(y := view(x)).T @ y, y.sum(axis=0)[None]]), size * (size + 1))
    sums = sums.reshape(size + 1, size) / n
    return sums[:size] - np.outer(sums[size], sums[size])


def whiten(df: DataFrame, vector: str = "embedding", key: str = "vec_id", top: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every valid row and component."""
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, dims = quantised(df, vector, key)
    fit = staged(rows.select("x").groupBy("x").agg(F.lit(1).alias("one")).select("x"), "whitening-fit") if dims else rows
    n, sums = summed(fit, dims, lambda x: x.sum(axis=0), dims) if dims else (0, np.zeros(0))
    if not n:
        return df.sparkSession.createDataFrame([], schema)
    centre = Centred(n, sums)
    spread = covariance(fit, n, dims, centre)
    values, vectors = components(spread)
    kept = min(top, int((values > TINY * max(values[0], 0)).sum())) if values[0] > 0 else 0
    if not kept:
        return df.sparkSession.createDataFrame([], schema)
    turn = vectors[:, :kept] / np.sqrt(values[:kept])
    explained = values[:kept] / np.trace(spread)
    whitened = lambda x: centre(x) @ turn
    error = float(np.abs(covariance(fit, n, dims, whitened) - np.eye(kept)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches, dims):
            far = n * x - sums
            if (np.square(far.astype(float)).sum(axis=1) > 9.2e18).any():
                raise OverflowError("deviation beyond 64 bits")
            count = len(x)
            columns = [
                part.column("vec_id").take(pa.array(np.repeat(np.arange(count), kept))),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), count)), pa.array(np.full(count * kept, n)),
                pa.array(np.repeat(np.square(far).sum(axis=1), kept)), pa.array(whitened(x).ravel()),
                pa.array(np.tile(explained, count)), pa.array(np.full(count * kept, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select("vec_id", "x").mapInArrow(run, schema)
