"""Embedding whitening by QDWH spectral divide-and-conquer.

Vectors become exact integer vectors x = floor(64 * c) + 1000000, so that equal
ones can be found and sums are exact. Over the distinct vectors (the fit list)
Spark sums x, then the products of the centred entries, each task sending one
number per pair of dimensions. The covariance, a matrix of the dimensions alone,
is split on the driver: the polar factor U of the covariance less a shift (QDWH:
dynamically weighted Halley steps, by QR or by Cholesky) gives the projector
(U + I) / 2 on the eigenvectors above the shift; both invariant subspaces are
split in turn until each has one dimension. The components are broadcast and
every row is projected in its own task.

Defined results: a row is left out if its vector is null, empty, holds a null or
non-finite entry, or an entry of 2**54 or more in size, which has no exact x; so
is a row whose vector is not of the usual length (the one most rows have, the
longer of equals). Repeated rows, rows without an id and equal vectors under
several ids all get results, and count once in the fit list. A component without
variance (of e at most dimensions * 2**-52 of the largest) has a null
``whitened``. ``deviation`` is null where the exact number is beyond a long.
An empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventaria.llm import text as T
from ventaria.session import settle

EPS = float(np.finfo(float).eps)
LARGEST = 2.0 ** 54


@dataclass(frozen=True)
class Settings:
    components: int = 16
    scale: int = 64
    offset: int = 1_000_000


@dataclass(frozen=True)
class Fit:
    """Exact sums of the fit list and the components as columns, largest eigenvalue first."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly; Python integers where 64 bits might not hold it."""
        widest = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums), default=0))
        kind = np.int64 if widest < 1 << 61 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def scales(self) -> np.ndarray:
        """Divisors of the components; NaN where there is no variance."""
        floor = len(self.sums) * EPS * max(self.values[0], 0.0)
        return np.sqrt(np.where(self.values > floor, self.values, np.nan))

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (self.apart(x) / self.n).astype(float) @ self.vectors / self.scales()

    def deviation(self, x: np.ndarray) -> list[int | None]:
        apart = self.apart(x)
        if apart.dtype == object or float(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] >= 2.0 ** 62:
            apart = apart.astype(object)
        return [k if k < 1 << 63 else None for k in (apart * apart).sum(axis=1).tolist()]


def weights(low: float) -> tuple[float, float, float]:
    """Halley weights that are best for singular values in [low, 1]."""
    d = np.cbrt(4 * (1 - low ** 2) / low ** 4)
    a = np.sqrt(1 + d) + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low ** 2) / (low ** 2 * np.sqrt(1 + d))))
    b = (a - 1) ** 2 / 4
    return a, b, a + b - 1


def polar_factor(matrix: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix: its matrix sign."""
    size = len(matrix)
    x = matrix / np.linalg.norm(matrix)
    upper = np.linalg.qr(x, mode="r")
    low = float(np.clip(np.abs(np.diag(upper)).min() / size, EPS, 1.0))  # a guess from below; more steps cost little
    eye = np.eye(size)
    for _ in range(40):
        a, b, c = weights(low)
        if c > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))[0]
            made = b / c * x + (a - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        else:
            half = np.linalg.cholesky(eye + c * x.T @ x)
            made = b / c * x + (a - b / c) * np.linalg.solve(half.T, np.linalg.solve(half, x.T)).T
        made = (made + made.T) / 2
        moved = np.linalg.norm(made - x)
        x, low = made, float(min(1.0, low * (a + b * low ** 2) / (1 + c * low ** 2)))
        if moved <= 4 * EPS ** (1 / 3) and 1 - low < 4 * EPS:
            break
    return x


def split(matrix: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below the shift; None if the shift does not part them cleanly."""
    size = len(matrix)
    projector = (polar_factor(matrix - shift * np.eye(size)) + np.eye(size)) / 2
    share = float(np.trace(projector))
    above = round(share)
    if not 0 < above < size or abs(share - above) > 0.01:
        return None
    basis = np.random.default_rng(size).standard_normal((size, above))
    for _ in range(2):
        whole = np.linalg.qr(projector @ basis, mode="complete")[0]
        basis = whole[:, :above]
    if np.linalg.norm(basis.T @ matrix @ whole[:, above:]) > 100 * size * EPS * np.linalg.norm(matrix):
        return None
    return basis, whole[:, above:]


def shifts(matrix: np.ndarray) -> Iterator[float]:
    """Places to part the spectrum: the middle of the diagonal first, then finer and finer steps across its bounds."""
    diagonal = np.diag(matrix)
    yield float(np.median(diagonal))
    yield float(diagonal.mean())
    radius = np.abs(matrix).sum(axis=1) - np.abs(diagonal)
    low, high = float((diagonal - radius).min()), float((diagonal + radius).max())
    for level in range(1, 7):
        for k in range(1, 1 << level, 2):
            yield low + (high - low) * (k / (1 << level)) * (1 + 2.0 ** -20)
    spread = np.linalg.norm(matrix - diagonal.mean() * np.eye(len(matrix)))
    for k in range(1, 50):
        for sign in (1, -1):
            yield float(diagonal.mean()) + sign * spread * 2.0 ** -k


def spectral(matrix: np.ndarray, scale: float) -> np.ndarray:
    """Eigenvectors as columns, in no order; eigenvalues closer than rounding share any basis of their subspace."""
    size = len(matrix)
    mean = float(np.trace(matrix)) / size
    if size == 1 or np.linalg.norm(matrix - mean * np.eye(size)) <= size * EPS * scale:
        return np.eye(size)
    for shift in shifts(matrix):
        if np.linalg.norm(matrix - shift * np.eye(size)) == 0:
            continue
        parts = split(matrix, shift)
        if parts is not None:
            inside = [(part, part.T @ matrix @ part) for part in parts]
            return np.hstack([part @ spectral((m + m.T) / 2, scale) for part, m in inside])
    return np.eye(size)  # no shift parts it: equal eigenvalues within rounding


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix; two refinement steps remove what the levels rounded."""
    matrix = (matrix + matrix.T) / 2
    scale = float(np.linalg.norm(matrix))
    if scale == 0:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    vectors = spectral(matrix, scale)
    for _ in range(2):
        rest = np.eye(len(matrix)) - vectors.T @ vectors
        inside = vectors.T @ matrix @ vectors
        inside = (inside + inside.T) / 2
        values = np.diag(inside) / (1 - np.diag(rest))
        gap = values[None, :] - values[:, None]
        clear = np.abs(gap) > 1e-6 * scale
        vectors = vectors + vectors @ np.where(clear, (inside + values[None, :] * rest) / np.where(clear, gap, 1.0), rest / 2)
    vectors /= np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ik,kj->j", vectors, matrix, vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def whole_vectors(embeddings: DataFrame, settings: Settings) -> DataFrame:
    """vec_id and x of the rows that count."""
    c = embeddings["embedding"].cast("array<double>")
    usable = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LARGEST))
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), F.when(usable & (F.size(c) > 0), c).alias("c"))
    rows = rows.where(F.col("c").isNotNull()).select("vec_id", F.transform("c", lambda v: F.floor(v * settings.scale) + F.lit(settings.offset).cast("long")).alias("x"))
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).first()
    return rows.where(F.size("x") == (usual["d"] if usual else 0))


def matrix_of(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def summed(rows: DataFrame, step: Callable[[np.ndarray], np.ndarray]) -> dict[tuple[int, int], float]:
    """Sum over all rows of a matrix that ``step`` makes of a batch; each task adds up its own before one number per entry is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                made = step(matrix_of(batch))
                total = made if total is None else total + made
        if total is not None:
            i, j = np.indices(total.shape)
            yield T.named_batch(i=i.ravel(), j=j.ravel(), v=total.ravel())

    kind = "long" if step is halves else "double"
    sums = rows.mapInArrow(run, f"i long, j long, v {kind}").groupBy("i", "j").agg(F.sum("v").alias("v"))
    return {(r["i"], r["j"]): r["v"] for r in sums.collect()}


def halves(x: np.ndarray) -> np.ndarray:
    """Row count and the sums of the high and low 32 bits of each dimension, which 64 bits hold for 2**31 rows."""
    return np.stack([np.full(x.shape[1], len(x)), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])


def square(entries: dict[tuple[int, int], float], size: int) -> np.ndarray:
    made = np.zeros((size, size))
    for (i, j), v in entries.items():
        made[i, j] = v
    return made


def fit(vectors: DataFrame, settings: Settings = Settings()) -> tuple[Fit, float | None] | None:
    """Components of the distinct vectors, and the largest entry of the whitened covariance less the identity; None without rows."""
    listed = settle(vectors.select("x").distinct())
    sums = summed(listed, halves)
    if not sums:
        return None
    size = 1 + max(j for _, j in sums)
    n = sums[0, 0]
    total = tuple((sums[1, j] << 32) + sums[2, j] for j in range(size))
    centre = Fit(n, total, np.eye(size), np.ones(size), np.ones(size))

    def products(x: np.ndarray) -> np.ndarray:
        apart = (centre.apart(x) / n).astype(float)
        return apart.T @ apart

    covariance = square(summed(listed, products), size) / n
    values, components = eigen(covariance)
    trace = float(np.trace(covariance))
    k = min(settings.components, size)
    made = Fit(n, total, components[:, :k], values[:k], values[:k] / trace if trace > 0 else np.full(k, np.nan))
    usable = np.flatnonzero(~np.isnan(made.scales()))
    if not len(usable):
        return made, None

    def whitened_products(x: np.ndarray) -> np.ndarray:
        white = made.whiten(x)[:, usable]
        return np.vstack([white.T @ white, white.sum(axis=0)])

    entries = summed(listed, whitened_products)
    mean = np.array([entries[len(usable), j] for j in range(len(usable))]) / n
    found = square({k: v for k, v in entries.items() if k[0] < len(usable)}, len(usable)) / n - np.outer(mean, mean)
    return made, float(np.abs(found - np.eye(len(usable))).max())


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row for each usable vector and component."""
    rows = whole_vectors(embeddings, settings)
    fitted = fit(rows, settings)
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], SCHEMA)
    model, error = fitted
    sent = embeddings.sparkSession.sparkContext.broadcast(model)  # dimensions x components numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        k = len(m.values)
        numbers = np.arange(1, k + 1, dtype=np.int32)
        explained = pa.array(m.explained, from_pandas=True)
        for batch in batches:
            if batch.num_rows:
                x = matrix_of(batch)
                each = pa.array(np.repeat(np.arange(len(x)), k))
                yield T.named_batch(
                    vec_id=batch.column("vec_id").take(each), component=np.tile(numbers, len(x)), n=np.full(len(x) * k, m.n),
                    deviation=pa.array(m.deviation(x), pa.int64()).take(each), whitened=pa.array(m.whiten(x).ravel(), from_pandas=True),
                    explained=explained.take(pa.array(np.tile(np.arange(k), len(x)))), identity_error=pa.array([error] * (len(x) * k), pa.float64()))

    return rows.mapInArrow(run, SCHEMA)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
