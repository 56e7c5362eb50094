"""Embedding whitening by shifted CholeskyQR.

The centred rows are a tall matrix ``A`` that is never held whole. A pass over the rows
sums the Gram matrix; its shifted Cholesky factor makes the columns nearly orthogonal by
triangular solves, row by row. Further passes sum the Gram matrix of the solved rows and
correct what the shift and rounding left. The product ``R`` of all factors fulfils
``R'R = A'A``, and the singular vectors and values of this small matrix give the
components and their variances. The condition of ``A`` is not squared on the way, as it
would be by the eigenvectors of one Gram matrix.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.llm.common import batch_fold, gathered, per_batch, table

#: An entry ``c`` becomes ``floor(SCALE * c)``; entries of ``LARGEST`` or more would not be exact.
SCALE, LARGEST = 64, float(1 << 46)
#: Components returned at most; passes of the factorisation.
COMPONENTS, PASSES = 32, 3
#: Components with less than this share of the largest variance count as constant.
RANK = 1e-13
UNIT_ROUNDOFF = float(np.finfo(np.float64).eps) / 2


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``embedding`` of rows whose vector is not empty and holds no null, non-finite or huge entry."""
    sound = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return vectors.select("vec_id", "embedding").filter((F.size("embedding") > 0) & sound)


def common_length(vectors: DataFrame) -> int | None:
    """Length most vectors have, the longest of equally frequent ones; ``None`` without vectors."""
    lengths = vectors.groupBy(F.size("embedding").alias("length")).agg(F.count("*").alias("n"))
    first = lengths.orderBy(F.col("n").desc(), F.col("length").desc()).first()
    return first["length"] if first else None


def entries(batch: pa.RecordBatch, length: int) -> np.ndarray:
    """``floor(SCALE * c)`` of all entries as a matrix of longs.

    A constant added to all entries, as the contract's, cancels out of everything centred.
    """
    values = batch["embedding"].flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(SCALE * values).astype(np.int64).reshape(-1, length)


def totals(rows: DataFrame, length: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sums of their entries."""

    def measure(batch: pa.RecordBatch) -> tuple:
        whole = entries(batch, length)
        if int(np.abs(whole).max()) * len(whole) >= 1 << 62:
            whole = whole.astype(object)
        return len(whole), [int(s) for s in whole.sum(axis=0)]

    def merge(a: tuple, b: tuple) -> tuple:
        return a[0] + b[0], [s + t for s, t in zip(a[1], b[1], strict=True)]

    return gathered(rows, batch_fold(measure, merge), merge)


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``Q`` with ``Q @ factor == rows`` for an upper triangular factor, by forward substitution."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def centred(batch: pa.RecordBatch, mean: np.ndarray) -> np.ndarray:
    return entries(batch, len(mean)) - mean


def gram(rows: DataFrame, mean: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Gram matrix of the centred rows solved by the factors found so far."""

    def measure(batch: pa.RecordBatch) -> np.ndarray:
        part = centred(batch, mean)
        for factor in factors:
            part = solved(part, factor)
        return part.T @ part

    return gathered(rows, batch_fold(measure, np.add), np.add)


def cholesky(matrix: np.ndarray, shift: float) -> np.ndarray:
    """Upper triangular factor of ``matrix + shift * I``; the shift grows until the matrix is definite."""
    while True:
        try:
            return np.linalg.cholesky(matrix + shift * np.eye(len(matrix))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, UNIT_ROUNDOFF * float(np.trace(matrix)))


def triangular(rows: DataFrame, mean: np.ndarray, count: int) -> np.ndarray:
    """``R`` of the centred rows: the first factor shifted, the others as they are, all multiplied."""
    factors: list[np.ndarray] = []
    size = len(mean)
    whole = np.eye(size)
    for number in range(PASSES):
        matrix = gram(rows, mean, factors)
        if not np.trace(matrix) > 0:
            return np.zeros((size, size))
        bound = 11 * (count * size + size * (size + 1)) * UNIT_ROUNDOFF * float(np.trace(matrix))
        factors.append(cholesky(matrix, bound if number == 0 else 0.0))
        whole = factors[-1] @ whole
    return whole


@dataclass
class Whitening:
    """What whitening needs of the corpus: ``count`` vectors, exact ``sums`` of their entries and the components.

    ``directions`` holds a unit eigenvector a column, by falling ``variances``; ``trace`` is the
    sum of all variances, those of components left out included.
    """

    count: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.count for s in self.sums])

    def project(self, batch: pa.RecordBatch) -> np.ndarray:
        return centred(batch, self.mean) @ (self.directions / np.sqrt(self.variances))


def fit(rows: DataFrame, length: int, most: int = COMPONENTS) -> Whitening:
    """Components of usable rows of one length, by up to ``PASSES`` Gram passes.

    Of each eigenvector the entry of largest size is positive. Components of constant
    directions, with less than ``RANK`` of the largest variance, are left out.
    """
    count, sums = totals(rows, length)
    mean = np.array([s / count for s in sums])
    _, values, transposed = np.linalg.svd(triangular(rows, mean, count))
    variances = values**2 / count
    kept = np.flatnonzero((variances > 0) & (variances > RANK * variances[0]))[:most]
    directions = transposed[kept].T
    strongest = directions[np.abs(directions).argmax(axis=0), np.arange(len(kept))]
    return Whitening(count, sums, directions * np.sign(strongest), variances[kept], float(variances.sum()))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry, by size, of the whitened rows' covariance less the identity; 0 without components.

    Each batch is centred by its own mean; means and scatter matrices are merged exactly.
    """

    def measure(batch: pa.RecordBatch) -> tuple:
        part = model.project(batch)
        mean = part.mean(axis=0)
        return len(part), mean, (part - mean).T @ (part - mean)

    def merge(a: tuple, b: tuple) -> tuple:
        n, apart = a[0] + b[0], b[1] - a[1]
        return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)

    if not len(model.variances):
        return 0.0
    count, _, scatter = gathered(rows, batch_fold(measure, merge), merge)
    return float(np.abs(scatter / count - np.eye(len(scatter))).max())


def deviations(whole: np.ndarray, model: Whitening) -> list[int | None]:
    """Exact sum over dimensions of ``(n * x - S) ** 2`` of each row; null where a long can't hold it."""
    largest = int(np.abs(whole).max(initial=0)) * model.count + max(map(abs, model.sums))
    exact = largest**2 * whole.shape[1] < 1 << 63
    kind = np.int64 if exact else object
    apart = whole.astype(kind) * model.count - np.array(model.sums, dtype=kind)
    found = [int(v) for v in (apart * apart).sum(axis=1)]
    return found if exact else [v if v < 1 << 63 else None for v in found]


SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """Whitened components of every vector: one row a vector and component, the first of largest variance.

    Takes ``vec_id`` and ``embedding``; other columns, whatever their names, are not read.
    Rows whose vector is null, empty or holds a null or non-finite entry are dropped, as are those with an
    entry of 2^46 or more, which doubles can't scale exactly. If vectors differ in length, those of the most
    frequent length (the longest of equally frequent ones) take part and the others are dropped. A null id
    takes part; repeated rows count, and come out, each time. Equal eigenvalues have any orthonormal basis.
    Constant directions have no component, so an empty table, a single vector or equal vectors give no rows.
    ``deviation`` is null where it exceeds a long.

    Runs one small job for the length and five over all rows; each returns matrices of ``length`` squared
    entries, whatever the number of rows, and nothing is staged: every pass reads the vectors anew.
    """
    rows = usable(vectors)
    length = common_length(rows)
    if length is None:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    rows = rows.filter(F.size("embedding") == length)
    model = fit(rows, length, most)
    error = identity_error(rows, model)
    k = len(model.variances)
    explained = model.variances / model.trace if k else model.variances

    def convert(batch: pa.RecordBatch) -> dict:
        count = len(batch)
        return {
            "vec_id": batch["vec_id"].take(pa.array(np.repeat(np.arange(count), k))),
            "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
            "n": pa.array(np.full(count * k, model.count, dtype=np.int64)),
            "deviation": pa.array(deviations(entries(batch, length), model), pa.int64()).take(
                pa.array(np.repeat(np.arange(count), k))
            ),
            "whitened": pa.array(model.project(batch).ravel()),
            "explained": pa.array(np.tile(explained, count)),
            "identity_error": pa.array(np.full(count * k, error)),
        }

    return per_batch(rows, convert, SCHEMA)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of all embeddings."""
    return whiten(table(spark, sf_dir, "embeddings"))
