"""Whitening of embeddings by polarisation.

A covariance is a difference of variances:
``cov(a, b) = (var(a + b) - var(a) - var(b)) / 2``.  So one kind of aggregate is
enough: the sum of squared centred values, of each dimension and of the sum of
each pair of dimensions.

1. Entries become whole numbers.  The first pass sums each dimension.
2. The second pass subtracts each dimension's whole mean and sums the squares,
   in whole numbers; what the whole mean leaves of the mean is taken off after.
   So no digit is lost, however far the values are from 0.
3. The driver gets one number per pair of dimensions and computes eigenvectors.
4. Rows are projected, and a third pass checks by the same sums that the result's
   covariance is the identity.

A task sends one number per pair of dimensions; rows are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytide.llm.common import cut

SCALE, SHIFT = 64, 1_000_000
LIMIT = float(1 << 52)  # larger entries count as this
COMPONENTS = 32
LEAST = 1e-10  # eigenvalues under this share of the greatest are no components
ROWS = 4096  # summed together
SMALL = 1 << 24  # squares of pair sums of smaller values can be summed as 64-bit numbers

WHOLE = pa.decimal128(38, 0)


@dataclass
class Whitener:
    """What the fit gives: rows, whole means, rests of the means, eigenvalues' shares and the projection."""

    n: int
    mean: np.ndarray
    rest: np.ndarray
    explained: np.ndarray
    project: np.ndarray

    def centred(self, values: np.ndarray) -> np.ndarray:
        return (values - self.mean) - self.rest / self.n

    def whiten(self, values: np.ndarray) -> np.ndarray:
        return self.centred(values) @ self.project

    def deviations(self, values: np.ndarray) -> list[int | None]:
        """Exact squared distance from the mean times ``n`` squared; null beyond 64 bits."""
        whole = values - self.mean
        most = (int(np.abs(whole).max(initial=0)) + 1) * self.n
        if most * most * max(1, values.shape[1]) < 1 << 63:
            return ((self.n * whole - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * whole.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return [x if x < 1 << 63 else None for x in exact]


def whole_vectors(rows: DataFrame, id_column: str, vector_column: str, scale: int, shift: int) -> DataFrame:
    """``vec_id, x`` of the rows whose vector has only finite entries."""
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    within = lambda c: F.least(F.greatest(scale * c, F.lit(-LIMIT)), F.lit(LIMIT))
    rows = rows.select(F.col(f"`{id_column}`").alias("vec_id"), vector.alias("_v"))
    rows = rows.where(F.col("_v").isNotNull() & F.forall("_v", lambda c: F.coalesce(finite(c), F.lit(False))))
    return rows.select("vec_id", F.transform("_v", lambda c: F.floor(within(c)) + shift).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """An array column whose rows have one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _dimension_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``size, at, rows, total`` per length of vectors and dimension, combined in the task."""
    sums: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        column = batch.column("x")
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes[sizes > 0]).tolist():
            values = _matrix(column.filter(pa.array(sizes == size)))
            # High and low parts are summed apart, so that no sum overflows.
            total = (values >> 26).sum(axis=0).astype(object) * (1 << 26) + (values & ((1 << 26) - 1)).sum(axis=0).astype(object)
            n, before = sums.get(size, (0, 0))
            sums[size] = n + len(values), before + total
    for size, (n, total) in sums.items():
        yield pa.RecordBatch.from_pydict(
            {
                "size": pa.array([size] * size, pa.int32()),
                "at": pa.array(range(size), pa.int32()),
                "rows": pa.array([n] * size, pa.int64()),
                "total": pa.array([Decimal(int(t)) for t in total], WHOLE),
            }
        )


def pair_squares(values: np.ndarray) -> np.ndarray:
    """Sums over rows of each column's square and of each pair's squared sum: ``(0, 0), (0, 1), .., (1, 1), ..``."""
    if values.dtype.kind == "i" and np.abs(values).max(initial=0) >= SMALL:
        values = values.astype(object)
    out = []
    for i in range(values.shape[1]):
        rest = values[:, i:] + values[:, i : i + 1]
        rest[:, 0] = values[:, i]
        out.append((rest * rest).sum(axis=0))
    return np.concatenate(out) if out else np.zeros(0)


def _squares(size: int, made: Callable[[np.ndarray], np.ndarray], whole: bool):
    """Per task: ``pair, total`` of the squares of ``made(values)``; with ``pair`` -1 - i each column's sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, plain = None, 0
        for batch in batches:
            column = batch.column("x")
            column = column.filter(pa.array(column.value_lengths().to_numpy(zero_copy_only=False) == size))
            for row in range(0, len(column), ROWS):
                values = made(_matrix(column.slice(row, ROWS)))
                squares = pair_squares(values)
                total = (total if total is not None else 0) + (squares.astype(object) if whole else squares)
                plain = plain + values.sum(axis=0)
        if total is not None:
            numbers = [Decimal(int(t)) for t in total] if whole else np.concatenate([total, plain])
            pairs = np.arange(len(total)) if whole else np.concatenate([np.arange(len(total)), -1 - np.arange(len(plain))])
            yield pa.RecordBatch.from_pydict({"pair": pa.array(pairs, pa.int64()), "total": pa.array(numbers, WHOLE if whole else pa.float64())})

    return run


def _totals(vectors: DataFrame, size: int, made: Callable[[np.ndarray], np.ndarray], whole: bool) -> dict[int, Decimal | float]:
    kind = "decimal(38,0)" if whole else "double"
    sums = vectors.select("x").mapInArrow(_squares(size, made, whole), f"pair long, total {kind}")
    return dict(map(tuple, sums.groupBy("pair").agg(F.sum("total")).collect()))


def _pairs(size: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(size) for j in range(i, size)]


def covariance(n: int, rest: list[int], squares: list[int]) -> np.ndarray:
    """Covariance from the exact squares of values without their whole mean; ``rest`` is their sum."""
    size, out = len(rest), np.zeros((len(rest), len(rest)))
    exact = dict(zip(_pairs(size), squares, strict=True))
    own = [n * exact[i, i] - rest[i] ** 2 for i in range(size)]
    for (i, j), square in exact.items():
        both = own[i] if i == j else (n * square - (rest[i] + rest[j]) ** 2 - own[i] - own[j]) // 2
        out[i, j] = out[j, i] = both / (n * n)  # of whole numbers, rounded once
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[int, Whitener] | None:
    """The most frequent length of ``vectors(x)``, the longer of equals, and the whitener of the vectors that have it."""
    sums = vectors.select("x").mapInArrow(_dimension_sums, "size int, at int, rows long, total decimal(38,0)")
    sums = cut(sums.groupBy("size", "at").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total")))
    most = sums.where("at = 0").orderBy(F.desc("rows"), F.desc("size")).first()
    if most is None:
        return None
    size, n = most["size"], most["rows"]
    total = [int(r["total"]) for r in sums.where(F.col("size") == size).orderBy("at").collect()]
    mean = [t // n for t in total]
    rest = [t - n * m for t, m in zip(total, mean)]
    centre = np.array(mean, dtype=np.int64)
    squares = _totals(vectors, size, lambda values: values - centre, whole=True)
    spread = covariance(n, rest, [int(squares[k]) for k in range(size * (size + 1) // 2)])
    values, vectors_ = np.linalg.eigh(spread)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    count = min(components, int((values > LEAST * max(values[0], 0)).sum()))
    values, vectors_ = values[:count], vectors_[:, :count]
    # The entry of greatest size is positive.
    signs = np.sign(vectors_[np.abs(vectors_).argmax(axis=0), np.arange(count)])
    project = vectors_ * signs / np.sqrt(values)
    return size, Whitener(n, centre, np.array(rest, dtype=np.int64), values / np.trace(spread), project)


def identity_error(vectors: DataFrame, size: int, whitener: Whitener) -> float:
    """Greatest entry of the whitened vectors' covariance minus the identity.

    They are images of centred values, so their sums are 0 but for rounding, which is taken off.
    """
    totals = _totals(vectors, size, whitener.whiten, whole=False)
    n, count = whitener.n, whitener.project.shape[1]
    mean = [totals[-1 - i] / n for i in range(count)]
    exact = dict(zip(_pairs(count), (totals[k] for k in range(count * (count + 1) // 2)), strict=True))
    own = [exact[i, i] / n - mean[i] ** 2 for i in range(count)]
    off = [abs(x - 1) for x in own]
    off += [abs((s / n - (mean[i] + mean[j]) ** 2 - own[i] - own[j]) / 2) for (i, j), s in exact.items() if i < j]
    return max(off)


def whiten(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """``vec_id, n, deviation, whitened, explained, identity_error``, a row per vector; two are arrays by component.

    Vectors that are null or hold null or non-finite entries are left out, and
    of the rest those that have not the most frequent length; empty vectors are
    never used.  ``explained`` is the same for all rows.  There are fewer than ``components`` where the vectors
    span fewer dimensions, and no rows where they span none, as with one vector
    or equal ones only.  Ids may be null and rows may repeat; each counts.
    """
    vectors = whole_vectors(rows, id_column, vector_column, scale, shift)
    schema = f"vec_id {dict(vectors.dtypes)['vec_id']}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    fitted = fit(vectors, components)
    if fitted is None or not fitted[1].project.shape[1]:
        return rows.sparkSession.createDataFrame([], schema)
    size, whitener = fitted
    error = identity_error(vectors, size, whitener)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, ROWS):
                part = batch.slice(row, ROWS)
                values = _matrix(part.column("x"))
                made = whitener.whiten(values)
                bounds = pa.array(np.arange(len(made) + 1) * made.shape[1], pa.int32())
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": part.column("vec_id"),
                        "deviation": pa.array(whitener.deviations(values), pa.int64()),
                        "whitened": pa.ListArray.from_arrays(bounds, pa.array(made.ravel())),
                    }
                )

    kind = dict(vectors.dtypes)["vec_id"]
    made = vectors.where(F.size("x") == size).mapInArrow(project, f"vec_id {kind}, deviation long, whitened array<double>")
    return made.select(
        "vec_id", F.lit(whitener.n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*[F.lit(float(e)) for e in whitener.explained]).alias("explained"), F.lit(error).alias("identity_error"),
    )
