"""Whitening of embeddings: principal components from exact variances of dimensions and of sums of two dimensions.

Entries become whole numbers, STEPS to a unit. The mean of each dimension is rounded down to a whole number m; what is left of it
is kept as a remainder, so the centred values x - m are whole, small and exact. One pass over the distinct vectors adds up the
squares of every centred dimension and of every sum of two of them. By polarisation a covariance is half of what the variance
of the sum exceeds the two variances by; the remainders are taken off in whole numbers of any length, and only the
last division rounds. The matrix, dimensions by dimensions, goes through eigh on the driver.

Sizes: a task holds BATCH rows, and one number for each pair of dimensions; the driver gets one number for each pair. Vectors
are never collected. The distinct vectors are written once and read for the means, the squares and the check of the result.

Defined cases: rows with a null vector, or with entries that are null or not finite, are dropped; shorter vectors end in zeros,
up to the longest; entries beyond a long's range count as its end; equal rows count once in the fit and come out as often as
they went in. Without rows nothing comes out. Components without variance have whitened 0.0 and explained 0.0, and do not count
for identity_error. A deviation beyond a long's range is null.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from pavilion.session import materialize

STEPS, COMPONENTS, BATCH = 256, 4, 512
# Squares are handed on in parts of so many bits each, so that sums of any number of tasks are exact.
LIMB, LIMBS = 48, 3
# Below this share of the trace, a component's variance is what rounding leaves of none.
NOTHING = 1e-13


def whole_vectors(vectors: DataFrame, vector="embedding") -> DataFrame:
    """vec_id and x, the entries as whole numbers, of the rows that have a vector of finite entries."""
    finite = ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * STEPS).cast("long"))
    return vectors.filter(F.col(vector).isNotNull() & finite).select("vec_id", x.alias("x"))


def blocks(batch, column: int, width: int):
    """(start, matrix) of parts of a batch, rows filled up with zeros."""
    for start in range(0, batch.num_rows, BATCH):
        part = batch.column(column).slice(start, BATCH)
        lengths = pc.list_value_length(part).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        out = np.zeros((len(part), width), np.int64)
        out[np.arange(width) < lengths[:, None]] = flat
        yield start, out


@dataclass
class Means:
    """n distinct vectors, the sums of their dimensions, and the sums as n times whole means and remainders."""

    n: int
    sums: list[int]

    @property
    def whole(self):
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def left(self):
        return [s % self.n for s in self.sums]


def means(fit: DataFrame) -> Means | None:
    """One number for each dimension reaches the driver."""
    sized = fit.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width")).first()
    if not sized.n:
        return None
    width = sized.width

    def add(batches):
        total = [0] * width
        for batch in batches:
            for _, x in blocks(batch, 0, width):
                # Halves of 32 bits cannot overflow within a block.
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                total = [t + (h << 32) + lo for t, h, lo in zip(total, high.tolist(), low.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(map(str, total))], names=["dimension", "total"])

    parts = fit.mapInArrow(add, "dimension int, total string")
    rows = parts.groupBy("dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    totals = {r.dimension: int(r.total) for r in rows}
    return Means(sized.n, [totals[d] for d in range(width)])


def pair_squares(fit: DataFrame, mean: Means) -> dict:
    """(i, j) -> the exact sum of squares of centred dimension i, or of the sum of i and j where they differ."""
    whole, width = mean.whole, len(mean.sums)
    first, second = np.triu_indices(width)

    def add(batches):
        total = np.zeros(len(first), object)
        for batch in batches:
            for _, x in blocks(batch, 0, width):
                z = x - whole
                # Where squares of a block could leave 64 bits, Python's whole numbers do the same.
                z = z if np.abs(z).max(initial=0) < 2**26 else z.astype(object)
                squares = []
                for i in range(width):
                    sums = z[:, i, None] + z[:, i:]
                    sums[:, 0] = z[:, i]
                    squares.append((sums * sums).sum(axis=0))
                total += np.concatenate(squares)
        limbs = [pa.array([t >> LIMB * k & (1 << LIMB) - 1 if k < LIMBS - 1 else t >> LIMB * k for t in total.tolist()], pa.int64()) for k in range(LIMBS)]
        yield pa.RecordBatch.from_arrays([pa.array(first, pa.int32()), pa.array(second, pa.int32()), *limbs], names=names)

    names = ["i", "j", *[f"limb_{k}" for k in range(LIMBS)]]
    parts = fit.mapInArrow(add, ", ".join(["i int", "j int", *[f"{n} long" for n in names[2:]]]))
    rows = parts.groupBy("i", "j").agg(*[F.sum(F.col(n).cast("decimal(38,0)")).alias(n) for n in names[2:]]).collect()
    return {(r.i, r.j): sum(int(r[n]) << LIMB * k for k, n in enumerate(names[2:])) for r in rows}


def covariance(mean: Means, squares: dict) -> np.ndarray:
    """By polarisation, in whole numbers of n * n units up to the last division."""
    n, left, width = mean.n, mean.left, len(mean.sums)
    # n * n times a variance: the sum of squares about m, less what m is off the mean by.
    own = [n * squares[i, i] - left[i] ** 2 for i in range(width)]
    out = np.zeros((width, width))
    for i in range(width):
        out[i, i] = own[i] / n**2
        for j in range(i + 1, width):
            of_sum = n * squares[i, j] - (left[i] + left[j]) ** 2
            out[i, j] = out[j, i] = (of_sum - own[i] - own[j]) / (2 * n**2)
    return out


@dataclass
class Whitening:
    mean: Means
    components: np.ndarray  # one a row
    variances: np.ndarray
    explained: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values of a block of whole vectors, a column a component."""
        centred = (x - self.mean.whole) - np.array([r / self.mean.n for r in self.mean.left])
        some = self.variances > 0
        scale = np.where(some, 1 / np.sqrt(np.where(some, self.variances, 1)), 0.0)
        return centred @ self.components.T * scale

    def deviations(self, x: np.ndarray) -> list:
        """The sum over dimensions of (n * x - sum) squared, exact, or None beyond a long's range."""
        n, left = self.mean.n, np.array(self.mean.left, object)
        z = x - self.mean.whole
        most = int(np.abs(z).max(initial=0)) * n + max(self.mean.left, default=0)
        exact = (z * n - left.astype(np.int64)) if most**2 * max(x.shape[1], 1) < 2**63 else (z.astype(object) * n - left)
        return [d if d < 2**63 else None for d in (exact * exact).sum(axis=1).tolist()] if x.shape[1] else [0] * len(x)


def whitening(mean: Means, squares: dict, components=COMPONENTS) -> Whitening:
    matrix = covariance(mean, squares)
    values, vectors = np.linalg.eigh(matrix)
    trace = float(np.trace(matrix))
    order = np.argsort(-values, kind="stable")[:components]
    values = np.where(values[order] > NOTHING * trace, values[order], 0.0)
    return Whitening(mean, vectors.T[order], values, values / trace if trace > 0 else np.zeros(len(values)))


def identity_error(fit: DataFrame, fitted: Whitening) -> float:
    """The largest entry, without its sign, of the fit list's whitened covariance less the identity, measured on the rows.

    Whitened values are centred, so their products may be added up as they are; a task hands on one number for each two components.
    """
    some = np.flatnonzero(fitted.variances > 0)
    k, width = len(some), len(fitted.mean.sums)
    if not k:
        return 0.0

    def measure(batches):
        # The sums of the components stand in the last row.
        total = np.zeros((k + 1, k))
        for batch in batches:
            for _, x in blocks(batch, 0, width):
                w = fitted.project(x)[:, some]
                total += np.vstack([w.T @ w, w.sum(axis=0)])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "total"])

    parts = fit.mapInArrow(measure, "i long, j long, total double")
    total = np.zeros((k + 1, k))
    for row in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        total[row.i, row.j] = row.total
    average = total[k] / fitted.mean.n
    return float(np.abs(total[:k] / fitted.mean.n - np.outer(average, average) - np.eye(k)).max())


def whiten(vectors: DataFrame, vector="embedding", components=COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, a row for each kept vector and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, vector)
    fit = materialize(rows.select("x").distinct(), "vectors")
    mean = means(fit)
    if mean is None or not mean.sums:
        return spark.createDataFrame([], schema)
    fitted = whitening(mean, pair_squares(fit, mean), components)
    error = identity_error(fit, fitted)
    shared = spark.sparkContext.broadcast(fitted)

    def score(batches):
        own = shared.value
        k = len(own.explained)
        for batch in batches:
            for start, x in blocks(batch, 1, len(own.mean.sums)):
                ids = batch.column(0).slice(start, BATCH)
                each = np.repeat(np.arange(len(x)), k)
                columns = [
                    ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(each), own.mean.n), pa.int64()), pa.array(own.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(own.project(x).ravel()), pa.array(np.tile(own.explained, len(x))), pa.array(np.full(len(each), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(score, schema)
