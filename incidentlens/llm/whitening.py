"""Whitening of embeddings by exact integer moments (operator 13).

An entry c becomes the integer x = floor(1024 * c) + 100000. For blocks of rows every
dimension's x, less its least value in the block, is cut into bit planes, and each plane
is packed across the rows into words of 64 bits. The sum of x_i * x_j over a block is
then a weighted sum of the bits that two planes have in common, corrected for the shifts:
exact, and without a product per row. Tasks add up their blocks and send one number for
each pair of dimensions; n^2 times the covariance, n * sum(x_i * x_j) - S_i * S_j, is an
integer too, and becomes a double only for the eigenvectors. Rows are projected in a second pass.

Defined results: a row goes if its vector is NULL or empty, has an entry that is NULL, not
finite or beyond 2^53 / 1024, or a length other than the commonest (of equally common ones
the longest). Repeated rows count as often as they occur, also those without an id. A
component without variance (up to rounding) has ``explained`` 0 and no whitened value, and
doesn't count in the identity error, which is NULL if no component has variance. A
``deviation`` beyond a long is NULL. An empty table gives no rows. Further columns are not
looked at. What reaches the driver is one number per pair of dimensions.
"""

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentlens.sources.scratch import materialise

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
BLOCK_ROWS = 4096
_LARGEST = 2.0**53 / SCALE
_MOMENTS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("value", pa.decimal128(38, 0))])
_SCORED = pa.schema(
    [("vec_id", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))]
)


def _usable(vector: Column) -> Column:
    entries = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < _LARGEST))
    return F.coalesce((F.size(vector) > 0) & entries, F.lit(False))


def fit_list(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The vectors that count, as ``vec_id`` and ``vector`` (doubles), all of one length."""
    rows = embeddings.select(
        F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    ).where(_usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("size")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size("vector") == (first["size"] if first else 0))


def _integers(vectors: pa.Array) -> np.ndarray:
    """The x of vectors of one length, a row each."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(len(vectors), -1) + OFFSET


def _slices(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(start, BLOCK_ROWS)


def bit_planes(shifted: np.ndarray) -> np.ndarray:
    """Planes of non-negative integers by dimension and bit, packed across the rows in words."""
    rows, dims = shifted.shape
    bits = max(1, int(shifted.max(initial=0)).bit_length())
    planes = np.zeros((dims, bits, -(-rows // 64) * 8), np.uint8)
    for bit in range(bits):
        packed = np.packbits((shifted >> bit & 1).astype(np.uint8), axis=0)
        planes[:, bit, : len(packed)] = packed.T
    return planes.view(np.uint64)


def cross_products(planes: np.ndarray) -> list[list[int]]:
    """Sums of products of dimensions i <= j, from the bits that their planes share."""
    dims, bits, _ = planes.shape
    weights = [1 << bit for bit in range(2 * bits - 1)]
    found = []
    for i in range(dims):
        shared = np.zeros((dims - i, 2 * bits - 1), np.int64)
        for bit in range(bits):
            both = np.bitwise_count(planes[i, bit] & planes[i:])
            shared[:, bit : bit + bits] += both.sum(axis=2, dtype=np.int64)
        found.append([sum(map(int.__mul__, weights, row)) for row in shared.tolist()])
    return found


class Moments:
    """Number of rows, sums and sums of products, as integers of any size."""

    def __init__(self):
        self.count, self.sums, self.products = 0, None, None

    def add(self, x: np.ndarray) -> None:
        least = x.min(axis=0)
        planes = bit_planes(x - least)
        rows, shifts = len(x), least.tolist()
        # A dimension's sum is that of its planes' bits.
        ones = np.bitwise_count(planes).sum(axis=2, dtype=np.int64).tolist()
        above = [sum(n << bit for bit, n in enumerate(row)) for row in ones]
        products = [
            [p + shifts[i] * above[j] + shifts[j] * above[i] + rows * shifts[i] * shifts[j] for j, p in enumerate(row, i)]
            for i, row in enumerate(cross_products(planes))
        ]
        sums = [a + rows * s for a, s in zip(above, shifts, strict=True)]
        if self.count:
            sums = [a + b for a, b in zip(self.sums, sums, strict=True)]
            products = [
                [a + b for a, b in zip(one, two, strict=True)]
                for one, two in zip(self.products, products, strict=True)
            ]
        self.count, self.sums, self.products = self.count + rows, sums, products

    def rows(self):
        """(i, j, value): the sum of products for i <= j; (i, -1) the sum; (-1, -1) the count."""
        yield -1, -1, self.count
        for i, row in enumerate(self.products):
            yield i, -1, self.sums[i]
            for j, value in enumerate(row, i):
                yield i, j, value


def _moments(batches):
    found = Moments()
    for part in _slices(batches):
        if part.num_rows:
            found.add(_integers(part.column(0)))
    if found.count:
        i, j, values = zip(*found.rows(), strict=True)
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(map(Decimal, values), _MOMENTS[2].type)]
        yield pa.RecordBatch.from_arrays(columns, schema=_MOMENTS)


@dataclass(frozen=True)
class Whitening:
    """Number and sums of the fit list, and its components with the variance along each."""

    count: int
    sums: list[int]
    components: np.ndarray  # a column each, by falling variance
    variances: np.ndarray
    trace: float

    def used(self, most: int) -> list[bool]:
        """Which of the first components have variance."""
        least = len(self.sums) * np.finfo(float).eps * max(self.variances.max(initial=0.0), 0.0)
        return [bool(e > least) for e in self.variances[:most]]

    def explained(self, most: int) -> list[float]:
        parts = zip(self.variances[:most].tolist(), self.used(most), strict=True)
        return [e / self.trace if used else 0.0 for e, used in parts]


def fitted(vectors: DataFrame) -> Whitening | None:
    """The whitening of what :func:`fit_list` returns; None without rows."""
    parts = vectors.select("vector").mapInArrow(_moments, "i int, j int, value decimal(38,0)")
    values = {(r["i"], r["j"]): int(r["value"]) for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    if not values:
        return None
    count = values.pop((-1, -1))
    dims = 1 + max(i for i, _ in values)
    sums = [values[i, -1] for i in range(dims)]
    covariance = np.empty((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            # Integers of any size; their quotient is rounded once.
            covariance[i, j] = covariance[j, i] = (count * values[i, j] - sums[i] * sums[j]) / count**2
    variances, components = np.linalg.eigh(covariance)
    components = components[:, ::-1] * np.sign(components[np.abs(components).argmax(axis=0), range(dims)])[::-1]
    return Whitening(count, sums, components, variances[::-1].copy(), float(np.trace(covariance)))


def _squared(deviations: np.ndarray) -> list[int | None]:
    """Exact sums of squares by row; None where a long can't hold one."""
    about = np.square(deviations.astype(float)).sum(axis=1)
    if about.max(initial=0.0) < 2.0**62:
        return np.square(deviations).sum(axis=1).tolist()
    exact = [sum(d * d for d in row) for row in deviations.tolist()]
    return [value if value < 2**63 else None for value in exact]


def _projected(fit: Whitening, most: int):
    used = fit.used(most)
    axes = fit.components[:, : len(used)] / np.sqrt(np.where(used, fit.variances[: len(used)], np.inf))
    largest = max(map(abs, fit.sums)) + fit.count * (2**53 + OFFSET)
    kind = np.int64 if largest < 2**62 else object

    def project(batches):
        for part in _slices(batches):
            x = _integers(part.column(1)).astype(kind)
            deviations = fit.count * x - np.array(fit.sums, kind)
            whitened = (deviations / fit.count).astype(float) @ axes
            values = [[v if ok else None for v, ok in zip(row, used, strict=True)] for row in whitened.tolist()]
            columns = [part.column(0), _squared(deviations), values]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCORED, strict=True)], schema=_SCORED)

    return project


def whitened(vectors: DataFrame, fit: Whitening, most: int = COMPONENTS) -> DataFrame:
    """``vec_id``, ``deviation`` and the list ``whitened`` for vectors of the fit's length."""
    return vectors.select("vec_id", "vector").mapInArrow(
        _projected(fit, most), "vec_id long, deviation long, whitened array<double>"
    )


def identity_error(scored: DataFrame, used: list[bool]) -> float | None:
    """The largest entry of the whitened values' covariance minus the identity."""
    axes = [i for i, ok in enumerate(used) if ok]
    pairs = [(i, j) for i in axes for j in axes if i <= j]
    if not pairs:
        return None
    sums = scored.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) for i, j in pairs]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(sums, pairs, strict=True))


def by_component(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """A row per vector and component, with the fit's measures."""
    vectors = fit_list(embeddings)
    fit = fitted(vectors)
    spark = embeddings.sparkSession
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    if fit is None:
        return spark.createDataFrame([], schema)
    scored = materialise(whitened(vectors, fit, most), "whitened")
    error = F.lit(identity_error(scored, fit.used(most))).cast("double")
    explained = F.array(*map(F.lit, fit.explained(most)))
    exploded = scored.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return exploded.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fit.count).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        error.alias("identity_error"),
    )
