"""Whitening of embeddings by spectrum slicing.

Entries become integers, so that sums and products over all vectors are exact whatever the order Spark adds them in.
The covariance's leading eigenvalues are isolated by counting: the signs of the blocks D of an LDLᵀ factorisation of
the shifted matrix tell how many eigenvalues lie above the shift. From inside an isolating slice Rayleigh quotient
iteration converges cubically; where it would leave the slice, the slice is halved first. In the end counts on both
sides of every eigenvalue certify its number.

What the driver holds is bounded by the dimension: sums, the covariance and its components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import column

# How entries become integers, and how many components are returned at most.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Entries with this magnitude after scaling have no exact integer in a double; they count as non-finite.
LARGEST = 2.0**52
BLOCK_ROWS = 4_096
EPSILON = np.finfo(float).eps
# The choice of pivots that bounds growth in LDLᵀ.
PIVOT = (1 + 17**0.5) / 8


# ---- spectrum of a symmetric matrix -----------------------------------------------------------------


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie above ``shift``: the positive ones of D in LDLᵀ of the shifted matrix.

    Pivots are single numbers, or blocks of two that have one eigenvalue on each side of zero.
    """
    rest = matrix - shift * np.eye(len(matrix))
    count = 0
    while len(rest):
        own = np.abs(np.diagonal(rest))
        beside = np.abs(rest)
        np.fill_diagonal(beside, -1.0)
        p, flat = int(own.argmax()), int(beside.argmax())
        most = beside.flat[flat]
        if own[p] >= PIVOT * most:
            if own[p] == 0:
                break
            chosen = [p]
            count += rest[p, p] > 0
        else:
            chosen = list(divmod(flat, len(rest)))
            count += 1
        others = np.setdiff1d(np.arange(len(rest)), chosen)
        cross = rest[np.ix_(others, chosen)]
        rest = rest[np.ix_(others, others)] - cross @ np.linalg.solve(rest[np.ix_(chosen, chosen)], cross.T)
        rest = (rest + rest.T) / 2
    return int(count)


@dataclass
class Slice:
    """Eigenvalues in (low, high]; ``above_low`` and ``above_high`` are the counts at its ends."""

    low: float
    high: float
    above_low: int
    above_high: int

    @property
    def size(self) -> int:
        return self.above_low - self.above_high

    @property
    def middle(self) -> float:
        return (self.low * self.high) ** 0.5 if self.high > 4 * self.low > 0 else (self.low + self.high) / 2

    def halves(self, matrix: np.ndarray) -> list[Slice]:
        """The parts above and below the middle that hold eigenvalues, the higher one first."""
        middle = self.middle
        above = min(max(count_above(matrix, middle), self.above_high), self.above_low)
        parts = [Slice(middle, self.high, above, self.above_high), Slice(self.low, middle, self.above_low, above)]
        return [part for part in parts if part.size]


def isolated(matrix: np.ndarray, wanted: int, least: float, resolution: float) -> list[Slice]:
    """Slices with one eigenvalue each, highest first, that hold the ``wanted`` leading ones.

    Eigenvalues closer than ``resolution`` stay together in one slice.
    """
    high = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-12)
    todo, done = [Slice(least, high, count_above(matrix, least), 0)], []
    while todo:
        first = todo.pop(0)
        if first.size and first.above_high < wanted:
            if first.size == 1 or first.high - first.low <= resolution:
                done.append(first)
            else:
                todo = first.halves(matrix) + todo
    return done


def solved(matrix: np.ndarray, shift: float, right: np.ndarray, nudge: float) -> np.ndarray:
    for attempt in range(3):
        try:
            out = np.linalg.solve(matrix - (shift + attempt * nudge) * np.eye(len(matrix)), right)
            if np.isfinite(out).all():
                return out
        except np.linalg.LinAlgError:
            pass
    return right


def refined(matrix: np.ndarray, part: Slice, random: np.random.Generator, resolution: float) -> tuple[float, np.ndarray]:
    """The eigenvalue of an isolating slice and its unit vector, by Rayleigh quotient iteration kept inside the slice."""
    while True:
        slack = resolution if part.high - part.low <= resolution else 0.0
        vector = solved(matrix, part.middle, random.standard_normal(len(matrix)), resolution)
        vector /= np.linalg.norm(vector)
        best, before = None, np.inf
        while True:
            value = float(vector @ matrix @ vector)
            error = float(np.linalg.norm(matrix @ vector - value * vector))
            inside = part.low - slack <= value <= part.high + slack
            if not inside or error >= before:
                break
            best, before = (value, vector), error
            vector = solved(matrix, value, vector, resolution)
            vector /= np.linalg.norm(vector)
        if best is not None and (before <= resolution or slack):
            return best
        if slack:
            return float(vector @ matrix @ vector), vector
        part = part.halves(matrix)[0]


def together(matrix: np.ndarray, part: Slice, random: np.random.Generator, resolution: float) -> list[tuple[float, np.ndarray]]:
    """Eigenvalues that double precision does not tell apart: any orthonormal basis of their space."""
    basis = random.standard_normal((len(matrix), part.size))
    for _ in range(4):
        basis = np.linalg.qr(solved(matrix, part.middle, basis, resolution))[0]
    return [(float(v @ matrix @ v), v) for v in basis.T]


def leading(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``wanted`` leading eigenvalues of a covariance, falling, and their unit vectors as columns.

    Eigenvalues that are zero up to rounding have none. A vector's largest entry is positive.
    """
    size = len(matrix)
    norm = float(np.abs(matrix).sum(axis=1).max()) if size else 0.0
    if norm == 0:
        return np.empty(0), np.empty((size, 0))
    resolution = 8 * size * EPSILON * norm
    random = np.random.default_rng(41)
    found: list[tuple[float, np.ndarray]] = []
    for part in isolated(matrix, wanted, resolution, resolution):
        if part.size == 1:
            found.append(refined(matrix, part, random, resolution))
        else:
            found += together(matrix, part, random, resolution)
    found = sorted(found, key=lambda pair: -pair[0])[:wanted]
    values = np.array([value for value, _ in found])
    vectors = np.empty((size, len(found)))
    for i, (_, vector) in enumerate(found):
        vector = vector - vectors[:, :i] @ (vectors[:, :i].T @ vector)
        vector /= np.linalg.norm(vector)
        vectors[:, i] = vector * np.sign(vector[np.abs(vector).argmax()])
    certify(matrix, values, resolution)
    return values, vectors


def certify(matrix: np.ndarray, values: np.ndarray, resolution: float) -> None:
    """Counts show that eigenvalue number i is where it was found: fewer than i lie above it, at least i from it on."""
    for i, value in enumerate(values.tolist(), 1):
        if count_above(matrix, value + 4 * resolution) >= i or count_above(matrix, value - 4 * resolution) < i:
            raise ArithmeticError(f"eigenvalue {i} is not certified at {value}")


# ---- over all vectors -------------------------------------------------------------------------------


def valid_vectors(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``id`` and ``vector`` (doubles) of rows without null or non-finite entries."""
    vectors = rows.select(column(id_column).alias("id"), column(vector_column).cast("array<double>").alias("vector"))
    entry_fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST / SCALE)
    return vectors.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", entry_fits))


def blocks(batches: Iterator[pa.RecordBatch], shift: np.ndarray | None = None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integer vectors, less ``shift``, of some rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
            whole = np.floor(SCALE * flat).astype(np.int64).reshape(part.num_rows, -1) + SHIFT
            yield part.column("id"), whole if shift is None else whole - shift


def exact_products(block: np.ndarray) -> np.ndarray:
    """``blockᵀ block`` in integers: in doubles as far as these are exact, in Python's integers beyond."""
    largest = int(np.abs(block).max(initial=0))
    rows = 2**53 // max(1, largest * largest)
    if rows == 0:
        return block.astype(object).T @ block.astype(object)
    parts = [block[i : i + rows].astype(float) for i in range(0, len(block), rows)]
    total = sum(((p.T @ p).astype(np.int64).astype(object) for p in parts), np.zeros((block.shape[1],) * 2, object))
    return total


def added_up(rows: DataFrame, run) -> dict[int, tuple[int, int]]:
    """Exact sums by place over all partitions; as many places as ``run`` has for one partition."""
    partial = rows.mapInArrow(run, "place long, n long, amount decimal(38,0)")
    return {r.place: (r.n, int(r.amount)) for r in partial.groupBy("place").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount")).collect()}


def as_partial(amounts: list[int], n: int) -> pa.RecordBatch:
    columns = [pa.array(range(len(amounts)), pa.int64()), pa.array([n] * len(amounts), pa.int64()), pa.array(map(Decimal, amounts), pa.decimal128(38, 0))]
    return pa.RecordBatch.from_arrays(columns, ["place", "n", "amount"])


def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = None, 0
    for _, block in blocks(batches):
        own = block.astype(object).sum(axis=0) if np.abs(block).max(initial=0) > 2**40 else block.sum(axis=0).astype(object)
        total, n = own if total is None else total + own, n + len(block)
    if n:
        yield as_partial(total.tolist(), n)


def products_about(shift: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for _, block in blocks(batches, shift):
            own = exact_products(block)
            total, n = own if total is None else total + own, n + len(block)
        if n:
            yield as_partial(total[np.triu_indices(len(shift))].tolist(), n)

    return run


@dataclass(frozen=True)
class Whitener:
    """What whitens a vector: integer centre, exact rest of the mean, components and eigenvalues.

    ``centre`` and ``rest`` give the mean as ``centre + rest / n``.
    """

    n: int
    centre: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whitened(self, block: np.ndarray) -> np.ndarray:
        """Components of integer vectors from which the centre was taken."""
        return (block - self.rest / self.n) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, block: np.ndarray) -> list[int | None]:
        """The sum of (n * x - S)**2 of each vector; null if no long holds it."""
        fits = (int(np.abs(block).max(initial=0)) * self.n + int(np.abs(self.rest).max(initial=0))) ** 2 * block.shape[1] < 2**63
        kind = np.int64 if fits else object
        away = self.n * block.astype(kind) - self.rest.astype(kind)
        return [int(x) if x < 2**63 else None for x in (away * away).sum(axis=1).tolist()]


def fit(vectors: DataFrame, dimension: int, components: int = COMPONENTS) -> Whitener:
    """Mean and covariance over all vectors, exact, and the leading components of the covariance."""
    found = added_up(vectors, sums)
    n = found[0][0]
    total = [found[i][1] for i in range(dimension)]
    centre = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
    rest = [s - n * int(c) for s, c in zip(total, centre)]
    products = added_up(vectors, products_about(centre))
    covariance = np.zeros((dimension, dimension))
    for place, (i, j) in enumerate(zip(*(x.tolist() for x in np.triu_indices(dimension)))):
        covariance[i, j] = covariance[j, i] = (n * products[place][1] - rest[i] * rest[j]) / (n * n)
    values, components_ = leading(covariance, components)
    return Whitener(n, centre, np.array(rest, np.int64), values, components_, float(np.trace(covariance)))


def covariance_error(vectors: DataFrame, whitener: Whitener) -> float:
    """The largest absolute entry of the whitened vectors' covariance less the identity, measured over all of them."""
    size = len(whitener.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for _, block in blocks(batches, whitener.centre):
            own = whitener.whitened(block)
            total[:size] += own.T @ own
            total[size] += own.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int64()), pa.array(total.ravel())], ["place", "amount"])

    partial = vectors.mapInArrow(run, "place long, amount double").groupBy("place").agg(F.sum("amount").alias("amount"))
    total = np.zeros(size * (size + 1))
    for row in partial.collect():
        total[row.place] = row.amount
    total = total.reshape(size + 1, size) / whitener.n
    return float(np.abs(total[:size] - np.outer(total[size], total[size]) - np.eye(size)).max(initial=0))


def whiten(rows: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """A row for each vector and leading component: ``vec_id``, ``component`` (from 1, by falling eigenvalue), ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    Vectors that are null or empty, or have null or non-finite entries, are left out; so are entries so large that
    doubles have no 64ths there. A vector shorter than the longest has null entries. Components whose eigenvalue is
    zero up to rounding have no rows, so a table of equal vectors or a single one gives none, as an empty table does.
    Repeated rows and ids count each. ``deviation`` is null where no long holds it. Other columns are not read.
    """
    spark = rows.sparkSession
    valid = valid_vectors(rows, id_column, vector_column)
    kind = valid.schema["id"].dataType
    schema = f"vec_id {kind.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    dimension = valid.agg(F.max(F.size("vector"))).first()[0]
    if dimension is None:
        return spark.createDataFrame([], schema)
    valid = valid.where(F.size("vector") == dimension)
    whitener = fit(valid, dimension, components)
    size = len(whitener.values)
    if not size:
        return spark.createDataFrame([], schema)
    error, explained = covariance_error(valid, whitener), whitener.values / whitener.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in blocks(batches, whitener.centre):
            count = len(block)
            each = pa.array(np.repeat(np.arange(count), size))
            columns = [
                ids.take(each),
                pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), count)),
                pa.array(np.full(count * size, whitener.n)),
                pa.array(whitener.deviations(block), pa.int64()).take(each),
                pa.array(whitener.whitened(block).ravel()),
                pa.array(np.tile(explained, count)),
                pa.array(np.full(count * size, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in schema.split(", ")])

    return valid.mapInArrow(run, schema)
