"""Embedding near-duplicates as an exact metric range join.

Vectors are compared by angle, which obeys the triangle inequality. Pivots bring vectors that lie together into the
same blocks, each of which is stored once with its centre and the largest angle to it, its radius. With ``reach`` the
angle of the threshold, two blocks can only hold a link if their centres are at most both radii plus ``reach`` apart,
and a vector only links into a block whose centre is at most the radius plus ``reach`` away. Such blocks are paired by
a product that reads them where they are stored: no vector is shuffled or copied to be compared, and each pair of
blocks is compared once. Few coordinates along the widest axes rule out most pairs of vectors before all are used.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components, stored
from tidemark.session import column

THRESHOLD = 0.9
# Vectors a pivot is taken for, and pivots at most; both only decide how the work is dealt.
CELL_VECTORS, MOST_PIVOTS = 4_096, 1_024
# Vectors of a block at most, and bytes of their components.
HOMES, BLOCK_BYTES = 4_096, 1 << 20
# Bytes of blocks a partition is wanted to have; a task pairs two partitions.
PART_BYTES = 32 << 20
# Vectors are put into blocks in rounds of so many bytes, and in so many rounds at most: a round's shuffle files go with it.
ROUND_BYTES, MOST_ROUNDS = 32 << 20, 8
# Rows and columns of a block that are compared together.
HOSTS, VISITORS = 256, 2_048
# Bytes of prepared blocks a worker remembers, and of blocks it is sent at once.
REMEMBERED, SENT = 160 << 20, 16 << 20
# Vectors that tell which axes are wide; any choice gives the same links.
SAMPLE = 1_024
# What a pair costs for each coordinate multiplied, and what it costs to look at by itself, in nanoseconds as measured.
COORDINATE_NS, PAIR_NS = 0.04, 600
# Added to bounds, so that rounding of angles loses nothing.
SLACK = 1e-6
# Rows of blocks are large: a row group is looked at after every row.
BLOCK_FILES = {"parquet.enable.dictionary": "false", "parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
BLOCK = "first long, center array<double>, radius double, nodes binary, copies binary, vectors binary"


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Id and components as floats if they are such, else as doubles; null where a vector takes no part."""
    kind = vectors.select(column(vector_column)).dtypes[0][1]
    values = column(vector_column).cast(kind if kind == "array<float>" else "array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists(values, lambda x: x != 0)
    return vectors.select(column(id_column).alias("vec_id"), F.when(finite, values).alias("vector"))


def hashes() -> list[Column]:
    """128 bits that stand in for a vector in joins."""
    return [F.xxhash64("vector"), F.xxhash64(F.lit(1), "vector")]


def of_length_one(rows: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that no square overflows or vanishes."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def unit(batch: pa.RecordBatch, name: str = "vector") -> np.ndarray:
    """Rows of length one."""
    return of_length_one(batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


def at_home(pivots: np.ndarray):
    """``cell``, the nearest pivot, of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 1_024):
                batch = whole.slice(low, 1_024)
                cell = (unit(batch) @ pivots.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], [*batch.schema.names, "cell"])

    return run


def in_blocks(size: int):
    """Rows come by cell. Blocks of at most ``size`` vectors; one ends where a cell does if it has a quarter of that."""

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = unit(batch)
        center = rows.sum(axis=0)
        length = np.linalg.norm(center)
        center = center / length if length > 1e-6 * len(rows) else rows[0]
        nodes, copies = batch.column("node").to_numpy(), batch.column("copies").to_numpy()
        kept = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
        values = [int(nodes[0]), center.tolist(), float(angles(rows @ center).max()), nodes.tobytes(), copies.tobytes(), kept.tobytes()]
        kinds = [pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], ["first", "center", "radius", "nodes", "copies", "vectors"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            cell, low = batch.column("cell").to_numpy(), 0
            while low < len(cell):
                edges = np.flatnonzero(np.diff(cell[low : low + size])) + 1
                ends = edges[edges >= size // 4]
                if not len(ends) and len(cell) - low < size:
                    break
                high = low + (int(ends[0]) if len(ends) else size)
                yield block(batch.slice(low, high - low))
                low = high
            rest = batch.slice(low) if low < len(cell) else None
        if rest is not None:
            yield block(rest)

    return run


def positions(flags: np.ndarray, size: int) -> np.ndarray:
    """Of the few that are set among the first ``size``; flags are looked at eight at a time, and hold seven more."""
    flags[size : size + 7] = False
    eights = flags[: -(-size // 8) * 8]
    some = np.flatnonzero(eights.view(np.uint64) != 0)
    row, at = np.nonzero(eights.reshape(-1, 8)[some])
    return some[row] * 8 + at


class Sketch:
    """Few coordinates of a vector, such that a product of two rows is at least the cosine.

    With ``u`` and ``v`` counted from the middle, cos = 1 - |u - v|²/2, and |u - v|² is at least the squared distance
    along some axes plus that of the lengths of what is left. Without axes the rows are the vectors themselves.
    """

    def __init__(self, sample: np.ndarray, threshold: float):
        fitted, others, dims = sample[::2], sample[1::2], sample.shape[1]  # axes look better to the vectors they are fitted on
        self.middle, self.axes = fitted.mean(axis=0), None
        moved = fitted - self.middle
        axes = np.linalg.eigh(moved.T @ moved)[1][:, ::-1] if dims <= SAMPLE else np.eye(dims)
        best, least = None, COORDINATE_NS * dims
        for count in sorted({round(4 * 1.25**i) for i in range(40)}):
            if count + 3 < dims and len(others) >= 32:
                self.axes = axes[:, :count]
                seen = (self.rows(others, True) @ self.rows(others, False).T >= threshold - self.error(dims)).sum() - len(others)
                cost = COORDINATE_NS * (count + 3) + PAIR_NS * seen / (len(others) * (len(others) - 1))
                if cost < least:
                    best, least = self.axes, cost
        self.axes = best

    def rows(self, units: np.ndarray, left: bool) -> np.ndarray:
        if self.axes is None:
            return units.astype(np.float32)
        moved = units - self.middle
        some, square = moved @ self.axes, (moved * moved).sum(axis=1)
        other = np.sqrt(np.maximum(square - (some * some).sum(axis=1), 0))
        half, one = 1 - square / 2, np.ones(len(units))
        return np.column_stack([some, other, half if left else one, one if left else half - 1]).astype(np.float32)

    def error(self, dims: int) -> float:
        """More than what single precision takes from a product."""
        return (dims + 16) * 2.0**-20


class Block:
    def __init__(self, batch: pa.RecordBatch, row: int, side: str, kind: type, sketch: Sketch):
        def value(name: str):
            return batch.column(f"{side}_{name}")[row]

        self.nodes = np.frombuffer(value("nodes").as_py(), np.int64)
        self.copies = np.frombuffer(value("copies").as_py(), np.int64).astype(np.float64)
        self.center, self.radius = np.array(value("center").as_py()), value("radius").as_py()
        self.units = of_length_one(np.frombuffer(value("vectors").as_py(), kind).reshape(len(self.nodes), -1))
        self.left = sketch.rows(self.units, True)
        self.right = self.left if sketch.axes is None else sketch.rows(self.units, False)
        self.bytes = self.units.nbytes + self.left.nbytes + self.right.nbytes + 2 * self.nodes.nbytes

    def within(self, other: Block, reach: float) -> np.ndarray:
        """Rows that may link into the other block."""
        return np.flatnonzero(angles(self.units @ other.center) <= other.radius + reach + SLACK)


class Tally:
    """Links of the nodes a task meets: how many each has, and a tree of what hangs together."""

    def __init__(self):
        self.start, self.nodes, self.counts, self.parent = {}, [], np.zeros(0), np.zeros(0, np.int64)

    def place(self, block: Block) -> int:
        first = int(block.nodes[0])
        if first not in self.start:
            self.start[first] = len(self.parent)
            self.nodes.append(block.nodes)
            self.counts = np.concatenate([self.counts, np.zeros(len(block.nodes))])
            self.parent = np.concatenate([self.parent, np.arange(len(self.parent), len(self.parent) + len(block.nodes))])
        return self.start[first]

    def roots(self, places: np.ndarray) -> np.ndarray:
        found = self.parent[places]
        while ((above := self.parent[found]) != found).any():
            found = above
        self.parent[places] = found
        return found

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        while len(left):
            left, right = self.roots(left), self.roots(right)
            apart = left != right
            left, right = left[apart], right[apart]
            np.minimum.at(self.parent, np.maximum(left, right), np.minimum(left, right))

    def pairs(self, hosts: np.ndarray, host_copies: np.ndarray, guests: np.ndarray, guest_copies: np.ndarray, both: bool) -> None:
        """Places that link, one pair each, and the copies at either."""
        np.add.at(self.counts, hosts, guest_copies)
        if both:
            np.add.at(self.counts, guests, host_copies)
        self.join(hosts, guests)

    def table(self, hosts: np.ndarray, host_copies: np.ndarray, guests: np.ndarray, guest_copies: np.ndarray, near: np.ndarray, both: bool) -> None:
        """The same from a table of hosts by guests."""
        weights = near.astype(np.float64)
        self.counts[hosts] += weights @ guest_copies
        if both:
            self.counts[guests] += host_copies @ weights
        met = np.concatenate([self.roots(hosts[near.any(axis=1)]), self.roots(guests[near.any(axis=0)])])
        if len(met) and (met != met[0]).any():
            row, at = np.nonzero(near)
            row, at = self.roots(hosts)[row], self.roots(guests)[at]
            some = np.unique((row << 32 | at)[row != at])
            self.join(some >> 32, some & 0xFFFFFFFF)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.nodes:
            return
        nodes, counts = np.concatenate(self.nodes), np.rint(self.counts).astype(np.int64)
        roots = self.roots(np.arange(len(nodes)))
        hang, some = np.flatnonzero(roots != np.arange(len(nodes))), np.flatnonzero(counts)
        a, b = np.concatenate([nodes[hang], nodes[some]]), np.concatenate([nodes[roots[hang]], np.full(len(some), -1)])
        links = np.concatenate([np.zeros(len(hang), np.int64), counts[some]])
        for low in range(0, len(a), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[low : low + 100_000]) for x in (a, b, links)], ["a", "b", "links"])


def compare(threshold: float, kind: type, sketch: Sketch):
    """Rows are pairs of blocks. Gives links (``a``, ``b``) and counts (``a``, null, ``links``), added up in the task."""
    reach = math.acos(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, known = Tally(), OrderedDict()
        product, mask = np.empty(HOSTS * VISITORS, np.float32), np.empty(HOSTS * VISITORS + 8, bool)

        def block(batch: pa.RecordBatch, row: int, side: str) -> Block:
            first = batch.column(f"{side}_first")[row].as_py()
            if first not in known:
                known[first] = Block(batch, row, side, kind, sketch)
                while len(known) > 2 and sum(x.bytes for x in known.values()) > REMEMBERED:
                    known.popitem(last=False)
            known.move_to_end(first)
            return known[first]

        def tile(a: Block, rows: np.ndarray, b: Block, columns: np.ndarray, left: np.ndarray, right: np.ndarray, both: bool) -> None:
            error, shape = sketch.error(a.units.shape[1]), (len(rows), len(columns))
            bounds, seen = product[: shape[0] * shape[1]].reshape(shape), mask[: shape[0] * shape[1]].reshape(shape)
            np.matmul(left, right.T, out=bounds)
            np.greater_equal(bounds, threshold - error, out=seen)
            count = np.count_nonzero(seen)
            if not count:
                return
            hosts, guests = tally.place(a) + rows, tally.place(b) + columns
            if count * 50 < seen.size:
                row, at = np.divmod(positions(mask, seen.size), shape[1])
                near = np.einsum("ij,ij->i", a.units[rows[row]], b.units[columns[at]]) >= threshold
                row, at = row[near], at[near]
                tally.pairs(hosts[row], a.copies[rows[row]], guests[at], b.copies[columns[at]], both)
                return
            if sketch.axes is not None:
                np.matmul(a.units[rows].astype(np.float32), b.units[columns].astype(np.float32).T, out=bounds)
            near = bounds >= threshold + error
            unsure = np.flatnonzero((bounds >= threshold - error) & ~near)
            for low in range(0, len(unsure), 65_536):  # these are decided in double precision
                row, at = np.divmod(unsure[low : low + 65_536], shape[1])
                near[row, at] = np.einsum("ij,ij->i", a.units[rows[row]], b.units[columns[at]]) >= threshold
            tally.table(hosts, a.copies[rows], guests, b.copies[columns], near, both)

        for batch in batches:
            for row in range(batch.num_rows):
                a, b = block(batch, row, "a"), block(batch, row, "b")
                both = a is not b
                rows, columns = a.within(b, reach), b.within(a, reach)
                if not len(rows) or not len(columns):
                    continue
                left, right = a.left[rows], b.right[columns]
                for top in range(0, len(rows), HOSTS):
                    for low in range(0, len(columns), VISITORS):
                        tile(a, rows[top : top + HOSTS], b, columns[low : low + VISITORS], left[top : top + HOSTS], right[low : low + VISITORS], both)
        yield from tally.rows()

    return run


@contextmanager
def small_batches(spark):
    """Rows with blocks reach Python few at a time."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(SENT))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id``, ``n_links`` and ``component_id`` of each row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different
    dimensions never link. Equal vectors are compared once and counted as many. Ids may repeat (each row counts) or
    be null; ``component_id`` is the smallest id reachable. Other columns are not read.
    """
    high, low = hashes()
    rows = usable(vectors, id_column, vector_column).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows.withColumns({"high": F.when(F.col("vector").isNotNull(), high), "low": F.when(F.col("vector").isNotNull(), low)}), "vectors")
    grouped = rows.where("vector IS NOT NULL").groupBy("vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.min("row").alias("node"))
    # A vector is known by one of its rows from here on, where it can be read.
    distinct = stored(grouped.select("node", "least", "copies", high.alias("high"), low.alias("low"), F.size("vector").alias("size")), "distinct")
    keys = ["high", "low"]
    if distinct.groupBy(*keys).count().where("count > 1").limit(1).count():  # two vectors share their hashes, so they are joined themselves
        keys = ["vector"]
        named = distinct.join(rows.select(F.col("row").alias("node"), "vector"), "node")
    else:
        named = distinct
    sizes = sorted(r[0] for r in distinct.select("size").distinct().collect())
    spark = distinct.sparkSession
    found = spark.createDataFrame([], "a long, b long, links long")
    for size in sizes:  # of dimensions, not of rows
        found = found.unionByName(linked(distinct.where(F.col("size") == size).select("node", "copies"), rows.select(F.col("row").alias("node"), "vector"), threshold))
    with small_batches(spark):
        found = stored(found, "near")
    counts = found.where("b = -1").groupBy("a").agg(F.sum("links").alias("all_links"))
    roots = components(found.where("b <> -1").select("a", "b"))
    classes = (
        named.join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .join(counts.withColumnRenamed("a", "node"), "node", "left")
        .select(*keys, "root", "least", F.greatest(F.coalesce("all_links", F.lit(0)), "copies").alias("all_links"))
    )
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    known = classes.join(least, "root").select(*keys, "component_id", (F.col("all_links") - 1).alias("n_links"))
    return rows.join(known, keys, "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))


def linked(nodes: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """Links and counts of ``nodes``, which are of one dimension; ``vectors`` has theirs and may have more."""
    reach, count, spark = math.acos(threshold), nodes.count(), nodes.sparkSession
    wanted = min(MOST_PIVOTS, max(1, math.ceil(count / CELL_VECTORS)))
    # Pivots are a bounded number of vectors, the first by a hash; any choice gives the same links.
    some = nodes.select("node").orderBy(F.xxhash64("node")).limit(max(wanted, SAMPLE))
    sampled = of_length_one(np.array([r.vector for r in vectors.join(F.broadcast(some), "node").collect()]))
    pivots, sketch = sampled[:wanted], Sketch(sampled, threshold)
    kind = dict(vectors.dtypes)["vector"]
    number = np.float32 if kind == "array<float>" else np.float64
    vector_bytes = sampled.shape[1] * np.dtype(number).itemsize
    # A task pairs two partitions, so that their number is about the root of that of tasks.
    parts = max(math.ceil(math.sqrt(16 * spark.sparkContext.defaultParallelism)), math.ceil(count * vector_bytes / PART_BYTES))
    rounds = min(MOST_ROUNDS, max(1, math.ceil(count * vector_bytes / ROUND_BYTES)))
    size = max(1, min(HOMES, BLOCK_BYTES // vector_bytes, math.ceil(count / parts)))
    blocks = None
    for i in range(rounds):
        share = F.pmod(F.xxhash64("node"), F.lit(rounds)) == i
        homes = nodes.where(share).join(vectors.where(share), "node").select("node", "copies", "vector").mapInArrow(at_home(pivots), f"node long, copies long, vector {kind}, cell int")
        dealt = homes.repartitionByRange(math.ceil(parts / rounds), "cell", "node").sortWithinPartitions("cell", "node")
        more = stored(dealt.mapInArrow(in_blocks(size), BLOCK), "blocks", **BLOCK_FILES)
        blocks = more if blocks is None else blocks.unionByName(more)
    blocks = blocks.coalesce(parts)
    a, b = (blocks.select(*(F.col(c).alias(f"{side}_{c}") for c in blocks.columns)) for side in "ab")
    # One of both orders of two blocks, by a coin, so that tasks have about equal shares.
    turned = F.xxhash64("a_first").bitwiseXOR(F.xxhash64("b_first")).bitwiseAND(F.lit(1)) == 0
    once = (F.col("a_first") == F.col("b_first")) | F.when(turned, F.col("a_first") < F.col("b_first")).otherwise(F.col("a_first") > F.col("b_first"))
    between = F.aggregate(F.zip_with("a_center", "b_center", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    close = between >= F.cos(F.least(F.lit(math.pi), F.col("a_radius") + F.col("b_radius") + (reach + SLACK))) - SLACK
    paired = a.hint("shuffle_replicate_nl").join(b, once & close)
    return paired.mapInArrow(compare(threshold, number, sketch), "a long, b long, links long")


def embedding_report(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
