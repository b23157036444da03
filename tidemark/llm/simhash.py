"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints of 64 bits link at four or fewer differing bits. The bits are dealt into three parts, so that linked
fingerprints differ in at most one bit of some part. A part's anchors are the words of a covering code: the Hamming
code of length 15, whose words are within one bit of every word, and all values of the part's other bits. Every
fingerprint is at home at the anchor that covers it and visits all anchors within the covering radius plus the
threshold, one and one; a fingerprint that differs by one bit must be among the visitors. Anchors are compared each
by itself, all 64 bits deciding.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import as_bytes, slices
from tidemark.llm.components import components, spanning, stored
from tidemark.session import column

# Words of a shingle, seed, differing bits, the parts (first bit, bits) and the code.
SHINGLE, HASH_SEED, THRESHOLD = 4, 42, 4
PARTS = ((0, 21), (21, 21), (42, 22))
CODE_BITS, RADIUS = 15, 1
PART_THRESHOLD = THRESHOLD // len(PARTS)
# Homes of an anchor that are compared together; more are split, and visitors go to each part.
HOMES = 2_048
# Up to so many homes all links of a visitor are given out as they are.
FEW_HOMES = 16
VISITORS = 1_024

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes) -> bytes:
    """The eight bytes, most significant first, of a text's SimHash."""
    words = text.translate(LOWER).split()
    if not words:
        return bytes(8)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    span = min(SHINGLE, len(words))
    starts = np.concatenate([[0], ends[: len(words) - span]]).tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], HASH_SEED) for a, b in zip(starts, (ends[span - 1 :] - 1).tolist())])
    count = len(hashes) // 8
    ones = np.zeros(64, np.int64)
    packed = np.frombuffer(hashes, np.uint8).reshape(count, 8)
    for low in range(0, count, 1 << 16):
        ones += np.unpackbits(packed[low : low + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > count).tobytes()


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash`` (128 bits of the text) and ``bits`` of each row; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = as_bytes(part, "text")
            bits = np.frombuffer(b"".join(map(fingerprint, texts)), ">i8").astype(np.int64)
            names = pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("id"), names, pa.array(bits)], ["doc_id", "text_hash", "bits"])

    rows = docs.select(column(id_column).alias("id"), column(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['id'].dataType.simpleString()}, text_hash binary, bits long")


@lru_cache(maxsize=1)
def syndromes() -> np.ndarray:
    """Of every word of the code's length: the exclusive or of the numbers (from 1) of its set bits."""
    words, out = np.arange(1 << CODE_BITS), np.zeros(1 << CODE_BITS, np.int64)
    for bit in range(CODE_BITS):
        out ^= ((words >> bit) & 1) * (bit + 1)
    return out


@lru_cache(maxsize=1)
def flips() -> list[np.ndarray]:
    """By syndrome: the flips of at most ``RADIUS + PART_THRESHOLD`` bits that lead to a code word."""
    masks = [0, *(1 << i for i in range(CODE_BITS)), *(1 << i | 1 << j for i in range(CODE_BITS) for j in range(i))]
    of = syndromes()[masks]
    return [np.array(masks)[of == s] for s in range(CODE_BITS + 1)]


def home(bits: np.ndarray, part: int) -> np.ndarray:
    """The anchor that covers each fingerprint in a part: the nearest code word, other bits as they are."""
    first, width = PARTS[part]
    value = ((bits.view(np.uint64) >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64)
    syndrome = syndromes()[value & ((1 << CODE_BITS) - 1)]
    return value ^ np.where(syndrome > 0, 1 << np.maximum(syndrome - 1, 0), 0)


def visits(bits: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of fingerprints and the anchors they visit in a part.

    On the bits outside the code anchors agree with those at home there, so at most the threshold differs.
    """
    first, width = PARTS[part]
    value = ((bits.view(np.uint64) >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64)
    syndrome, where, anchors = syndromes()[value & ((1 << CODE_BITS) - 1)], [], []
    for s, masks in enumerate(flips()):
        own = np.flatnonzero(syndrome == s)
        where.append(np.repeat(own, len(masks)))
        anchors.append((value[own][:, None] ^ masks[None, :]).ravel())
    nearest = home(bits, part)
    for bit in range(CODE_BITS, width):
        where.append(np.arange(len(bits)))
        anchors.append(nearest ^ (1 << bit))
    return np.concatenate(where), np.concatenate(anchors)


def at_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = batch.column(0).to_numpy()
        for low in range(0, len(bits), 1 << 13):
            own = bits[low : low + (1 << 13)]
            for part in range(len(PARTS)):
                where, anchors = visits(own, part)
                anchor = (np.concatenate([home(own, part), anchors]) << 2) | part
                kind = np.repeat(np.array([0, 1], np.int32), [len(own), len(anchors)])
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(kind), pa.array(np.concatenate([own, own[where]]))], ["anchor", "visitor", "bits"])


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links at the anchors of one partition; rows come by anchor and chunk, homes before visitors."""
    carried = np.empty((0, 2), np.int64), np.empty(0, np.int64)
    for batch in batches:
        key = np.column_stack([batch.column("anchor").to_numpy(), batch.column("chunk").to_numpy()]).astype(np.int64)
        visitor, bits = batch.column("visitor").to_numpy() == 1, batch.column("bits").to_numpy()
        homes = np.concatenate([carried[1], bits[~visitor]])
        of_home, of_visitor, guests = np.concatenate([carried[0], key[~visitor]]), key[visitor], bits[visitor]
        if len(key):
            last = (of_home == key[-1]).all(axis=1)
            carried = of_home[last], homes[last]
        out = [linked(homes, guests, *pair) for pair in aligned(of_home, of_visitor)]
        if links := [x for part in out for x in part if len(x[0])]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[i] for x in links])) for i in (0, 1)], ["a", "b"])


def aligned(of_home: np.ndarray, of_visitor: np.ndarray) -> Iterator[tuple]:
    """Ranges of homes for each visitor where there are few, and both ranges of each anchor with more."""
    if not len(of_home) or not len(of_visitor):
        return
    both = np.concatenate([of_home, of_visitor])
    _, number = np.unique(both, axis=0, return_inverse=True)
    number = number.ravel()
    h, v = number[: len(of_home)], number[len(of_home) :]
    low, high = np.searchsorted(h, v, "left"), np.searchsorted(h, v, "right")
    few = np.flatnonzero((high > low) & (high - low <= FEW_HOMES))
    yield few, low[few], high[few]
    many = np.flatnonzero(high - low > FEW_HOMES)
    if len(many):
        cuts = np.flatnonzero(np.diff(v[many])) + 1
        for group in np.split(many, cuts):
            for start in range(0, len(group), VISITORS):
                yield group[start : start + VISITORS], low[group[0]], high[group[0]]


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def linked(homes: np.ndarray, guests: np.ndarray, chosen: np.ndarray, low, high) -> list[tuple]:
    if np.ndim(low):
        sizes = high - low
        left = np.repeat(chosen, sizes)
        right = np.repeat(low, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        near = (differing(guests[left], homes[right]) <= THRESHOLD) & (guests[left] != homes[right])
        return [(guests[left[near]], homes[right[near]])]
    own, here = guests[chosen], homes[low:high]
    to_home, among = spanning(differing(own[:, None], here[None, :]) <= THRESHOLD)
    return [(own[to_home[0]], here[to_home[1]]), (here[among[0]], here[among[1]])]


def links(distinct: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of fingerprints (column ``bits``, each once) that connect all that link."""
    rows = distinct.select("bits").mapInArrow(at_anchors, "anchor long, visitor int, bits long")
    homes = distinct.select("bits").mapInArrow(at_anchors, "anchor long, visitor int, bits long").where("visitor = 0")
    # At most one row for each word of the code: the size of what is broadcast does not follow the input.
    crowded = homes.groupBy("anchor").count().where(F.col("count") > HOMES).select("anchor", F.ceil(F.col("count") / HOMES).cast("int").alias("chunks"))
    dealt = rows.join(F.broadcast(crowded), "anchor", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.array(F.pmod(F.xxhash64("bits"), F.col("chunks")).cast("int"))
    dealt = dealt.select("anchor", "visitor", "bits", F.explode(F.when(F.col("visitor") == 0, own).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))).alias("chunk"))
    return dealt.repartition("anchor", "chunk").sortWithinPartitions("anchor", "chunk", "visitor").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``bits`` and ``component_id`` of each row.

    Equal fingerprints are one before anything is compared. ``component_id`` is the smallest non-null id reachable
    (null if there is none); repeated rows stay, null and blank texts have fingerprint zero. Other columns are not
    read.
    """
    rows = stored(fingerprints(docs, id_column, text_column), "fingerprints")
    distinct = rows.groupBy("bits").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct))
    classes = distinct.join(roots.withColumnRenamed("node", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(classes.select("bits", "root").join(named, "root").select("bits", "component_id"), "bits")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` with one row of each component: the smallest id, then hash of the text.

    Rows without any id are components by fingerprint too. Of repeated rows one stays.
    """
    found = near_duplicates(docs)
    # Components without an id are told apart by their fingerprint.
    alone = F.when(F.col("component_id").isNull(), F.col("bits"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = found.groupBy("component_id", alone.alias("alone")).agg(F.min(order).alias("kept")).select(F.col("kept.doc_id").alias("__id"), F.col("kept.text_hash").alias("__hash"))
    hashed = docs.mapInArrow(with_hash(docs.schema.names.index("text")), T.StructType([*docs.schema.fields, T.StructField("__hash", T.BinaryType())]))
    one = hashed.join(kept.withColumnRenamed("__hash", "__kept"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__kept")), "left_semi")
    return one.dropDuplicates(["doc_id", "__hash"]).select(*[column(name) for name in docs.columns])


def with_hash(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            names = [xxhash.xxh3_128_digest(x or b"") for x in batch.column(at).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.binary())], [*batch.schema.names, "__hash"])

    return run


def simhash_report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
