"""Best-fit packing with certified bin counts.

Documents are cut so that only their first piece may be short of a whole sequence; the short pieces are packed. They
are dealt into partitions, each packed by best fit on falling lengths and compared with a lower bound from
dual-feasible functions. A partition that meets its bound is certified and gives up its emptiest sequence only; one
with a gap gives up all that are not full. What was given up is dealt anew and packed again, as long as that saves
sequences.
"""

from __future__ import annotations

import itertools
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import as_text, slices
from tidemark.llm.components import stored
from tidemark.session import column

VOCABULARY = "byte_bpe_50k.json"
CAPACITY, END_ID = 1024, 2
# Pieces of a partition, on average.
PARTITION_PIECES = 4_096
MEMORY_ENTRIES = 250_000
# Stretches that are given to the tokenizer as one string, and texts whose ids are put together at a time.
JOINED, TOGETHER = 256, 256


class Lookup:
    """Packed ids of texts by a tokenizer that gets every stretch between spaces once, while it is remembered.

    The vocabulary splits texts before a single space between two characters that are no white space, so the ids of
    such stretches are those they have in the text.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        # Every character of a token's name stands for one byte.
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, stretches: list[str]) -> None:
        new = []
        for stretch in stretches:
            ids = self.old.get(stretch)
            if ids is None:
                new.append(stretch)
            else:
                self.known[stretch] = ids
        # Many stretches make one string, cut again where the bytes of the tokens reach the end of a stretch.
        spaced = [stretch for stretch in new if stretch[0] == " "]
        groups = [spaced[i : i + JOINED] for i in range(0, len(spaced), JOINED)]
        for group, encoded in zip(groups, self.tokenizer.encode_batch_fast(list(map("".join, groups)), add_special_tokens=False)):
            ids = np.array(encoded.ids, "<u4")
            ends = np.cumsum([len(stretch.encode()) for stretch in group])
            cuts = (np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1).tolist()
            packed = ids.tobytes()
            for stretch, low, high in zip(group, [0, *cuts], cuts):
                self.known[stretch] = packed[4 * low : 4 * high]
        alone = [stretch for stretch in new if stretch[0] != " "]
        for stretch, encoded in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            self.known[stretch] = array("I", encoded.ids).tobytes()

    def packed(self, texts: list[str]) -> list[bytes]:
        """All stretches of the texts are numbered first, so that Python meets each different one once."""
        if not texts:
            return []
        if len(self.known) > MEMORY_ENTRIES:
            self.old, self.known = self.known, {}
        marked = pc.replace_substring(pa.array(["" if "\0" in text else text for text in texts], pa.large_string()), " ", "\0 ")
        split = pc.split_pattern(marked, "\0")
        begins = split.offsets.to_numpy()[:-1]  # every text has a stretch, an empty one an empty stretch
        coded = split.flatten().dictionary_encode()
        stretches, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        counts = np.diff(begins, append=len(codes))
        del marked, split, coded
        new = np.fromiter((stretch not in self.known for stretch in stretches), bool, len(stretches))
        apart = np.fromiter((n and beside_white_space(stretch) for n, stretch in zip(new.tolist(), stretches)), bool, len(stretches))
        whole = np.logical_or.reduceat(apart[codes], begins)
        needed = np.zeros(len(stretches), bool)
        needed[codes[np.repeat(~whole, counts)]] = True
        self.learn([stretches[i] for i in np.flatnonzero(needed & new).tolist()])
        ids_of = [self.known[stretch] if wanted else b"" for stretch, wanted in zip(stretches, needed.tolist())]
        sizes = np.fromiter(map(len, ids_of), np.int64, len(ids_of)) // 4
        table, first = np.frombuffer(b"".join(ids_of), "<u4"), np.cumsum(sizes) - sizes
        encoded = iter(self.tokenizer.encode_batch_fast([texts[i] for i in np.flatnonzero(whole).tolist()], add_special_tokens=False))
        out: list[bytes] = []
        for low in range(0, len(texts), TOGETHER):
            high = min(low + TOGETHER, len(texts))
            own = codes[begins[low] : begins[high] if high < len(texts) else len(codes)]
            length = sizes[own]
            ends = np.cumsum(length)
            ids = table[np.repeat(first[own] - (ends - length), length) + np.arange(ends[-1])].tobytes()
            edges = [0, *(4 * ends[begins[low + 1 : high] - begins[low] - 1]).tolist(), len(ids)]
            out += [array("I", next(encoded).ids).tobytes() if alone else ids[a:b] for alone, a, b in zip(whole[low:high].tolist(), edges, edges[1:])]
        return out


def beside_white_space(part: str) -> bool:
    """Whether a space that starts this part or follows it may belong to longer white space."""
    return not part or part.isspace() or part[-1].isspace() or (part[0].isspace() and part[1].isspace())


@lru_cache(maxsize=1)
def lookup(path: str) -> Lookup:
    return Lookup(path)


def cut(count: int) -> list[int]:
    """Starts of the pieces of a document, and its end; only the first piece may be short."""
    return [0, *range(count % CAPACITY or CAPACITY, count + 1, CAPACITY)]


def token_pieces(docs: DataFrame, path: str | None = None, with_ids: bool = True, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and packed ``ids`` (null unless ``with_ids``).

    A null or empty text is the end id alone.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    end = array("I", [END_ID]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows: list[tuple] = []
            for i, packed in enumerate(lookup(path).packed(as_text(part, "text"))):
                ids = packed + end
                starts = cut(len(ids) // 4)
                for piece, (low, high) in enumerate(zip(starts, starts[1:])):
                    own = ids[4 * low : 4 * high]
                    rows.append((i, piece, low, high - low, zlib.crc32(own), own if with_ids else None))
            columns = list(zip(*rows))
            arrays = [part.column("id").take(pa.array(columns[0])), *(pa.array(c, k) for c, k in zip(columns[1:], (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    rows = docs.select(column(id_column).alias("id"), column(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary")


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """No packing has fewer bins: the best of two families of dual-feasible functions."""
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1)
    below, weight = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * sizes)])
    best = -(-int(weight[-1]) // capacity)
    for k in range(1, capacity // 2 + 1):  # small ones count nothing, large ones a whole bin
        total = (len(lengths) - below[capacity - k + 1]) * capacity + weight[capacity - k + 1] - weight[k]
        best = max(best, -(-int(total) // capacity))
    for k in range(1, 33):  # lengths rounded down to parts of k, unless they are exact parts of k + 1
        exact = (k + 1) * sizes % capacity == 0
        total = int((counts * np.where(exact, k * sizes, (k + 1) * sizes // capacity * capacity)).sum())
        best = max(best, -(-total // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the free space of each bin; longest first, each into the fullest bin it fits."""
    bins, offsets, free = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    with_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # of the free spaces that some bin has
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = mask >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            own = with_space[space].pop()
            if not with_space[space]:
                mask &= ~(1 << space)
        else:
            space, own = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i], free[own] = own, capacity - space, space - size
        if space > size:
            with_space[space - size].append(own)
            mask |= 1 << (space - size)
    return bins, offsets, np.array(free, np.int64)


PACKED = "key long, length long, sequence_id long, offset long, released boolean"


def pack_partition(number: int):
    """Packs one partition; numbers of sequences are negative and differ between rounds and partitions."""

    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values("key", ignore_index=True)
        lengths = pieces["length"].to_numpy()
        bins, offsets, free = best_fit(lengths)
        certified = len(free) == lower_bound(lengths)
        given = free > 0
        if certified:
            given &= np.arange(len(free)) == free.argmax()
        base = (number << 48) + (int(pieces["part"].iloc[0]) << 20)
        return pd.DataFrame({"key": pieces["key"], "length": lengths, "sequence_id": -1 - base - bins, "offset": offsets, "released": given[bins]})

    return run


def packed(pieces: DataFrame, number: int, count: int) -> DataFrame:
    parts = -(-count // PARTITION_PIECES)
    dealt = pieces.select("key", "length", F.pmod(F.xxhash64("key", F.lit(number)), F.lit(parts)).alias("part"))
    return stored(dealt.groupBy("part").applyInPandas(pack_partition(number), PACKED), "packed")


def pack(pieces: DataFrame) -> DataFrame:
    """``key``, ``sequence_id`` and ``offset`` for rows of unique ``key`` and ``length`` (1 to the capacity).

    The exchange goes on until it saves nothing any more or nothing is left to exchange; each round has fewer
    sequences than the one before.
    """
    count = pieces.count()
    if not count:
        return pieces.sparkSession.createDataFrame([], "key long, sequence_id long, offset long")
    settled, now = None, packed(pieces, 0, count)
    for number in itertools.count(1):
        open_ones = now.where("released")
        before, count = open_ones.agg(F.countDistinct("sequence_id"), F.count("*")).first()
        if before < 2:
            break
        again = packed(open_ones, number, count)
        if again.agg(F.countDistinct("sequence_id")).first()[0] >= before:
            break
        done = now.where("not released")
        settled = done if settled is None else settled.unionByName(done)
        now = again
    return (now if settled is None else settled.unionByName(now)).select("key", "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str | None = None, with_ids: bool = True, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The pieces of :func:`token_pieces` with ``sequence_id`` and ``offset``; sequences have no gap before their end.

    Repeated rows are packed each by itself. Other columns are not read; an empty table has no pieces.
    """
    pieces = stored(token_pieces(docs, path, with_ids, id_column, text_column).withColumn("key", F.monotonically_increasing_id()), "pieces")
    whole = pieces.where(F.col("length") == CAPACITY).withColumns({"sequence_id": F.col("key"), "offset": F.lit(0).cast("long")})
    short = pieces.where(F.col("length") < CAPACITY)
    placed = short.join(pack(short.select("key", "length")), "key")
    return whole.unionByName(placed).drop("key")


def packing_report(docs: DataFrame) -> DataFrame:
    return pack_documents(docs, with_ids=False).drop("ids")
