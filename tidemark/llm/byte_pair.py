"""Byte-level BPE as a monoid: texts are encoded in halves, and neighbours are joined at their boundary.

A token sequence is the BPE encoding of its bytes exactly if every two neighbouring tokens, encoded together, come
out as they are. So two encodings are joined by encoding a window around the boundary anew. The window grows until
the tokens on both of its edges agree with their outer neighbours; everything outside is then proven to stay.
Decoding concatenates the bytes of tokens up the same tree.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import as_text, slices
from tidemark.session import column

RANKS = "byte_bpe_50k.tiktoken"
# Entries of the memories for strings seen before; a full memory starts anew, results do not change.
MEMORY_ENTRIES = 250_000
# Strings of up to so many bytes are remembered.
LEAF_BYTES = 7
SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file with one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Memory(dict):
    """A dict of bounded size in two generations: when it is full, what was not used since the last time goes."""

    def __init__(self) -> None:
        super().__init__()
        self.old: dict = {}

    def __missing__(self, key):
        if len(self) >= MEMORY_ENTRIES:
            self.old = dict(self)
            self.clear()
        found = self.old.get(key)
        value = self[key] = self.make(key) if found is None else found
        return value

    def make(self, key):
        raise NotImplementedError


class Pairs(Memory):
    """Two tokens, encoded together."""

    def __init__(self, encoder: TreeEncoder) -> None:
        super().__init__()
        self.encoder = encoder

    def make(self, key: tuple[int, int]) -> tuple[int, ...]:
        return self.encoder.merge(self.encoder.tokens[key[0]] + self.encoder.tokens[key[1]])


class Leaves(Memory):
    """Short byte strings, encoded from their halves."""

    def __init__(self, encoder: TreeEncoder) -> None:
        super().__init__()
        self.encoder = encoder

    def make(self, data: bytes) -> tuple[int, ...]:
        rank = self.encoder.ranks.get(data)
        if rank is not None:
            return (rank,)
        half = len(data) // 2
        return self.encoder.join(self[data[:half]], self[data[half:]]) if data else ()


class TreeEncoder:
    """Encodes byte strings by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.leaves = Leaves(self)
        self.pairs = Pairs(self)

    def merge(self, data: bytes) -> tuple[int, ...]:
        """The definition: of all neighbours the pair with the lowest rank is merged, the leftmost first."""
        ranks, n = self.ranks, len(data)
        if data in ranks:
            return (ranks[data],)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(ranks[data[i : i + 2]], i, i + 2) for i in range(n - 1) if data[i : i + 2] in ranks]
        heapq.heapify(heap)
        gone = bytearray(n)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or end[j] != stop:
                continue
            gone[j], end[i], after[i] = 1, stop, after[j]
            if after[i] < n:
                before[after[i]] = i
                joined = data[i : end[after[i]]]
                if joined in ranks:
                    heapq.heappush(heap, (ranks[joined], i, end[after[i]]))
            if before[i] >= 0:
                joined = data[before[i] : stop]
                if joined in ranks:
                    heapq.heappush(heap, (ranks[joined], before[i], stop))
        return tuple(ranks[data[i : end[i]]] for i in range(n) if not gone[i])

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of both strings, one after the other."""
        if not left or not right:
            return left or right
        pairs, a, b = self.pairs, 1, 1
        n, m = len(left), len(right)
        pair = left[-1], right[0]
        window = pairs[pair]
        if window == pair:
            return left + right
        while True:
            left_ok = right_ok = True
            if a < n:
                pair = left[-a - 1], window[0]
                left_ok = pairs[pair] == pair
            if b < m:
                pair = window[-1], right[b]
                right_ok = pairs[pair] == pair
            if left_ok and right_ok:
                return left[: n - a] + window + right[b:]
            a = a if left_ok else min(n, 2 * a)
            b = b if right_ok else min(m, 2 * b)
            window = self.merge(b"".join(map(self.tokens.__getitem__, left[n - a :] + right[:b])))

    def encode(self, data: bytes) -> tuple[int, ...]:
        """The ids of one string that the split pattern has matched."""
        size = len(data)
        if size <= LEAF_BYTES:
            return self.leaves[data]
        rank = self.ranks.get(data)
        if rank is not None:
            return (rank,)
        half = size // 2
        return self.join(self.encode(data[:half]), self.encode(data[half:]))

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the tokens, halves joined up the tree."""
        if len(ids) <= 4096:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


class Unsafe(Exception):
    """White space beside a space: the split of this text has to be done with care."""


class Chunks(Memory):
    """Packed ids of stretches between spaces, each with the space before it."""

    def __init__(self, pieces, encode) -> None:
        super().__init__()
        self.pieces, self.encode = pieces, encode

    def pack(self, text: str) -> bytes:
        ids = array("I")
        for piece in self.pieces(text):
            ids.extend(self.encode(piece.encode()))
        return ids.tobytes()

    def make(self, chunk: str) -> bytes:
        if chunk.isalpha():  # one match of the pattern
            return array("I", self.encode((" " + chunk).encode())).tobytes()
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise Unsafe
        return self.pack(" " + chunk)


class TextEncoder:
    """Encodes texts; every match of the split pattern by itself.

    A single space between two characters that are no white space always starts a match, so texts may be cut there,
    and stretches that were seen before are looked up.
    """

    def __init__(self, encode, pattern: str = public_tokenizers.PATTERN) -> None:
        self.chunks = Chunks(regex.compile(pattern).findall, encode)

    def packed(self, text: str) -> bytes:
        """The ids as unsigned 32-bit integers, little-endian."""
        for split in (str.split, SAFE_SPACE.split):
            first, *rest = split(text, " ") if split is str.split else split(text)
            try:
                if split is str.split and (first[-1:].isspace() or (rest and not first)):
                    raise Unsafe
                return self.chunks.pack(first) + b"".join(map(self.chunks.__getitem__, rest))
            except Unsafe:
                continue
        return self.chunks.pack(text)


@lru_cache(maxsize=1)
def encoder(path: str) -> tuple[TreeEncoder, TextEncoder]:
    tree = TreeEncoder(load_ranks(path))
    return tree, TextEncoder(tree.encode)


def encode_documents(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (packed little-endian unsigned 32-bit integers) and ``decoded`` (the bytes of those ids).

    One row for each row, repeated ones included; a null text counts as empty and has no ids; other columns are not
    read. There is no shuffle, and a text is encoded as a whole, however long it is.
    """
    path = path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, text_encoder = encoder(path)
        for part in slices(batches, "text"):
            ids = [text_encoder.packed(text) for text in as_text(part, "text")]
            decoded = [tree.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    rows = docs.select(column(id_column).alias("id"), column(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Number of tokens and digests of ids and decoded bytes of each document."""
    return encode_documents(docs, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
