"""Alignment of the tokens of two tokenizers by galloping intersection of their ends.

The ends of a text's tokens in bytes are two rising lists with the same last element. Every element of the shorter one
is searched in the longer: from a guess, steps that double until they enclose it, then halving. All searches of a slice
of texts take their steps side by side. Ends found in both cut the tokens into groups; the ranks at which neighbouring
ends were found give the range of tokens that one of the shorter list overlaps.

A slice of texts is one row: what is known of its texts, its distinct id pairs, and for each link the place of its pair
among them. Spark adds up in how many documents each pair is linked and joins the counts back to slices, one row for
each pair and slice; links themselves are not shuffled one by one.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import as_text, slices
from tidemark.llm.components import stored
from tidemark.llm.packing import lookup
from tidemark.session import column

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Text of one slice, and of the part of it that is aligned at a time; a longer text is a slice of its own.
SLICE_BYTES, PART_BYTES = 1 << 20, 1 << 18
# Stretches between spaces that are remembered, in each of two generations.
MEMORY_ENTRIES = 200_000
# Stretches that are given to a tokenizer as one string.
JOINED = 256
# A space beside other white space; where texts with such spaces are cut.
CROWDED = re.compile(r" (?:(?=\s)|(?<=\s ))")
PARTS = re.compile(r"(?<=\S)(?= \S)")
LOW = np.int64((1 << 32) - 1)
# Marks an id of B among packed ids of both.
OF_B = np.uint32(1 << 31)


# ---- tokens -----------------------------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """Which character stands for which byte in names of byte-level tokens: itself if it is printable, else the next from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokens:
    """Bytes of every id of a vocabulary."""

    def __init__(self, names: list[bytes]) -> None:
        self.sizes = np.fromiter(map(len, names), np.int64, len(names))
        self.listed = names


@lru_cache(maxsize=1)
def level_tokens(path: str) -> Tokens:
    """Of a byte-level vocabulary."""
    of = byte_alphabet()
    vocabulary = lookup(path).tokenizer.get_vocab()
    names = [b""] * (max(vocabulary.values()) + 1)
    for name, number in vocabulary.items():
        names[number] = bytes(map(of.__getitem__, name)) if set(name) <= of.keys() else name.encode()
    return Tokens(names)


@lru_cache(maxsize=1)
def pieces(path: str):
    """A sentence-piece model and the bytes of its pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return model, Tokens([bytes([int(n[3:-1], 16)]) if model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)])


# ---- galloping --------------------------------------------------------------------------------------


def gallop(wanted: np.ndarray, within: np.ndarray, guess: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Position of the first element of ``within`` that is not less than each of ``wanted``.

    Each search has its own sorted stretch ``low`` to ``high`` of ``within``, whose last element is large enough, and
    starts at its guess. Steps away from it double until the element is enclosed; then the enclosed stretch is halved.
    """
    less = within[guess] < wanted
    # Invariant: what lies before ``left`` is less than wanted, the element at ``right`` is not.
    left, right = np.where(less, guess + 1, low), np.where(less, high - 1, guess)
    open_ones, step = np.flatnonzero(left < right), 1
    while len(open_ones):
        upward = less[open_ones]
        up, down = open_ones[upward], open_ones[~upward]
        at = np.minimum(guess[up] + step, right[up])
        reached = within[at] >= wanted[up]
        right[up[reached]] = at[reached]
        left[up[~reached]] = at[~reached] + 1
        at = np.maximum(guess[down] - step, left[down])
        passed = within[at] < wanted[down]
        left[down[passed]] = at[passed] + 1
        right[down[~passed]] = at[~passed]
        more = np.concatenate([up[~reached], down[~passed]])
        open_ones, step = more[left[more] < right[more]], step * 2
    halved = np.flatnonzero(left < right)
    while len(halved):
        middle = (left[halved] + right[halved]) >> 1
        small = within[middle] < wanted[halved]
        left[halved[small]] = middle[small] + 1
        right[halved[~small]] = middle[~small]
        halved = halved[left[halved] < right[halved]]
    return left


def of_each(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For stretches of these lengths end to end: the stretch of every element, and where each stretch starts."""
    return np.repeat(np.arange(len(counts)), counts), np.cumsum(counts) - counts


class Aligned:
    """Groups and links of the tokens of some texts.

    ``ids_a``, ``ids_b`` and their ends (in bytes, rising over all texts) lie end to end, ``n_a`` and ``n_b`` tokens for
    each text; both lists of a text end at the same byte, and a text without tokens has none in both.
    """

    def __init__(self, ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> None:
        texts = len(n_a)
        (text_a, start_a), (text_b, start_b) = of_each(n_a), of_each(n_b)
        a_drives = n_a <= n_b
        # The shorter list of each text searches in the longer.
        n_short, n_long = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
        text, start = of_each(n_short)
        _, long_start = of_each(n_long)
        rank = np.arange(len(text)) - start[text]
        own = np.where(a_drives[text], start_a[text], start_b[text]) + rank
        short_ends = np.where(a_drives[text], take(ends_a, own), take(ends_b, own))
        long_text = np.repeat(np.arange(texts), n_long)
        place = np.arange(len(long_text)) - long_start[long_text] + np.where(a_drives[long_text], start_b[long_text], start_a[long_text])
        long_ends = np.where(a_drives[long_text], take(ends_b, place), take(ends_a, place))
        low, high = long_start[text], (long_start + n_long)[text]
        guess = low + rank * n_long[text] // np.maximum(1, n_short[text])
        found = gallop(short_ends, long_ends, guess, low, high)
        common = long_ends[found] == short_ends
        # Overlapped are the tokens from the one after the last end not beyond this one's start, to the one found.
        before = np.concatenate([[0], (found + common)[:-1]]) if len(found) else found
        first = np.where(rank == 0, low, before)
        width = found - first + 1
        link, link_start = of_each(width)
        other = first[link] + np.arange(len(link)) - link_start[link]
        # Back from ranks in the two lists to tokens of A and B.
        link_text = text[link]
        short_at, long_at = own[link], place[other]
        in_a = np.where(a_drives[link_text], short_at, long_at)
        in_b = np.where(a_drives[link_text], long_at, short_at)
        self.n_links = np.bincount(link_text, minlength=texts)
        self.pairs = (ids_a[in_a].astype(np.int64) << 32) | ids_b[in_b].astype(np.int64)
        self.link_text = link_text
        self.n_groups = np.bincount(text[common], minlength=texts)
        # The last tokens of groups, by the ends that are common.
        last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
        short_last, long_last, drives = own[common], place[found[common]], a_drives[text[common]]
        last_a[np.where(drives, short_last, long_last)] = True
        last_b[np.where(drives, long_last, short_last)] = True
        self.last_a, self.last_b = last_a, last_b
        self.ids_a, self.ids_b, self.n_a, self.n_b = ids_a, ids_b, n_a, n_b

    def group_texts(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text; empty without tokens."""
        size = len(self.ids_a) + len(self.ids_b)
        group_a, group_b = (np.cumsum(last) - last for last in (self.last_a, self.last_b))
        # A group's tokens of A, then its tokens of B.
        place_a = np.arange(len(self.ids_a)) + np.searchsorted(group_b, group_a, side="left")
        place_b = np.arange(len(self.ids_b)) + np.searchsorted(group_a, group_b, side="right")
        words = np.empty(size, object)
        for place, ids, last, mark in ((place_a, self.ids_a, self.last_a, b"|"), (place_b, self.ids_b, self.last_b, b";")):
            words[place] = numerals(b",")[ids]
            words[place[last]] = numerals(mark)[ids[last]]
        edges = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).tolist()
        return [b"".join(words[low:high].tolist())[:-1] for low, high in zip(edges, edges[1:])]


def take(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Elements by position; positions beyond the end, whose elements are not used, give the last one."""
    return values[np.minimum(at, len(values) - 1)] if len(values) else np.zeros(len(at), np.int64)


@lru_cache(maxsize=3)
def numerals(mark: bytes) -> np.ndarray:
    """Every id in decimal with the mark after it."""
    size = max(len(level_tokens(public_tokenizers.path(VOCABULARY_A)).sizes), 1 << 16)
    out = np.empty(size, object)
    out[:] = [b"%d%s" % (i, mark) for i in range(size)]
    return out


def parted(text: str) -> list[str]:
    """A space and the text, cut before every space between two characters that are no white space."""
    if not text:
        return []
    if text[0].isspace() or text[-1] == " " or "\0" in text or CROWDED.search(text):
        return PARTS.split(" " + text)
    parts = text.replace(" ", "\0 ").split("\0")
    parts[0] = " " + parts[0]
    return parts


def cut_at(ids: np.ndarray, sizes: np.ndarray, ends: np.ndarray, mark: np.uint32 = np.uint32(0)) -> list[bytes]:
    """Packed ids of stretches that lie end to end, from where their bytes end."""
    cuts = (np.searchsorted(np.cumsum(sizes[ids]), ends) + 1).tolist()
    marked = ids | mark
    return [marked[low:high].tobytes() for low, high in zip([0, *cuts], cuts)]


def apart(packed: bytes) -> tuple[bytes, bytes]:
    """Packed ids of A and of B, from those of both."""
    ids = np.frombuffer(packed, "<u4")
    of_b = ids >= OF_B
    return ids[~of_b].tobytes(), (ids[of_b] - OF_B).tobytes()


class Stretches:
    """Packed ids of both tokenizers for texts, from those of stretches between spaces, while these are remembered.

    Both tokenizers start a token at a single space between two other characters that are no white space: A's words
    begin there, and no piece of B has a space after anything else. So the tokens of such a stretch are those it has
    in any text. Two generations of stretches bound memory; a stretch is there once, with its ids of both.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a = lookup(path_a)
        self.model, self.bytes_b = pieces(path_b)
        self.bytes_a = level_tokens(path_a)
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.broken: set[str] = set()

    def learn(self, stretches: set[str]) -> None:
        again = stretches & self.old.keys()
        self.known.update((stretch, self.old[stretch]) for stretch in again)
        new, of_b = list(stretches - again), {}
        # Stretches that end in no white space make one string together, cut again where their bytes end.
        apart = {s for s in new if s[-1].isspace() or s[1:2].isspace()}
        joined = [s for s in new if s not in apart]
        groups = [joined[i : i + JOINED] for i in range(0, len(joined), JOINED)] + [[s] for s in apart]
        for group in groups:
            whole = "".join(group)
            ends = np.cumsum([len(stretch.encode()) for stretch in group])
            ids = np.array(self.model.encode(whole[1:]), "<u4")
            if b"".join(map(self.bytes_b.listed.__getitem__, ids.tolist())) == whole.encode():
                of_b.update(zip(group, cut_at(ids, self.bytes_b.sizes, ends, OF_B)))
            elif len(group) > 1:
                groups += [[stretch] for stretch in group]
            else:
                of_b[group[0]] = b""
                self.broken.add(group[0])
        for group, encoded in zip(groups, self.a.tokenizer.encode_batch_fast(list(map("".join, groups)), add_special_tokens=False)):
            ids = np.array(encoded.ids, "<u4")
            ends = np.cumsum([len(stretch.encode()) for stretch in group])
            self.known.update((stretch, of_a + of_b[stretch]) for stretch, of_a in zip(group, cut_at(ids, self.bytes_a.sizes, ends)))

    def encoded(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Packed ids of a space and each text; none for empty texts and those not given back byte by byte."""
        if len(self.known) > MEMORY_ENTRIES:
            self.old, self.known = self.known, {}
            self.broken &= self.old.keys()
        split = list(map(parted, texts))
        self.learn(set().union(*split).difference(self.known))
        if self.broken:
            split = [parts if self.broken.isdisjoint(parts) else [] for parts in split]
        both = [apart(b"".join(map(self.known.__getitem__, parts))) for parts in split]
        return [a for a, _ in both], [b for _, b in both]


@lru_cache(maxsize=1)
def stretches() -> Stretches:
    return Stretches(public_tokenizers.path(VOCABULARY_A), public_tokenizers.path(VOCABULARY_B))


def forget() -> None:
    """Lets go of the tokenizers and all that is remembered for them, in a worker that goes on to other work."""
    for kept in (stretches, numerals, pieces, level_tokens, lookup):
        kept.cache_clear()


def aligned(texts: list[str]) -> Aligned:
    """The tokens of texts; none for empty ones and those that a tokenizer does not give back byte by byte."""
    both = stretches()
    packed = both.encoded(texts)
    n_a, n_b = (np.fromiter(map(len, side), np.int64, len(texts)) // 4 for side in packed)
    ids_a, ids_b = (np.frombuffer(b"".join(side), "<u4").astype(np.int64) for side in packed)
    return Aligned(ids_a, ids_b, np.cumsum(both.bytes_a.sizes[ids_a]), np.cumsum(both.bytes_b.sizes[ids_b]), n_a, n_b)


# ---- over all documents -----------------------------------------------------------------------------

OF_TEXTS = ("n_a", "n_b", "n_groups", "n_links")


def aligned_slices(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each slice of texts: ids, counts and digests of its texts, its distinct ``pairs`` with the number of
    its documents they are linked in (``docs``), and packed ``links``: the place of each link's pair, by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            sums: dict[str, list[int]] = {name: [] for name in OF_TEXTS}
            digests, linked, link_texts, texts = [], [], [], 0
            for few in slices([part], "text", PART_BYTES):
                found = aligned(as_text(few, "text"))
                for name in OF_TEXTS:
                    sums[name] += getattr(found, name).tolist()
                digests += [hashlib.sha256(groups).hexdigest() if groups else "" for groups in found.group_texts()]
                linked.append(found.pairs)
                link_texts.append(found.link_text + texts)
                texts += few.num_rows
            pairs, place = np.unique(np.concatenate(linked), return_inverse=True)
            documents = np.bincount(np.unique((place << 32) | np.concatenate(link_texts)) >> 32, minlength=len(pairs))
            # Frequent pairs first, so that places are small numbers, which compress well.
            order = np.argsort(-np.bincount(place, minlength=len(pairs)), kind="stable")
            rank = np.empty(len(pairs), np.uint32)
            rank[order] = np.arange(len(pairs))
            counts = [pa.array([sums[name]], pa.list_(pa.int64())) for name in OF_TEXTS]
            ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("id"))
            columns = [pa.array([uuid.uuid4().hex]), ids, *counts, pa.array([digests], pa.list_(pa.string()))]
            columns += [pa.array([x[order]], pa.list_(pa.int64())) for x in (pairs, documents)]
            columns.append(pa.array([pa.compress(rank[place].astype("<u4").tobytes(), codec="zstd", asbytes=True)], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["slice", "ids", *OF_TEXTS, "digests", "pairs", "docs", "links"])

    rows = docs.select(column(id_column).alias("id"), column(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counts = ", ".join(f"{name} array<long>" for name in OF_TEXTS)
    return rows.mapInArrow(run, f"slice string, ids array<{kind}>, {counts}, digests array<string>, pairs array<long>, docs array<long>, links binary")


def pair_counts(aligned_: DataFrame) -> DataFrame:
    """``pair`` (id of A, shifted, and id of B) and in how many documents it is linked, over the whole corpus."""
    return aligned_.select(F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("docs").alias("docs")))).groupBy("pair").agg(F.sum("docs").alias("count"))


def with_best(counts: DataFrame) -> DataFrame:
    """``best``: whether no pair with the same id of A is linked in more documents."""
    of_a = counts.withColumn("a", F.shiftright("pair", 32))
    return of_a.join(of_a.groupBy("a").agg(F.max("count").alias("most")), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of texts, with the counts of their links added up."""
    forget()  # all slices are stored, and Spark's workers stay
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            of = lambda name: row.column(name).flatten()
            n_links = of("n_links").to_numpy()
            at = of("at").to_numpy()
            count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            count[at], best[at] = of("counts").to_numpy(), of("bests").to_numpy(zero_copy_only=False)
            links = np.frombuffer(pa.decompress(row.column("links")[0].as_py(), int(n_links.sum()) * 4, codec="zstd", asbytes=True), "<u4")
            edges = np.concatenate([[0], np.cumsum(n_links)])
            sums = [np.diff(np.concatenate([[0], np.cumsum(x[links])])[edges]) for x in (best, count)]
            columns = [of("ids"), *(of(name) for name in OF_TEXTS), *map(pa.array, sums), of("digests")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *OF_TEXTS, "n_best", "count_sum", "groups_sha256"])


def align(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of each row.

    Texts that are null or empty, or that a tokenizer does not give back byte by byte, have no tokens: zeros and an
    empty digest. Every row is a document, also with a repeated or null id. An empty table gives an empty one; other
    columns are not read.
    """
    kept = stored(aligned_slices(docs, id_column, text_column), "aligned")
    counts = with_best(pair_counts(kept))
    asked = kept.select("slice", F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(counts, "pair").groupBy("slice").agg(F.collect_list(F.struct("at", "count", "best")).alias("told"))
    known = answers.select("slice", F.col("told.at").alias("at"), F.col("told.count").alias("counts"), F.col("told.best").alias("bests"))
    none = lambda name, kind: F.coalesce(name, F.array().cast(f"array<{kind}>")).alias(name)
    joined = kept.drop("pairs", "docs").join(known, "slice", "left").withColumns({n: none(n, k) for n, k in (("at", "int"), ("counts", "long"), ("bests", "boolean"))})
    kind = kept.schema["ids"].dataType.elementType.simpleString()
    counts_of = ", ".join(f"{name} long" for name in (*OF_TEXTS, "n_best", "count_sum"))
    return joined.mapInArrow(judged, f"doc_id {kind}, {counts_of}, groups_sha256 string")


def alignment_report(docs: DataFrame) -> DataFrame:
    return align(docs)
