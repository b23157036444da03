"""Repeated byte strings by a logarithmic family of sorted indexes of suffixes.

Of every window of ``WINDOW`` bytes one suffix is kept: the one whose first ``CORE`` bytes have the least hash (the
leftmost of equals). Equal windows keep equal suffixes, so a window is repeated only where its suffix's first bytes
are. A batch of texts gets an array of its suffixes, sorted by that hash (not by bytes) and by 128 bits of hash of the
stretch of all windows that keep each of them, and is first scanned by itself. Arrays are then dealt by ranges of the
key. Each range keeps a family of sorted levels: an array that comes is merge-scanned against every level, then
becomes a level, and levels of like size are merged in order, keeping one suffix of those with equal stretches.

A scan tells of each suffix whether its whole stretch is found elsewhere (all its windows are repeated), or only its
first bytes. Of the latter, single windows are counted, by 128 bits of hash too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import as_bytes, slices
from tidemark.llm.components import stored
from tidemark.llm.rolling import Rolling, laid_out, mixed
from tidemark.session import column

# Fixed value: length of a repeated string. Parameters: bytes that suffixes are sorted by, text of a batch.
WINDOW, CORE = 200, 88
BATCH_BYTES, SLICE_BYTES = 24 << 20, 1 << 19
# Flags of a suffix: its whole stretch is repeated; its windows are to be counted.
WHOLE, COUNTED = 1, 2
# What a window sent to be counted is: one of which nothing is known yet; one for many that its slice has found
# repeated; one of these, which only passes by.
ASKED, FOR_MANY, ANSWERED = 0, 1, 2

SUFFIX = np.dtype([("key", "<u8"), ("stretch", "<u8"), ("second", "<u8"), ("doc", "<i8"), ("text", "<u8"), ("first", "<u4"), ("flags", "u1"), ("settled", "u1")])
MARK = np.dtype([("first", "<u4"), ("flags", "u1")])
COUNT = np.dtype([("hash", "<u8"), ("second", "<u8"), ("number", "<i8"), ("start", "<u4"), ("kind", "u1")])
# What is told of texts travels packed by parts of all texts, not as a row for each text and task.
TOLD = np.dtype([("doc", "<i8"), ("text", "<u8"), ("first", "<u4"), ("flags", "u1")])
FOUND = np.dtype([("number", "<i8"), ("start", "<u4")])


class Suffixes:
    """The kept suffixes of some texts: text, key, stretch, first and last window (positions in the text)."""

    def __init__(self, texts: list[bytes]) -> None:
        buffer, self.starts, ends = laid_out(texts)
        self.rolling = Rolling(buffer)
        core = self.rolling.all_of(CORE)
        width = WINDOW - CORE + 1
        count = max(0, len(core) - width + 1)
        least = minima(core, width)[:count]
        at = np.arange(count)
        text = np.searchsorted(ends, at, side="left")
        valid = at + WINDOW <= ends[np.minimum(text, len(ends) - 1)] if len(ends) else np.zeros(0, bool)
        # A window that keeps its own first suffix is the last to keep it.
        ends_here = np.ones(count, bool)
        if count:
            ends_here[:-1] = (least[1:] != least[:-1]) | (core[: count - 1] == least[:-1]) | ~valid[1:]
        starts_here = np.concatenate([[True], ends_here[:-1]])[:count] | ~np.concatenate([[False], valid[:-1]])[:count]
        self.first, last = np.flatnonzero(valid & starts_here), np.flatnonzero(valid & ends_here)
        self.size = last - self.first + 1
        self.key = mixed(least[self.first])  # minima are small numbers; ranges of the key have to be even
        self.stretch = self.rolling.hashes(self.first, self.size + WINDOW - 1) ^ mixed(self.size.astype(np.uint64))
        self.buffer = buffer
        self.text = text[self.first]
        self.position = self.first - self.starts[self.text]

    @cached_property
    def other(self) -> Rolling:
        """The second hash of stretches and windows."""
        return Rolling(self.buffer, 1)

    def second(self) -> np.ndarray:
        return self.other.hashes(self.first, self.size + WINDOW - 1)

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, start in the text and both hashes of all windows that keep the chosen suffixes."""
        sizes = self.size[chosen]
        at = np.repeat(self.first[chosen], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        text = np.repeat(self.text[chosen], sizes)
        return text, at - self.starts[text], self.rolling.hashes(at, WINDOW), self.other.hashes(at, WINDOW)


def minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row, from running minima of blocks in both directions."""
    if len(values) < width:
        return values[:0]
    rest = (-len(values)) % width
    blocks = np.concatenate([values, np.full(rest, 2**64 - 1, np.uint64)]).reshape(-1, width)
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(ahead[:count], behind[width - 1 : width - 1 + count])


def in_order(suffixes: np.ndarray) -> np.ndarray:
    return suffixes[np.lexsort((suffixes["second"], suffixes["stretch"], suffixes["key"]))]


def changes(rows: np.ndarray, *names: str) -> np.ndarray:
    """Whether a row of a sorted array differs from the one before."""
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for name in names:
        new[1:] |= rows[name][1:] != rows[name][:-1]
    return new


def sorted_array(suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A batch's array, one suffix for each key, and the suffixes that the batch by itself has found repeated."""
    suffixes = in_order(suffixes)
    new_key, new_stretch = changes(suffixes, "key"), changes(suffixes, "key", "stretch", "second")
    of_key, of_stretch = np.cumsum(new_key) - 1, np.cumsum(new_stretch) - 1
    stretches = np.bincount(of_key, new_stretch)
    whole, mixed_up = np.bincount(of_stretch)[of_stretch] > 1, stretches[of_key] > 1
    suffixes["flags"] = WHOLE * whole + COUNTED * (mixed_up & (~whole | new_stretch))
    suffixes["settled"] = whole
    return suffixes[new_key], suffixes[suffixes["flags"] > 0]


class Family:
    """Sorted levels of suffixes of one key range, each about twice the next one's size or more.

    A level has every stretch once; suffixes that meet their like when levels are merged leave for ``told``.
    """

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []
        self.told: list[np.ndarray] = []

    def add(self, array: np.ndarray) -> None:
        for level in self.levels:
            scan(array, level)
        self.levels.append(array)
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            self.levels.append(self.merged(self.levels.pop(), self.levels.pop()))

    def merged(self, later: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        """Two sorted levels as one; of equal stretches the first stays, with the wish to be counted of both."""
        rows = in_order(np.concatenate([earlier, later]))
        new = changes(rows, "key", "stretch", "second")
        again = np.flatnonzero(~new)
        rows["flags"][again - 1] |= rows["flags"][again] & COUNTED
        left = rows[again]
        left["flags"] &= WHOLE
        self.told.append(told_of(left))
        return rows[new]

    def found(self) -> np.ndarray:
        """Suffixes with something to tell."""
        return np.concatenate([np.empty(0, SUFFIX), *self.told, *map(told_of, self.levels)])


def told_of(suffixes: np.ndarray) -> np.ndarray:
    """Those with something to tell; what its batch has found whole only needs counting."""
    suffixes["flags"] = np.where(suffixes["settled"] == 1, suffixes["flags"] & COUNTED, suffixes["flags"])
    return suffixes[suffixes["flags"] > 0]


def scan(array: np.ndarray, level: np.ndarray) -> None:
    """Flags what a batch's array, with every key once, and a level share.

    Of several suffixes with one key in a level all have been flagged to be counted before.
    """
    low, high = (np.searchsorted(level["key"], array["key"], side) for side in ("left", "right"))
    met = np.flatnonzero(low < high)
    low, high, wanted = low[met], high[met], array["stretch"][met]
    several = high - low > 1
    left, right = low.copy(), high - 1
    while len(halved := np.flatnonzero(left < right)):
        middle = (left[halved] + right[halved]) >> 1
        less = level["stretch"][middle] < wanted[halved]
        left[halved[less]], right[halved[~less]] = middle[less] + 1, middle[~less]
    same = (level["stretch"][left] == wanted) & (level["second"][left] == array["second"][met])
    array["flags"][met] |= np.where(same, WHOLE, COUNTED).astype(np.uint8) | np.where(several, COUNTED, 0).astype(np.uint8)
    level["flags"][left[same]] |= WHOLE
    level["flags"][low[~same & ~several]] |= COUNTED


def dealt(rows: np.ndarray, part: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for number in np.flatnonzero(np.diff(cuts)).tolist():
        yield number, columnar(rows[order[cuts[number] : cuts[number + 1]]])


def columnar(rows: np.ndarray) -> bytes:
    """Packed rows field by field; shuffles compress like values next to each other better than hashes between them."""
    return b"".join(rows[name].tobytes() for name in rows.dtype.names)


def unpacked(chunks: list[bytes], kind: np.dtype) -> np.ndarray:
    rows = np.empty(sum(map(len, chunks)) // kind.itemsize, kind)
    end = 0
    for chunk in chunks:
        start, end, at = end, end + len(chunk) // kind.itemsize, 0
        for name in kind.names:
            field = kind[name]
            rows[name][start:end] = np.frombuffer(chunk, field, end - start, at)
            at += field.itemsize * (end - start)
    return rows


def as_rows(kind: str, pairs: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], t) for i, t in enumerate([*([pa.int64()] * (len(names) - 1)), pa.binary()])], list(names))


def batch_arrays(parts: int):
    """``part`` and packed suffixes: first of sorted arrays (by key range), then of what is settled (anywhere)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(held)
            held.clear()
            array, settled = sorted_array(rows)
            del rows
            settled["settled"] = 2
            yield as_rows("arrays", list(dealt(array, range_of(array["key"], parts), parts)), ("part", "suffixes"))
            del array
            yield as_rows("arrays", list(dealt(settled, part_of(settled["doc"], settled["text"], parts), parts)), ("part", "suffixes"))

        for part in slices(batches, "text", SLICE_BYTES):
            texts = as_bytes(part, "text")
            found = Suffixes(texts)
            rows = np.zeros(len(found.key), SUFFIX)
            rows["key"], rows["stretch"], rows["second"], rows["first"] = found.key, found.stretch, found.second(), found.position
            rows["doc"] = part.column("doc").to_numpy()[found.text]
            rows["text"] = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64)[found.text]
            if len(rows):
                held.append(rows)
            size += sum(map(len, texts))
            if size >= BATCH_BYTES and held:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    return run


def range_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def part_of(ids: np.ndarray, more: np.ndarray, parts: int) -> np.ndarray:
    """By two numbers, so that texts with one id are dealt too."""
    return range_of(mixed(ids.astype(np.int64).view(np.uint64) ^ mixed(more.astype(np.uint64))), parts)


def merge_scan(parts: int):
    """What the families of this partition's key ranges tell of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        families: dict[int, Family] = {}
        settled = []
        for batch in batches:
            for part, packed in zip(batch.column("part").to_pylist(), batch.column("suffixes").to_pylist()):
                rows = unpacked([packed], SUFFIX)
                if rows["settled"][0] == 2:
                    settled.append(rows)
                else:
                    rows["flags"] = 0
                    families.setdefault(part, Family()).add(rows)
        for rows in (*settled, *(f.found() for f in families.values())):
            told = np.empty(len(rows), TOLD)
            for name in TOLD.names:
                told[name] = rows[name]
            yield as_rows("told", list(dealt(told, part_of(told["doc"], told["text"], parts), parts)), ("part", "told"))

    return run


def gathered(kind: np.dtype, by: tuple[str, ...], value: np.dtype, name: str):
    """One row for each text with all that is told of it in this partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = [x for batch in batches for x in batch.column("told").to_pylist()]
        rows = unpacked(packed, kind)
        rows = rows[np.lexsort([rows[c] for c in by[::-1]])]
        values = np.empty(len(rows), value)
        for field in value.names:
            values[field] = rows[field]
        new = np.zeros(max(0, len(rows) - 1), bool)
        for c in by:
            new |= rows[c][1:] != rows[c][:-1]
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(rows)] if len(rows) else []
        signed = [rows[c].astype(np.int64) for c in by]
        out = [(*(int(c[a]) for c in signed), values[a:b].tobytes()) for a, b in zip(edges, edges[1:])]
        for low in range(0, len(out), 4096):
            yield as_rows(name, out[low : low + 4096], (*by, name))

    return run


def spans(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of what stretches cover together; touching ones become one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order].astype(np.int64), np.maximum.accumulate((starts + lengths)[order].astype(np.int64))
    new = np.concatenate([[True], starts[1:] > ends[:-1]]) if len(starts) else np.zeros(0, bool)
    return starts[new], ends[np.concatenate([new[1:], [True]])] if len(starts) else ends


def kept_bytes(text: bytes, removed: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """The pieces of a text that remain."""
    edges = [0, *np.column_stack(removed).ravel().tolist(), len(text)]
    return [text[a:b] for a, b in zip(edges[::2], edges[1::2])]


Finish = Callable[[bytes, tuple[np.ndarray, np.ndarray]], tuple]


def resolved(columns: list[str], finish: Finish, kinds: list[pa.DataType], names: list[str]):
    """What ``finish`` says of each text whose marks need no counting; the others pass with text and marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text", SLICE_BYTES):
            texts, marks = as_bytes(part, "__text"), part.column("__marks").to_pylist()
            found = Suffixes([t for t, m in zip(texts, marks) if m])
            place, done, again, packed = -1, [], [], []
            bounds = np.searchsorted(found.text, np.arange(sum(map(bool, marks)) + 1))
            for text, own in zip(texts, marks):
                removed = np.empty(0, np.int64), np.empty(0, np.int64)
                told = np.empty(0, MARK)
                if own:
                    place += 1
                    told = np.frombuffer(b"".join(own), MARK)
                    mine = slice(bounds[place], bounds[place + 1])
                    whole = np.isin(found.position[mine], told["first"][(told["flags"] & WHOLE) > 0])
                    removed = spans(found.position[mine][whole], found.size[mine][whole] + WINDOW - 1)
                counted = (told["flags"] & COUNTED > 0).any()
                again.append(text if counted else None)
                packed.append((np.unique(told["first"][told["flags"] & COUNTED > 0]).astype("<u4").tobytes(), np.column_stack(removed).astype("<i8").tobytes()) if counted else (None, None))
                done.append((None,) * len(kinds) if counted else finish(text, removed))
            arrays = [*(part.column(c) for c in columns), *(pa.array([d[i] for d in done], k) for i, k in enumerate(kinds))]
            arrays += [pa.array(again, pa.binary()), *(pa.array([p[i] for p in packed], pa.binary()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, *names, "__bytes", "__counted", "__removed"])

    return run


def counted_windows(parts: int):
    """Windows to be counted: those a slice has once, and of those it has more often one for all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__bytes", SLICE_BYTES):
            found = Suffixes(as_bytes(part, "__bytes"))
            wanted = [np.frombuffer(x, "<u4") for x in part.column("__counted").to_pylist()]
            keys = np.concatenate([(np.int64(i) << 32) | w for i, w in enumerate(wanted)])
            chosen = np.flatnonzero(np.isin((found.text.astype(np.int64) << 32) | found.position, keys))
            for low in range(0, len(chosen), 1 << 14):
                text, start, hashes, second = found.windows(chosen[low : low + (1 << 14)])
                rows = np.zeros(len(text), COUNT)
                rows["hash"], rows["second"], rows["start"], rows["number"] = hashes, second, start, part.column("__number").to_numpy()[text]
                again = repeated(rows)
                answered = again.copy()
                answered["kind"] = ANSWERED
                yield as_rows("windows", list(dealt(answered, part_of(answered["number"], answered["start"], parts), parts)), ("part", "windows"))
                rows["kind"] = np.where(changes(rows, "hash", "second"), rows["kind"], ANSWERED)
                rows = rows[rows["kind"] != ANSWERED]
                yield as_rows("windows", list(dealt(rows, range_of(rows["hash"], parts), parts)), ("part", "windows"))

    return run


def repeated(rows: np.ndarray) -> np.ndarray:
    """Sorts windows in place, marks those found twice or more as ``FOR_MANY`` and returns these."""
    rows[:] = rows[np.lexsort((rows["second"], rows["hash"]))]
    group = np.cumsum(changes(rows, "hash", "second")) - 1
    rows["kind"] = np.where(np.bincount(group, minlength=1)[group] > 1, FOR_MANY, ASKED) if len(rows) else rows["kind"]
    return rows[rows["kind"] == FOR_MANY]


def count_windows(parts: int):
    """The starts of windows that were found twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def told(rows: np.ndarray) -> pa.RecordBatch:
            found = np.empty(len(rows), FOUND)
            found["number"], found["start"] = rows["number"], rows["start"]
            return as_rows("told", list(dealt(found, part_of(found["number"], np.zeros(len(found)), parts), parts)), ("part", "told"))

        for batch in batches:
            rows = unpacked(batch.column("windows").to_pylist(), COUNT)
            held.append(rows[rows["kind"] != ANSWERED])
            yield told(rows[rows["kind"] == ANSWERED])
        if held:
            rows = np.concatenate(held)
            rows = rows[np.lexsort((rows["second"], rows["hash"]))]
            known = rows["kind"] == FOR_MANY
            group = np.cumsum(changes(rows, "hash", "second")) - 1
            often = (np.bincount(group, minlength=1) > 1) | (np.bincount(group, known, minlength=1) > 0)
            yield told(rows[~known & often[group]] if len(rows) else rows)

    return run


def finished(columns: list[str], finish: Finish, kinds: list[pa.DataType], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__bytes", SLICE_BYTES):
            done = []
            for text, removed, starts in zip(*(part.column(c).to_pylist() for c in ("__bytes", "__removed", "__starts"))):
                whole = np.frombuffer(removed, "<i8").reshape(-1, 2)
                single = np.frombuffer(b"".join(starts or []), "<u4").astype(np.int64)
                every = np.concatenate([whole[:, 0], single]), np.concatenate([whole[:, 1] - whole[:, 0], np.full(len(single), WINDOW)])
                done.append(finish(text, spans(*every)))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *(pa.array([d[i] for d in done], k) for i, k in enumerate(kinds))], [*columns, *names])

    return run


def by_part(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartitionById(parts, F.col("part").cast("int"))


def remove_repeats(docs: DataFrame, finish: Finish, schema: T.StructType, kinds: list[pa.DataType], keep: list[str], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The columns ``keep`` of each row and what ``finish`` makes of its bytes and the spans to remove.

    A byte goes if some ``WINDOW`` bytes around it start anywhere else too, in the same text or another; windows are
    judged on the texts as they come, and never cross texts. A null text is empty. A repeated row is another text.
    Texts are held by id and a hash, so ids may repeat or be null; columns may have any names.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = schema.names
    number = F.coalesce(column(id_column).cast("long"), F.lit(-(2**63)))
    rows = docs.select(number.alias("doc"), column(text_column).cast("string").alias("text"))
    arrays = rows.mapInArrow(batch_arrays(parts), "part long, suffixes binary")
    told = by_part(arrays, parts).mapInArrow(merge_scan(parts), "part long, told binary")
    marks = by_part(told, parts).mapInArrow(gathered(TOLD, ("doc", "text"), MARK, "marks"), "doc long, text long, marks binary")
    marks = marks.select("doc", "text", F.array("marks").alias("__marks"))
    held = docs.select(F.struct(*[column(c) for c in keep]).alias("row"), column(text_column).cast("string").alias("__text"), number.alias("__doc"))
    hashed = held.mapInArrow(with_text_hash, T.StructType([*held.schema.fields, T.StructField("__hash", T.LongType())]))
    joined = hashed.join(marks, (F.col("__doc") == F.col("doc")) & (F.col("__hash") == F.col("text")), "left").select("row", "__text", "__marks")
    out = joined.schema["row"]
    extra = [T.StructField(c, T.BinaryType()) for c in ("__bytes", "__counted", "__removed")]
    first = joined.mapInArrow(resolved(["row"], finish, kinds, names), T.StructType([out, *schema.fields, *extra]))
    first = stored(first.withColumn("__number", F.monotonically_increasing_id()), "first-scan")
    open_ones = first.where("__bytes IS NOT NULL")
    windows = open_ones.select("__bytes", "__counted", "__number").mapInArrow(counted_windows(parts), "part long, windows binary")
    found = by_part(windows, parts).mapInArrow(count_windows(parts), "part long, told binary")
    starts = by_part(found, parts).mapInArrow(gathered(FOUND, ("number",), np.dtype([("start", "<u4")]), "starts"), "number long, starts binary")
    starts = starts.select("number", F.array("starts").alias("__starts"))
    last = open_ones.join(starts, F.col("__number") == F.col("number"), "left").select("row", "__bytes", "__removed", "__starts")
    last = last.mapInArrow(finished(["row"], finish, kinds, names), T.StructType([out, *schema.fields]))
    every = first.where("__bytes IS NULL").select("row", *names).unionByName(last)
    return every.select(*[F.col("row").getField(c).alias(c) for c in keep], *names)


def with_text_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "__text"):
        hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in as_bytes(part, "__text")], np.uint64).astype(np.int64)
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(hashes)], [*part.schema.names, "__hash"])


def digest(text: bytes, removed: tuple[np.ndarray, np.ndarray]) -> tuple:
    lost = np.column_stack(removed)
    return len(text), lost.tolist(), hashlib.sha256(b"".join(kept_bytes(text, removed))).hexdigest()


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, the removed ``spans`` (start and end in bytes) and ``kept_sha256`` of what is left."""
    schema = T.StructType().add("n_bytes", "long").add("spans", T.ArrayType(T.ArrayType(T.LongType()))).add("kept_sha256", "string")
    return remove_repeats(docs, digest, schema, [pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string()], ["doc_id"])


def left_text(text: bytes, removed: tuple[np.ndarray, np.ndarray]) -> tuple:
    return "".join(piece.decode("utf-8", "ignore") for piece in kept_bytes(text, removed)), bool(text)


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` with repeated strings cut out of ``text``.

    Characters that a cut would split go too. Rows of which nothing is left, and that had a text, are dropped; null
    texts become empty.
    """
    rows = docs.select(F.struct(*[column(c) if c != "text" else F.lit(None).alias(c) for c in docs.columns]).alias("whole"), column("text").cast("string").alias("text"))
    cut = remove_repeats(rows.withColumn("doc_id", F.col("whole").getField("doc_id")), left_text, T.StructType().add("left", "string").add("had", "boolean"), [pa.string(), pa.bool_()], ["whole"])
    cut = cut.where((F.col("left") != "") | ~F.col("had"))
    return cut.select(*[F.col("left").alias(c) if c == "text" else F.col("whole").getField(c).alias(c) for c in docs.columns])


def span_length(spans_: Column) -> Column:
    return F.aggregate(spans_, F.lit(0).cast("long"), lambda total, s: total + s[1] - s[0])


def suffix_report(docs: DataFrame) -> DataFrame:
    found = repeated_spans(docs)
    return found.select("doc_id", "n_bytes", span_length(F.col("spans")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
