"""Scores of texts by a hidden Markov language model.

States emit symbols: the most frequent words are symbols of their own, all others share one by their ending. A word
that shares a symbol follows from it by its count, so the model gives every word a probability. Counts of all words,
and the expected counts of every Baum-Welch round, are sums over all whole training texts, aggregated across partitions.
Rounds go on until one gains next to nothing. Scores are exact: the scaled forward recursion over the whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import slices
from tidemark.llm.components import stored
from tidemark.session import column

# Fixed values of the base score and the endings.
ADDED, ENDING = 0.1, 3
# Parameters of the model.
HEAD_WORDS, ENDINGS, STATES, ADDED_EMISSIONS = 32_768, 4_096, 8, 20
# Training ends when a round raises the objective by no more than this share of it.
TOLERANCE = 1e-4
# Symbols whose forward probabilities are held at a time and whose counts are added at a time, places from one scaling
# to the next, texts read side by side (at most, and at least if there are so many) and bytes of texts read at a time.
HELD, TOLD, SCALED, SIDE_BY_SIDE, NARROWEST, TRAIN_BYTES = 1 << 20, 1 << 16, 8, 2_048, 512, 16 << 20
# Length of the texts that tests read in parts.
STRETCH = 64
COUNTER_WORDS, SLICE_BYTES = 200_000, 4 << 20
BLOCK, SALTS = 8_192, 16
# Steps in which counts grow e-fold; a corpus has a few thousand of them at most.
STEPS_OF_E = 64
HASH_PARTS = 1 << 20


def ending(word: bytes) -> int:
    return zlib.crc32(word[-ENDING:]) % ENDINGS


def ending_of(word: Column) -> Column:
    """The same for a binary column."""
    return F.crc32(F.substr(word, F.greatest(F.octet_length(word) - ENDING + 1, F.lit(1)), F.lit(ENDING))) % ENDINGS


def numbered(part: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of a slice, the number of each of its words among them, and how many words each text has."""
    # Arrow's functions on strings misread part of a longer array; a copy starts at its own beginning.
    text = pc.fill_null(part.column("text"), "").take(pa.array(np.arange(part.num_rows)))
    split = pc.ascii_split_whitespace(pc.ascii_lower(text))
    words = split.flatten()
    kept = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # white space at an end leaves an empty one
    before = np.concatenate([[0], np.cumsum(kept)])
    coded = words.filter(pa.array(kept)).cast(pa.binary()).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.diff(before[split.offsets.to_numpy()])


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their counts, added up as far as memory allows."""

    def told(counts: list[pa.RecordBatch]) -> pa.RecordBatch:
        sums = pa.Table.from_batches(counts).group_by("word", use_threads=False).aggregate([("n", "sum")]).combine_chunks()
        return pa.RecordBatch.from_arrays([sums["word"].chunk(0), sums["n_sum"].chunk(0)], ["word", "n"])

    counts: list[pa.RecordBatch] = []
    for part in slices(batches, "text", SLICE_BYTES):
        words, codes, _ = numbered(part)
        if len(words):
            counts.append(pa.RecordBatch.from_arrays([words, pa.array(np.bincount(codes, minlength=len(words)))], ["word", "n"]))
        if sum(map(len, counts)) > COUNTER_WORDS:
            counts = [told(counts)]
            if len(counts[0]) > COUNTER_WORDS:
                yield counts.pop()
    if counts:
        yield told(counts)


@dataclass
class Vocabulary:
    """What is known of all words: symbols and counts of frequent ones, and sums over each ending of the others."""

    head: dict[bytes, int]
    head_counts: np.ndarray
    texts: int
    tokens: int
    distinct: int
    ending_tokens: np.ndarray
    ending_words: np.ndarray

    @property
    def end(self) -> int:
        return len(self.head)

    @property
    def symbols(self) -> int:
        return len(self.head) + 1 + ENDINGS

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ADDED) / (self.tokens + ADDED * (self.distinct + 1)))

    def shares(self) -> np.ndarray:
        """Of each symbol among the training tokens, none zero."""
        counts = np.concatenate([self.head_counts, [self.texts], self.ending_tokens]) + ADDED
        return counts / counts.sum()


def learn_words(training: DataFrame, head_words: int) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and all words with their counts."""
    counts = stored(training.select("text").mapInArrow(count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    words, tokens = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    texts = training.count()
    # The most frequent words by steps of their count's logarithm, as many steps as stay within head_words. Sorting for
    # them would send that many words from every partition to the driver.
    step = F.floor(F.log("n") * STEPS_OF_E)
    # Of the step that does not fit as a whole, words are taken by hash.
    chosen, total = F.lit(False), 0
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():  # at most one for each step
        chosen = step > row["step"]
        if total + row["count"] > head_words:
            share = (head_words - total) * HASH_PARTS // row["count"]
            chosen |= (step == row["step"]) & (F.pmod(F.xxhash64("word"), F.lit(HASH_PARTS)) < share)
            break
        total += row["count"]
        chosen |= step == row["step"]
    head = counts.where(chosen)
    top = sorted(head.collect(), key=lambda r: (-r.n, bytes(r.word)))  # bounded by head_words
    rest = counts.join(F.broadcast(head.select("word")), "word", "left_anti").groupBy(ending_of(F.col("word")).alias("ending")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    sums = np.zeros((2, ENDINGS))
    for row in rest:  # one for each ending
        sums[:, row.ending] = row.n, row.words
    known = {bytes(r.word): i for i, r in enumerate(top)}
    return Vocabulary(known, np.array([r.n for r in top], float), texts, tokens + texts, words + (texts > 0), *sums), counts


def encoded(head: dict[bytes, int]):
    """Symbols of each text (16 bits each, an end behind) and its words that are no symbols of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = len(head)
        for part in slices(batches, "text", SLICE_BYTES):
            words, codes, sizes = numbered(part)
            texts = np.arange(len(sizes))
            # As an array of objects: a list would make a scalar of Arrow of each word first.
            listed = words.to_numpy(zero_copy_only=False)
            symbol_of = np.fromiter((head[w] if w in head else end + 1 + ending(w) for w in listed), "<u2", len(words))
            symbols, text = np.full(len(codes) + len(sizes), end, "<u2"), np.repeat(texts, sizes)
            symbols[np.arange(len(codes)) + text] = symbol_of[codes]
            edges = np.concatenate([[0], 2 * np.cumsum(sizes + 1)]).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(symbols)])
            rare = (symbol_of > end)[codes]
            pairs, times = np.unique(text[rare] * len(words) + codes[rare], return_counts=True)
            own = pa.StructArray.from_arrays([words.take(pa.array(pairs % max(1, len(words)))), pa.array(times)], ["word", "n"])
            listed = pa.ListArray.from_arrays(pa.array(np.searchsorted(pairs, np.arange(len(sizes) + 1) * len(words)), pa.int32()), own)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), packed, listed], ["doc_id", "held_out", "symbols", "others"])

    return run


@dataclass
class Model:
    """Start (the first row), transition and emission probabilities."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray

    @classmethod
    def first(cls, shares: np.ndarray, states: int) -> Model:
        """States that stay as they are, with emissions drawn around the shares of symbols."""
        emits = shares[:, None] * np.random.default_rng(17).uniform(0.2, 1.8, (len(shares), states))
        moves = np.full((states, states), 0.1 / max(1, states - 1))
        np.fill_diagonal(moves, 0.9 if states > 1 else 1.0)
        return cls(np.full((2, states), 1 / states), moves, emits / emits.sum(axis=0))

    @classmethod
    def of(cls, counts: np.ndarray, shares: np.ndarray, states: int) -> Model:
        """From expected counts, with some more in proportion to the shares of symbols."""
        start, moves, emits = parted(counts, states)
        start, moves, emits = start + 1, moves + 1, emits + ADDED_EMISSIONS * shares[:, None]
        return cls(start / start.sum(axis=1, keepdims=True), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))

    def prior(self, shares: np.ndarray) -> float:
        """What the additions of ``of`` weigh: with it, no round lowers the log-likelihood."""
        return float(np.log(self.start).sum() + np.log(self.moves).sum() + ADDED_EMISSIONS * (shares @ np.log(self.emits)).sum())


def parted(counts: np.ndarray, states: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, b = 2 * states, 2 * states + states * states
    return counts[:a].reshape(2, states), counts[a:b].reshape(states, states), counts[b:].reshape(-1, states)


def flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.fromiter((len(t) // 2 for t in texts), np.int64, len(texts))
    return np.frombuffer(b"".join(texts), "<u2"), np.cumsum(sizes) - sizes, sizes


def side_by_side(sizes: np.ndarray) -> Iterator[slice]:
    """Texts, by falling length, that are read side by side: few enough to hold all their symbols, many enough for a step."""
    low = 0
    while low < len(sizes):
        high = low + min(SIDE_BY_SIDE, max(NARROWEST, HELD // int(sizes[low])))
        yield slice(low, high)
        low = high


def expected(model: Model, texts: list[bytes], counts: np.ndarray, times: np.ndarray | None = None) -> float:
    """Adds the expected counts of the texts, forward and backward side by side, and returns their log-likelihood.

    A text counts as often as ``times`` says (once, unless given). Whole texts are read. Forward probabilities are scaled
    at every ``SCALED``-th place only. They are held for all places if these have about ``HELD`` symbols or fewer. Else
    they are kept before each stretch of about that many symbols, and those within a stretch are found again on the way
    back, unless it is the last.
    """
    states = model.moves.shape[0]
    start, moves, emits = parted(counts, states)
    symbols, begins, sizes = flat(texts)
    order = np.argsort(-sizes, kind="stable")
    emits_of, moves_to, moves_from = map(np.ascontiguousarray, (model.emits, model.moves, model.moves.T))  # a row for each symbol
    pairs, sums, ones, total = np.zeros_like(moves), np.zeros((states, len(emits))), np.ones(states), 0.0
    room, width = min(HELD + SIDE_BY_SIDE, len(symbols)), min(SIDE_BY_SIDE, len(order))
    ahead, seen = np.empty((room, states)), np.empty(room, np.intp)  # place by place
    given, told, back = (np.empty((width, states)) for _ in range(3))
    weights = np.empty((states, min(TOLD + SIDE_BY_SIDE, len(symbols))))  # states first, as counts are added state by state

    for texts_of in side_by_side(sizes[order]):
        own = order[texts_of]
        begin, longest = begins[own], int(sizes[own[0]])
        often = np.ones(len(own)) if times is None else times[own].astype(float)
        live = len(own) - np.searchsorted(sizes[own][::-1], np.arange(longest + 1), side="right")  # longer than t
        until = np.cumsum(live)
        firsts = [0, *(np.flatnonzero(np.diff((until[:longest] - 1) // HELD)) + 1).tolist()]
        live = live.tolist()

        def forward(first: int, last: int, now: np.ndarray | None) -> tuple[list[int], dict[int, np.ndarray]]:
            """Fills in a stretch; where its places begin, and their scales."""
            at, scales = [0], {}
            for t in range(first, last):
                i, n = at[-1], live[t]
                at.append(i + n)
                here, likely = ahead[i : i + n], given[:n]
                seen[i : i + n] = symbols[begin[:n] + t]
                emits_of.take(seen[i : i + n], axis=0, out=likely, mode="clip")
                if t:
                    np.matmul(now[:n], moves_to, out=here)
                    here *= likely
                else:
                    np.multiply(model.start[0], likely, out=here)
                if t % SCALED == SCALED - 1:
                    scales[t] = here @ ones
                    here /= scales[t][:, None]
                now = here
            return at, scales

        before: list[np.ndarray | None] = [None]
        for first, last in zip(firsts, firsts[1:]):
            at, _ = forward(first, last, before[-1])
            before.append(ahead[at[-2] : at[-1]].copy())
        begun = 0  # texts that the way back has come to
        for first, last in zip(reversed(firsts), [longest, *reversed(firsts[1:])]):
            at, scales = forward(first, last, before[-1])
            top = at[-1]  # of the symbols whose weights are not added yet
            for t in range(last - 1, first - 1, -1):
                i, n = at[t - first], at[t - first + 1] - at[t - first]
                here = ahead[i : i + n]
                if begun < n:  # texts that end here
                    scale = here[begun:] @ ones
                    total += float(np.log(scale) @ often[begun:n])
                    back[begun:n] = (often[begun:n] / scale)[:, None]
                    begun = n
                if t in scales:
                    total += float(np.log(scales[t]) @ often[:n])
                low_end = weights.shape[1] - (top - i)
                np.multiply(here, back[:n], out=told[:n])
                weights[:, low_end : low_end + n] = told[:n].T
                if t:
                    weighted = given[:n]
                    emits_of.take(seen[i : i + n], axis=0, out=weighted, mode="clip")
                    weighted *= back[:n]
                    if t in scales:
                        weighted /= scales[t][:, None]
                    earlier = ahead[at[t - first - 1] : i] if t > first else before[-1]
                    pairs += earlier[:n].T @ weighted
                    np.dot(weighted, moves_from, out=back[:n])
                else:
                    start[0] += told[:n].sum(axis=0)
                if top - i >= TOLD or t == first:
                    for k in range(states):
                        sums[k] += np.bincount(seen[i:top], weights[k, low_end:], len(emits))
                    top = i
            before.pop()
    emits += sums.T
    moves += pairs * model.moves
    return total


def likelihood(model: Model, texts: list[bytes]) -> np.ndarray:
    """log10 of the probability of each text's symbols, by the forward recursion over all texts side by side."""
    symbols, begins, sizes = flat(texts)
    order = np.argsort(-sizes, kind="stable")
    begin, out = begins[order], np.zeros(len(texts))
    live = (len(order) - np.searchsorted(sizes[order][::-1], np.arange(sizes.max(initial=0) + 1), side="right")).tolist()
    emits_of, moves_to = np.ascontiguousarray(model.emits), np.ascontiguousarray(model.moves)  # a row for each symbol
    ones = np.ones(len(moves_to))
    now = np.repeat(model.start[:1], len(order), axis=0)
    for t, (n, rest) in enumerate(zip(live, live[1:])):
        now = now if t == 0 else now @ moves_to
        now *= emits_of.take(symbols[begin[:n] + t], axis=0, mode="clip")
        if t % SCALED == SCALED - 1:
            total = now @ ones
            out[:n] += np.log10(total)
            now /= total[:, None]
        if rest < n:  # texts that end here
            out[rest:n] += np.log10(now[rest:] @ ones)
            now = now[:rest]
    result = np.empty(len(texts))
    result[order] = out
    return result


def expectation(model: Model):
    """The expected counts of a partition's sequences and their log-likelihood, in packed blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, times, size, any_text = np.zeros(2 * STATES + STATES**2 + model.emits.size + 1), [], [], 0, False
        for part in slices(batches, "symbols", SLICE_BYTES):
            held += part.column("symbols").to_pylist()
            times.append(part.column("times").to_numpy())
            size += part.column("symbols").nbytes
            any_text = True
            if size >= TRAIN_BYTES:
                counts[-1] += expected(model, held, counts[:-1], np.concatenate(times))
                held, times, size = [], [], 0
        if any_text:
            counts[-1] += expected(model, held, counts[:-1], np.concatenate([np.empty(0, np.int64), *times]))
            yield blocks({i: counts[low : low + BLOCK] for i, low in enumerate(range(0, len(counts), BLOCK))}, int(counts.sum() * 1000) % SALTS)

    return run


def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal sequences of a slice as one, with how often they are there."""
    for part in slices(batches, "symbols", SLICE_BYTES):
        times: dict[bytes, int] = {}
        for sequence, n in zip(part.column("symbols").to_pylist(), part.column("times").to_pylist()):
            times[sequence] = times.get(sequence, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(times), pa.binary()), pa.array(list(times.values()), pa.int64())], ["symbols", "times"])


def training_sequences(rows: DataFrame) -> DataFrame:
    """``symbols`` and ``times``: equal sequences of the training rows once, dealt by length.

    Texts that are read side by side take as many steps as the longest of them, so a partition gets texts of like
    length, and each length as many partitions as its share of all symbols.
    """
    spark = rows.sparkSession
    sequences = rows.where("not held_out").select("symbols", F.lit(1).cast("long").alias("times"))
    length = F.floor(F.log2(F.octet_length("symbols").cast("double"))).cast("int")
    by_length = {r.length: r.size for r in sequences.groupBy(length.alias("length")).agg(F.sum(F.octet_length("symbols").cast("long")).alias("size")).collect()}  # 31 at most
    total = sum(by_length.values())
    wanted = max(spark.sparkContext.defaultParallelism, -(-total // TRAIN_BYTES))
    parts = {n: max(1, -(-size * wanted // total)) for n, size in sorted(by_length.items())}
    first, place, end = {}, F.lit(0), 0
    for n, count in parts.items():
        first[n], end = end, end + count
        place = F.when(length == n, first[n] + F.pmod(F.xxhash64("symbols"), F.lit(count))).otherwise(place)
    kind = "symbols binary, times long"
    dealt = sequences.mapInArrow(collapsed, kind).repartitionById(max(1, end), place.cast("int"))
    return stored(dealt.sortWithinPartitions(F.octet_length("symbols"), F.xxhash64("symbols")).mapInArrow(collapsed, kind), "sequences")


def blocks(sums: dict[int, np.ndarray], salt: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([salt] * len(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["block", "salt", "counts"])


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            sums[block] = sums.get(block, 0) + np.frombuffer(packed)
    if sums:
        yield blocks(sums, 0)


def train(rows: DataFrame, words: Vocabulary) -> Model:
    """Baum-Welch over all training texts, until a round gains next to nothing."""
    shares = words.shares()
    model, last = Model.first(shares, STATES), None
    training = training_sequences(rows)
    kind = "block int, salt int, counts binary"
    while True:
        sums = training.mapInArrow(expectation(model), kind).repartition("block", "salt").mapInArrow(added, kind).repartition("block").mapInArrow(added, kind)
        found = {r.block: np.frombuffer(r.counts) for r in sums.collect()}  # as large as the model
        if not found:
            return model
        counts = np.concatenate([found[i] for i in sorted(found)])
        objective = counts[-1] + model.prior(shares)
        if last is not None and objective - last <= TOLERANCE * abs(objective):
            return model
        model, last = Model.of(counts[:-1], shares, STATES), objective


def scored(model: Model, words: Vocabulary):
    base = np.concatenate([words.base(np.append(words.head_counts, words.texts)), np.zeros(ENDINGS)])
    known = np.concatenate([np.append(words.head_counts, words.texts) > 0, np.zeros(ENDINGS, bool)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "symbols", SLICE_BYTES):
            texts = part.column("symbols").to_pylist()
            symbols, begins, sizes = flat(texts)
            sums = [np.add.reduceat(values[symbols], begins) for values in (base, known.astype(np.int64))]
            arrays = [part.column("number"), pa.array(sizes), pa.array(sums[1]), pa.array(sums[0]), pa.array(likelihood(model, texts))]
            yield pa.RecordBatch.from_arrays(arrays, ["number", "n_tokens", "n_known", "base_score", "score"])

    return run


def score_documents(docs: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text", head_words: int = HEAD_WORDS) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of each row.

    The model learns from rows where ``held_out`` (a condition on the columns) is false. A null text is an end alone;
    repeated rows each count and get equal scores; other columns are not read. Without training texts every symbol is
    as likely as another and ``train_tokens`` is 0.
    """
    rows = docs.select(column(id_column).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), column(text_column).cast("string").alias("text"))
    words, counts = learn_words(rows.where("not held_out"), head_words)
    kind = rows.schema["doc_id"].dataType.simpleString()
    texts = rows.mapInArrow(encoded(words.head), f"doc_id {kind}, held_out boolean, symbols binary, others array<struct<word:binary,n:bigint>>")
    texts = stored(texts.withColumn("number", F.monotonically_increasing_id()), "symbols")
    model = train(texts, words)
    scores = texts.select("number", "symbols").mapInArrow(scored(model, words), "number long, n_tokens long, n_known long, base_score double, score double")
    totals = docs.sparkSession.createDataFrame(
        [(i, float(np.log10(words.tokens + ADDED * (words.distinct + 1))), float(np.log10(t + ADDED * (w + 1)))) for i, (t, w) in enumerate(zip(words.ending_tokens, words.ending_words))],
        "ending long, of_all double, of_ending double",
    )
    others = texts.select("number", F.explode("others").alias("other")).select("number", "other.word", F.col("other.n").alias("times"))
    # By hash, as sorting the words of all texts would take more time than looking them up.
    counted = others.join(counts.hint("shuffle_hash"), "word", "left").withColumn("ending", ending_of(F.col("word"))).join(F.broadcast(totals), "ending")  # a row for each ending
    own = F.log10(F.coalesce("n", F.lit(0)) + ADDED)
    sums = counted.groupBy("number").agg(
        F.sum(F.col("times") * (own - F.col("of_all"))).alias("base_rest"),
        F.sum(F.col("times") * (own - F.col("of_ending"))).alias("rest"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known_rest"),
    )
    joined = texts.select("number", "doc_id", "held_out").join(scores, "number").join(sums, "number", "left")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known_rest", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base_rest", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rest", F.lit(0.0))).alias("score"),
    )


def scoring_report(docs: DataFrame) -> DataFrame:
    """Learns from ids whose checksum is not divisible by ten; null ids are training rows."""
    return score_documents(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0)
