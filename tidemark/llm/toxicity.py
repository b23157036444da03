"""Toxicity by a factorization machine over hashed terms.

A document's terms are its words and the beginnings of longer ones, hashed to columns. The score adds a weight for
each term and, by the inner product of two short vectors, one for each pair of terms, so that two terms may mean
together what neither does alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import as_bytes, slices
from tidemark.llm.labelled import SAMPLE_ROWS, sample
from tidemark.llm.rolling import Rolling, laid_out, runs
from tidemark.session import column

# Parameters of the model.
TERM_BITS, FACTORS = 17, 4
PREFIXES = (4, 5)
LEAST_CHI_SQUARE = 15.0
EPOCHS, BATCH_ROWS, RATE, FADE = 25, 64, 0.25, 5e-5
THRESHOLD = 0.7
SLICE_BYTES = 1 << 19

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
# Bytes of words: letters, digits, apostrophes and everything beyond ASCII.
WORD = np.zeros(256, bool)
WORD[[*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1), ord("'"), *range(128, 256)]] = True


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all texts: starts of their entries (one more than texts), columns of distinct terms, values."""
    buffer, _, ends = laid_out(texts)
    buffer = LOWER[buffer]
    starts, stops = runs(WORD[buffer])
    hashes, lengths, keys = Rolling(buffer), stops - starts, []
    document = np.searchsorted(ends, starts, side="right")
    for prefix in (None, *PREFIXES):
        chosen = np.flatnonzero(lengths > prefix) if prefix else np.arange(len(starts))
        found = hashes.hashes(starts[chosen], prefix or lengths[chosen]) ^ np.uint64(0 if prefix is None else 2 * prefix + 1)
        keys.append((document[chosen].astype(np.int64) << TERM_BITS) | (found >> np.uint64(64 - TERM_BITS)).astype(np.int64))
    keys, counts = np.unique(np.concatenate(keys), return_counts=True)
    bounds = np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.int64) << TERM_BITS)
    return bounds, keys & ((1 << TERM_BITS) - 1), np.log1p(counts).astype(np.float32)


@dataclass
class Machine:
    """``bias``, a weight and a vector for each column, and the columns in use."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    used: np.ndarray

    def logits(self, bounds: np.ndarray, columns: np.ndarray, values: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.used[columns])
        bounds = np.searchsorted(at, bounds)
        columns, values = columns[at], values[at]
        return forward(self, bounds, columns, values)[0]


def summed(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the rows between bounds."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def forward(m: Machine, bounds, columns, values):
    scaled = m.vectors[columns] * values[:, None]
    sums = summed(scaled, bounds)
    pairs = 0.5 * ((sums**2).sum(1) - summed((scaled**2).sum(1), bounds))
    return m.bias + summed(m.weights[columns] * values, bounds) + pairs, sums, scaled


def probability(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -35, 35)))


def chi_square(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    """Of the table of having a column by class."""
    n, having = n_clean + n_toxic, clean + toxic
    spread = having * (n - having) * float(n_clean) * float(n_toxic)
    return n * (toxic * float(n_clean) - clean * float(n_toxic)) ** 2 / np.maximum(spread, 1)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Machine:
    """By AdaGrad on small batches; rows are columns, values and label. Without both classes every score is 0.

    Only columns whose share of rows differs between the classes by more than chance (chi-square) are used.
    """
    size = 1 << TERM_BITS
    rng = np.random.default_rng(11)
    empty = Machine(-35.0, np.zeros(size), np.zeros((size, FACTORS)), np.zeros(size, bool))
    if len({label for *_, label in rows}) < 2:
        return empty
    seen = [np.bincount(np.concatenate([c for c, _, y in rows if y == label]), minlength=size) for label in (0, 1)]
    m = Machine(0.0, np.zeros(size), rng.normal(0, 0.02, (size, FACTORS)), chi_square(*seen, *np.bincount([y for *_, y in rows], minlength=2)) > LEAST_CHI_SQUARE)
    kept = [(c[m.used[c]], v[m.used[c]], y) for c, v, y in rows]
    square_w, square_v, square_b = np.full(size, 1e-3), np.full((size, FACTORS), 1e-1), 1e-3
    share = np.mean([y for *_, y in kept])
    for _ in range(EPOCHS):
        order = rng.permutation(len(kept))
        for low in range(0, len(order), BATCH_ROWS):
            batch = [kept[i] for i in order[low : low + BATCH_ROWS]]
            bounds = np.cumsum([0, *(len(c) for c, *_ in batch)])
            columns, values = np.concatenate([c for c, *_ in batch]), np.concatenate([v for _, v, _ in batch])
            labels = np.array([y for *_, y in batch])
            logits, sums, scaled = forward(m, bounds, columns, values)
            error = (probability(logits) - labels) * np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / len(batch)
            of = np.repeat(np.arange(len(batch)), np.diff(bounds))
            own, place = np.unique(columns, return_inverse=True)
            grad_w = np.bincount(place, error[of] * values, len(own)) + FADE * m.weights[own]
            inner = (error[of] * values)[:, None] * (sums[of] - scaled)
            grad_v = np.column_stack([np.bincount(place, inner[:, f], len(own)) for f in range(FACTORS)]) + FADE * m.vectors[own]
            grad_b = error.sum()
            square_w[own] += grad_w**2
            square_v[own] += grad_v**2
            square_b += grad_b**2
            m.weights[own] -= RATE * grad_w / np.sqrt(square_w[own])
            m.vectors[own] -= 0.1 * RATE * grad_v / np.sqrt(square_v[own])
            m.bias -= RATE * grad_b / np.sqrt(square_b)
    m.weights, m.vectors = m.weights.astype(np.float32), m.vectors.astype(np.float32)
    return m


def train(docs: DataFrame, labels: DataFrame, rows_of_class: int = SAMPLE_ROWS, where: Column | None = None) -> Machine:
    """A machine fitted on a bounded sample of labelled rows; terms are taken on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            bounds, columns, values = terms(as_bytes(part, "text"))
            cut = list(zip(bounds[:-1], bounds[1:]))
            packed = [[x[a:b].astype(kind).tobytes() for a, b in cut] for x, kind in ((columns, "<i4"), (values, "<f4"))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(p, pa.binary()) for p in packed), part.column("label")], ["doc_id", "columns", "values", "label"])

    chosen = sample(docs, labels, "toxic", rows_of_class, where)
    kind = chosen.schema["doc_id"].dataType.simpleString()
    rows = chosen.mapInArrow(run, f"doc_id {kind}, columns binary, values binary, label int").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.columns)))
    return fit([(np.frombuffer(r.columns, "<i4"), np.frombuffer(r.values, "<f4"), r.label) for r in rows])


def score_toxicity(docs: DataFrame, machine: Machine, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of each row, from its whole text only.

    Repeated rows get equal scores, null texts that of an empty one; other columns are not read. There is no shuffle;
    what is sent to the executors has the size of the machine, whatever the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            scores = probability(machine.logits(*terms(as_bytes(part, "text"))))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(column(id_column).alias("id"), column(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['id'].dataType.simpleString()}, score double")


def drop_toxic(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            yield part.filter(pa.array(probability(machine.logits(*terms(as_bytes(part, "text")))) < threshold))

    return docs.mapInArrow(run, docs.schema)


def fold(doc_id: Column, folds: int) -> Column:
    """The remainder of the checksum of an id as text; null ids are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    machine = train(docs, labels, where=fold(F.col("doc_id"), 3) != 1)
    return score_toxicity(docs, machine).select(
        "doc_id",
        (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
