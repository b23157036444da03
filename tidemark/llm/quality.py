"""Quality rules: counts that fail a text by themselves, and a calibrated logistic regression over hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.batches import as_bytes, slices
from tidemark.llm.labelled import SAMPLE_ROWS, sample
from tidemark.llm.rolling import WHITE, Rolling, laid_out, mixed, runs
from tidemark.session import column

# Parameters: columns of the hashed n-grams, texts handled at once, training, thresholds.
TRIGRAM_BITS, WORD_BITS, PAIR_BITS = 11, 10, 10
SLICE_BYTES, SLICE_ROWS = 2 << 20, 256
STEPS, RATE, FADE, HELD_BACK = 250, 0.05, 1e-4, 4
LEAST_WORDS, MOST_REPEATED_PERCENT, LEAST_PROBABILITY = 50, 50, 0.5

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = 256 + (1 << TRIGRAM_BITS) + (1 << WORD_BITS) + (1 << PAIR_BITS) + 4


def per_text(positions: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many positions lie in each text."""
    return np.diff(np.searchsorted(positions, np.concatenate([[-1], ends]), side="right"))


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


class Measured:
    """Counts and n-gram shares of some texts."""

    def __init__(self, texts: list[bytes]) -> None:
        self.texts = texts
        self.buffer, self.starts, self.ends = laid_out(texts)
        white = WHITE[self.buffer]
        word_starts, word_ends = runs(~white)
        self.words = Rolling(self.buffer).hashes(word_starts, word_ends - word_starts) if len(word_starts) else np.empty(0, np.uint64)
        self.document = np.searchsorted(self.ends, word_starts, side="right")
        first_bytes = np.flatnonzero(~white & ((self.buffer & 0xC0) != 0x80))
        self.n_words = per_text(word_starts, self.ends)
        self.counts = np.column_stack([
            self.n_words,
            per_text(first_bytes, self.ends),
            per_text(np.flatnonzero(SYMBOL[self.buffer]), self.ends),
            np.array([repeated_lines(t) for t in texts], np.int64),
            self.repeated_words(),
        ])

    def windows(self, size: int) -> np.ndarray:
        """First words of the windows of so many words that lie in one text."""
        last = len(self.words) - size + 1
        if last <= 0:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.document[:last] == self.document[size - 1 : size - 1 + last])

    def joined(self, at: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for step in range(size):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + self.words[at + step])
        return out

    def repeated_words(self) -> np.ndarray:
        """Words in three-word windows that their text has twice or more (windows compared by 64-bit hashes)."""
        at = self.windows(3)
        keys = self.joined(at, 3) ^ mixed(self.document[at].astype(np.uint64) + np.uint64(1))
        _, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
        again = at[counts[place] > 1]
        covered = np.zeros(len(self.words) + 3, bool)
        for step in range(3):
            covered[again + step] = True
        return np.bincount(self.document[covered[: len(self.words)]], minlength=len(self.texts))

    def features(self) -> np.ndarray:
        """Roots of the shares of characters, character trigrams, words and word pairs, and of some counts."""
        n, data = len(self.texts), self.buffer.astype(np.int64)
        text_of = np.repeat(np.arange(n), self.ends - self.starts + 1)
        three = np.arange(max(0, len(data) - 2))
        three = three[text_of[three] == text_of[three + 2]] if len(three) else three
        gram = data[three] | data[three + 1] << 8 | data[three + 2] << 16
        trigram = (mixed(gram.astype(np.uint64)) >> np.uint64(64 - TRIGRAM_BITS)).astype(np.int64)
        pairs = self.windows(2)
        blocks = []
        for of, columns, width in (
            (text_of, data, 256),
            (text_of[three], trigram, 1 << TRIGRAM_BITS),
            (self.document, (self.words >> np.uint64(64 - WORD_BITS)).astype(np.int64), 1 << WORD_BITS),
            (self.document[pairs], (self.joined(pairs, 2) >> np.uint64(64 - PAIR_BITS)).astype(np.int64), 1 << PAIR_BITS),
        ):
            found = np.bincount(of * width + columns, minlength=n * width).reshape(n, width)
            blocks.append(np.sqrt(found / np.maximum(found.sum(axis=1, keepdims=True), 1)).astype(np.float32))
        words = np.maximum(self.n_words, 1)[:, None]
        counts = np.minimum(self.counts[:, [2, 3, 4]] / words, 1.0)
        return np.hstack([*blocks, np.sqrt(counts), np.log1p(self.n_words)[:, None] / 10]).astype(np.float32)


@dataclass
class Judge:
    """Weights, and slope and shift that make the score a probability; without a model all texts are good."""

    weights: np.ndarray
    slope: float
    shift: float

    def probability(self, features: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (features @ self.weights[:-1] + self.weights[-1]) + self.shift)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def descend(features: np.ndarray, labels: np.ndarray, steps: int, rate: float, fade: float) -> np.ndarray:
    """Logistic regression by Adam on all rows; the last weight is the bias."""
    weights = np.zeros(features.shape[1] + 1, np.float32)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        error = (sigmoid(features @ weights[:-1] + weights[-1]) - labels) / len(labels)
        gradient = np.append(features.T @ error.astype(np.float32), error.sum()).astype(np.float32)
        gradient[:-1] += fade * weights[:-1]
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return weights


def fit(features: np.ndarray, labels: np.ndarray) -> Judge:
    """Fitted on three quarters of the rows, calibrated (Platt) on the others. Needs both classes, else a judge for all."""
    if len(set(labels.tolist())) < 2:
        return Judge(np.zeros(FEATURES + 1, np.float32), 0.0, 35.0)
    back = np.arange(len(labels)) % HELD_BACK == 0
    weights = descend(features[~back], labels[~back], STEPS, RATE, FADE)
    scores = (features[back] @ weights[:-1] + weights[-1])[:, None]
    scale = max(float(np.abs(scores).max(initial=0)), 1e-6)
    slope, shift = descend(scores / scale, labels[back], 500, 0.1, 1e-3).tolist()
    return Judge(weights, max(slope, 0.0) / scale, shift)


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text", SLICE_BYTES):
        for low in range(0, part.num_rows, SLICE_ROWS):
            yield part.slice(low, SLICE_ROWS)


def train(docs: DataFrame, labels: DataFrame, rows_of_class: int = SAMPLE_ROWS) -> Judge:
    """A judge fitted on a bounded sample of labelled rows; features are taken on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            found = Measured(as_bytes(part, "text")).features().astype(np.float16)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([row.tobytes() for row in found], pa.binary()), part.column("label")], ["doc_id", "features", "label"])

    chosen = sample(docs, labels, "quality", rows_of_class)
    rows = chosen.mapInArrow(run, f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, features binary, label int").collect()
    rows.sort(key=lambda r: (r.label, r.doc_id, bytes(r.features)))
    features = np.frombuffer(b"".join(r.features for r in rows), np.float16).reshape(len(rows), FEATURES).astype(np.float32)
    return fit(features, np.array([r.label for r in rows], np.float32))


def judge_quality(docs: DataFrame, judge: Judge, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``probability`` of good quality and ``kept`` of each row.

    Null and empty texts have no words and fail; repeated rows get equal results; other columns are not read. There is
    no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            measured = Measured(as_bytes(part, "text"))
            counts = measured.counts
            failed = (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED_PERCENT * counts[:, 0])
            chance = judge.probability(measured.features()).astype(np.float64)
            arrays = [part.column("id"), *(pa.array(counts[:, i].astype(np.int64)) for i in range(len(COUNTS)))]
            arrays += [pa.array(failed), pa.array(chance), pa.array(~failed & (chance >= LEAST_PROBABILITY))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *COUNTS, "base_failed", "probability", "kept"])

    rows = docs.select(column(id_column).alias("id"), column(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, probability double, kept boolean")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge_quality(docs, train(docs, labels))
