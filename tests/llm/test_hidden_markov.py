from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tidemark.llm import hidden_markov
from tidemark.llm.hidden_markov import STRETCH, Model, expected, learn_words, likelihood, parted, scoring_report, train

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def small_model(rng, symbols=5, states=3):
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return Model(norm(rng.random((2, states)), 1), norm(rng.random((states, states)), 1), norm(rng.random((symbols, states)), 0))


def paths(model, text, side=0):
    states = range(model.moves.shape[0])
    for path in itertools.product(states, repeat=len(text)):
        p = model.start[side, path[0]]
        for t, (k, s) in enumerate(zip(path, text)):
            p *= (model.moves[path[t - 1], k] if t else 1) * model.emits[s, k]
        yield path, p


def test_forward_and_expected_counts_equal_all_paths():
    rng = np.random.default_rng(2)
    model = small_model(rng)
    texts = [[0], [1, 2], [4, 4, 4, 0], [3, 1, 2, 0, 1]]
    packed = [np.array(t, "<u2").tobytes() for t in texts]
    wanted = np.zeros(6 + 9 + 15)
    start, moves, emits = parted(wanted, 3)
    for text, got in zip(texts, likelihood(model, packed)):
        every = list(paths(model, text))
        total = sum(p for _, p in every)
        assert math.isclose(got, math.log10(total), rel_tol=1e-12)
        for path, p in every:
            start[0, path[0]] += p / total
            for t, k in enumerate(path):
                emits[text[t], k] += p / total
                if t:
                    moves[path[t - 1], k] += p / total
    counts = np.zeros_like(wanted)
    expected(model, packed, counts)
    assert np.allclose(counts, wanted)
    assert likelihood(model, []).shape == (0,)


def test_long_texts_are_read_whole():
    rng = np.random.default_rng(4)
    model = small_model(rng)
    text = rng.integers(0, 5, 5000)
    now, total = model.start[0], 0.0
    for t, s in enumerate(text):
        now = (now if t == 0 else now @ model.moves) * model.emits[s]
        total += math.log10(now.sum())
        now = now / now.sum()
    assert math.isclose(likelihood(model, [text.astype("<u2").tobytes()])[0], total, rel_tol=1e-12)
    counts = np.zeros(6 + 9 + 15)
    expected(model, [text.astype("<u2").tobytes()], counts)
    assert math.isclose(counts[15:].sum(), 5000)


def test_expected_counts_of_texts_longer_than_a_stretch():
    rng = np.random.default_rng(6)
    model = small_model(rng)
    texts = [rng.integers(0, 5, n) for n in (1, 3 * STRETCH + 7, STRETCH, STRETCH + 1, 2 * STRETCH, 2 * STRETCH, 40)]
    wanted = np.zeros(6 + 9 + 15)
    start, moves, emits = parted(wanted, 3)
    for text in texts:
        ahead, back = [model.start[0] * model.emits[text[0]]], [np.ones(3)]  # unscaled: a few hundred symbols fit
        for s in text[1:]:
            ahead.append((ahead[-1] @ model.moves) * model.emits[s])
        for s in text[:0:-1]:
            back.insert(0, model.moves @ (model.emits[s] * back[0]))
        total = ahead[-1].sum()
        start[0] += ahead[0] * back[0] / total
        for t, s in enumerate(text):
            emits[s] += ahead[t] * back[t] / total
            if t:
                moves += np.outer(ahead[t - 1], model.emits[s] * back[t]) * model.moves / total
    counts = np.zeros_like(wanted)
    packed = [t.astype("<u2").tobytes() for t in texts]
    told = expected(model, packed, counts)
    assert np.allclose(counts, wanted, rtol=1e-9)
    assert math.isclose(told, likelihood(model, packed).sum() * math.log(10), rel_tol=1e-12)


def test_counts_do_not_depend_on_what_is_held(monkeypatch):
    rng = np.random.default_rng(8)
    model = small_model(rng)
    texts = [rng.integers(0, 5, n).astype("<u2").tobytes() for n in rng.integers(1, 400, 60)]
    times = rng.integers(1, 4, 60)
    found = []
    for held, told, side in ((1 << 15, 1 << 15, 2048), (50, 7, 16), (1, 1, 3)):
        monkeypatch.setattr(hidden_markov, "HELD", held)
        monkeypatch.setattr(hidden_markov, "TOLD", told)
        monkeypatch.setattr(hidden_markov, "SIDE_BY_SIDE", side)
        counts = np.zeros(6 + 9 + 15)
        found.append((expected(model, texts, counts, times), counts))
    for total, counts in found:
        assert math.isclose(total, found[0][0], rel_tol=1e-12) and np.allclose(counts, found[0][1], rtol=1e-9)
    assert math.isclose(found[0][0], likelihood(model, texts) @ times * math.log(10), rel_tol=1e-12)
    assert math.isclose(found[0][1][15:].sum(), sum(len(t) // 2 * n for t, n in zip(texts, times)))


def test_forward_probabilities_are_held_for_the_way_back(monkeypatch):
    rng = np.random.default_rng(3)
    model = small_model(rng)
    texts = [rng.integers(0, 5, 300).astype("<u2").tobytes() for _ in range(200)]  # more symbols than a small cache holds
    steps, matmul = [], np.matmul
    monkeypatch.setattr(np, "matmul", lambda *a, **k: steps.append(1) or matmul(*a, **k))
    counts = np.zeros(6 + 9 + 15)
    expected(model, texts, counts)
    assert len(steps) == 299 and math.isclose(counts[15:].sum(), 60_000)


def test_probabilities_of_a_symbol_are_read_as_one_row(monkeypatch):
    axes, contiguous = [], np.ascontiguousarray

    class Table(np.ndarray):
        def take(self, indices, axis=None, **more):
            axes.append((axis, self.flags.c_contiguous))
            return super().take(indices, axis=axis, **more)

    rng = np.random.default_rng(7)
    model = small_model(rng)
    texts = [rng.integers(0, 5, n).astype("<u2").tobytes() for n in (1, 30, 9)]
    monkeypatch.setattr(np, "ascontiguousarray", lambda values: contiguous(values).view(Table))
    counts = np.zeros(6 + 9 + 15)
    told = expected(model, texts, counts)
    assert math.isclose(told, likelihood(model, texts).sum() * math.log(10), rel_tol=1e-12) and math.isclose(counts[15:].sum(), 40)
    assert set(axes) == {(0, True)} and len(axes) == 30 + 29 + 30  # each place, on the way there and back, and for scores


def test_texts_side_by_side_are_fewer_the_longer_they_are(monkeypatch):
    monkeypatch.setattr(hidden_markov, "HELD", 100)
    monkeypatch.setattr(hidden_markov, "SIDE_BY_SIDE", 20)
    monkeypatch.setattr(hidden_markov, "NARROWEST", 4)
    sizes = np.array([1000, 900, 50, 40, 10, *[3] * 50])
    groups = [list(range(len(sizes))[s]) for s in hidden_markov.side_by_side(sizes)]
    assert [len(g) for g in groups] == [4, 10, 20, 20, 1] and sum(groups, []) == list(range(len(sizes)))


def test_words_of_a_slice_are_looked_up_once():
    class Head(dict):
        looked = 0

        def __contains__(self, word):
            self.looked += 1
            return super().__contains__(word)

    texts = ["Red\x0bblue é\x85\n", None, "", " ", "\xa0 red RED\t Blue end"] * 40
    whole = pa.RecordBatch.from_pydict({"doc_id": list(range(200)), "held_out": [False] * 200, "text": texts})
    head = Head({b"red": 0, b"blue": 1})
    (got,) = hidden_markov.encoded(head)(iter([whole.slice(3)]))
    assert head.looked == len({w for t in texts for w in (t or "").encode().lower().split()})
    for text, row in zip(texts[3:], got.to_pylist()):
        words = (text or "").encode().lower().split()
        symbols = [head[w] if w in head.keys() else 3 + zlib.crc32(w[-3:]) % hidden_markov.ENDINGS for w in words]
        assert row["symbols"] == np.array([*symbols, 2], "<u2").tobytes()
        assert {o["word"]: o["n"] for o in row["others"]} == Counter(w for w in words if w not in head.keys())
    (counts,) = hidden_markov.count_words(iter([whole.slice(3)]))
    assert dict(zip(counts["word"].to_pylist(), counts["n"].to_pylist())) == Counter(w for t in texts[3:] for w in (t or "").encode().lower().split())


def test_words_of_a_slice_are_not_read_as_scalars(monkeypatch):
    class Words:
        def __init__(self, words):
            self.words = words

        def __len__(self):
            return len(self.words)

        def __getattr__(self, name):
            assert name != "to_pylist"
            return getattr(self.words, name)

    whole = hidden_markov.numbered
    monkeypatch.setattr(hidden_markov, "numbered", lambda part: (Words((found := whole(part))[0]), *found[1:]))
    part = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "held_out": [False] * 3, "text": ["red é a blue", None, "red"]})
    (got,) = hidden_markov.encoded({b"red": 0, b"blue": 1})(iter([part]))
    last = [3 + zlib.crc32(w) % hidden_markov.ENDINGS for w in ("é".encode(), b"a")]
    assert [np.frombuffer(s, "<u2").tolist() for s in got["symbols"].to_pylist()] == [[0, *last, 1, 2], [2], [0, 2]]


def test_every_round_reads_all_training_texts(spark, monkeypatch):
    """The model equals that of rounds in one process over all texts, more than any sample had, up to the tolerance."""
    texts = [f"{'red green blue'.split()[i % 3]} w{i} w{i % 7} and w{i + 1}" for i in range(900)]
    docs = spark.createDataFrame([(i, t, False) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean").repartition(3)
    words, _ = learn_words(docs, 500)
    rows = docs.mapInArrow(hidden_markov.encoded(words.head), "doc_id long, held_out boolean, symbols binary, others array<struct<word:binary,n:bigint>>")
    packed = [bytes(r.symbols) for r in rows.select("symbols").collect()]
    shares = words.shares()
    monkeypatch.setattr(hidden_markov, "TOLERANCE", 1e-3)
    model, objectives = Model.first(shares, hidden_markov.STATES), []
    while True:
        counts = np.zeros(2 * 8 + 64 + model.emits.size)
        objectives.append(expected(model, packed, counts) + model.prior(shares))
        if len(objectives) > 1 and objectives[-1] - objectives[-2] <= 1e-3 * abs(objectives[-1]):
            break
        model = Model.of(counts, shares, hidden_markov.STATES)
    got = train(rows, words)
    assert len(objectives) > 2 and objectives == sorted(objectives)
    assert np.allclose(got.emits, model.emits) and np.allclose(got.moves, model.moves) and np.allclose(got.start[0], model.start[0])


def brute_base(rows):
    words = lambda t: [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    for i, t in rows:
        own = words(t)
        yield i, held(i), len(own), sum(counts[w] > 0 for w in own), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in scoring_report(docs).collect()}
    better = total = 0
    for i, held, n, known, train, base in brute_base([(r.doc_id, r.text) for r in docs.collect()]):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        if held:
            better += r.score > r.base_score
            total += r.score - r.base_score
    assert total > 0 and better > 0.6 * sum(r.held_out for r in got.values())


def test_edge_cases(spark):
    rows = [(1, "a b c", 1), (1, "a b c", 1), (None, "a", 1), (2, None, 1), (3, " ", 1), (16, "new words here", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = scoring_report(docs).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 9)) for r in got) == sorted((str(i), n, k, round(b, 9)) for i, _, n, k, _, b in brute_base([(i, t) for i, t, _ in rows]))
    assert all(math.isfinite(r.score) for r in got)
    assert scoring_report(docs.limit(0)).count() == 0


def test_equal_texts_count_as_often_as_they_are_there():
    rnd = np.random.default_rng(5)
    shares = rnd.random(6)
    model = Model.first(shares / shares.sum(), 3)
    texts = [rnd.integers(0, 6, n).astype("<u2").tobytes() for n in (1, 4, 9, 150)]
    times = np.array([3, 1, 5, 2])
    size = 2 * 3 + 9 + model.emits.size
    one, many = np.zeros(size), np.zeros(size)
    total = expected(model, texts, one, times)
    assert np.isclose(total, expected(model, [t for t, n in zip(texts, times) for _ in range(n)], many)) and np.allclose(one, many)


def test_sequences_are_dealt_by_length_and_kept_whole(spark):
    rnd = np.random.default_rng(6)
    texts = [rnd.integers(0, 9, n).astype("<u2").tobytes() for n in [1, 2, 3, 50, 60, 700] * 20] + [b"\1\0\2\0"] * 300
    rows = spark.createDataFrame([(bytearray(t), i % 10 == 0) for i, t in enumerate(texts)], "symbols binary, held_out boolean").repartition(7)
    got = hidden_markov.training_sequences(rows).collect()
    wanted = Counter(t for i, t in enumerate(texts) if i % 10)
    found = Counter()
    for r in got:
        found[bytes(r.symbols)] += r.times
    assert found == wanted and len(got) < len(texts) / 2
    assert hidden_markov.training_sequences(rows.limit(0)).count() == 0


def test_words_beyond_the_bound_are_taken_by_hash(spark):
    docs = spark.createDataFrame([(" ".join(f"w{i}" for i in range(400)) + " often often",)], "text string")
    words, _ = hidden_markov.learn_words(docs, 100)
    assert b"often" in words.head and 60 <= len(words.head) <= 140
