from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemark.llm import alignment
from tidemark.llm.alignment import Aligned, Stretches, align, alignment_report, gallop, level_tokens, pieces

SCHEMA = "doc_id long, text string"


def byte_characters():
    """The table of byte-level vocabularies, as it is usually written."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table, n = {chr(b): b for b in kept}, 0
    for b in range(256):
        if b not in kept:
            table[chr(256 + n)] = b
            n += 1
    return table


@pytest.fixture(scope="module")
def tokens_of():
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    table = byte_characters()

    def run(text):
        if not text:
            return [], []
        of_a = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        of_b = []
        for i in b.encode(text):
            name = b.id_to_piece(i)
            of_b.append((i, bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if any(b"".join(x for _, x in side) != whole for side in (of_a, of_b)):
            return [], []
        return of_a, of_b

    return run


def ranges(side):
    out, at = [], 0
    for i, x in side:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def brute(rows, tokens_of):
    links, groups, sizes = [], [], []
    for _, text in rows:
        a, b = map(ranges, tokens_of(text))
        sizes.append((len(a), len(b)))
        own, start = [], 0
        for x, low, high in a:
            while start < len(b) and b[start][2] <= low:
                start += 1
            at = start
            while at < len(b) and b[at][1] < high:
                own.append((x, b[at][0]))
                at += 1
        links.append(own)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        parts, low = [], 0
        for cut in cuts:
            parts.append("|".join(",".join(str(i) for i, s, e in side if low < e <= cut) for side in (a, b)) if len(a) < 3000 else "")
            low = cut
        groups.append(parts)
    counts = Counter(pair for own in links for pair in set(own))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for (i, _), own, parts, (n_a, n_b) in zip(rows, links, groups, sizes):
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""
        digest = None if n_a >= 3000 else digest
        out.append((i, n_a, n_b, len(parts), len(own), sum(counts[p] == most[p[0]] for p in own), sum(counts[p] for p in own), digest))
    return out


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(got, wanted):
    got = [tuple(r[n] for n in NAMES) for r in got]
    # Brute force leaves out the digests of long texts.
    known = {w[:-1] for w in wanted if w[-1] is None}
    assert sorted(map(repr, ((*g[:-1], None) if g[:-1] in known else g for g in got))) == sorted(map(repr, wanted))


def test_bytes_of_tokens():
    tokens = level_tokens(P.path("byte_bpe_50k.json"))
    table = byte_characters()
    vocabulary = Tokenizer.from_file(P.path("byte_bpe_50k.json")).get_vocab()
    assert all(tokens.listed[i] == bytes(table[c] for c in name) for name, i in vocabulary.items())
    _, of_pieces = pieces(P.path("piece_bpe_32k.model"))
    assert [of_pieces.listed[i] for i in range(3, 259)] == [bytes([i]) for i in range(256)]
    # What lets stretches between spaces be encoded apart: no piece has a space after anything else.
    assert not [x for x in of_pieces.listed if b" " in x.lstrip(b" ")]


def test_stretches_are_encoded_as_in_their_texts(tokens_of, monkeypatch):
    monkeypatch.setattr("tidemark.llm.alignment.MEMORY_ENTRIES", 300)
    both, rnd = Stretches(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")), random.Random(9)
    odd = ["a", "The", " ", " ", "  ", "\n", "é", "漢字", "12", "'s", ".", "▁", "<s>", "\0", "\x1c", "\x85", "\u3000", "\t", "word", "<|endoftext|>", "ﬁ"]
    for _ in range(60):
        texts = ["".join(rnd.choices(odd, k=rnd.randint(0, 30))) for _ in range(20)]
        for text, a, b in zip(texts, *both.encoded(texts)):
            wanted = tokens_of(text)
            assert (np.frombuffer(a, "<u4").tolist(), np.frombuffer(b, "<u4").tolist()) == tuple([i for i, _ in side] for side in wanted)


def test_gallop_equals_search():
    rnd = np.random.default_rng(0)
    for _ in range(100):
        stretches, wanted, guess, low, high, answer, start = [], [], [], [], [], [], 0
        for _ in range(rnd.integers(1, 6)):
            own = np.cumsum(rnd.integers(1, rnd.choice([2, 50]), rnd.integers(1, 200)))
            mine = rnd.integers(0, own[-1] + 1, 30)
            stretches.append(own)
            wanted.append(mine)
            guess.append(start + rnd.integers(0, len(own), 30))
            low += [start] * 30
            high += [start + len(own)] * 30
            answer.append(start + np.searchsorted(own, mine))
            start += len(own)
        got = gallop(*map(np.concatenate, (wanted, stretches, guess)), np.array(low), np.array(high))
        assert (got == np.concatenate(answer)).all()


def test_links_and_groups_of_random_cuts():
    rnd = random.Random(4)
    for _ in range(200):
        sizes = [rnd.choice([0, 1, 2, 9, 40]) for _ in range(rnd.randint(1, 5))]
        sides = []
        for share in (rnd.random(), rnd.random()):
            sides.append([sorted({*(x for x in range(1, n) if rnd.random() < share), n}) if n else [] for n in sizes])
        base = np.cumsum([0, *sizes[:-1]])
        ends = [np.array([b + e for b, own in zip(base, side) for e in own], np.int64) for side in sides]
        ids = [np.arange(len(e)) * 3 + k for k, e in enumerate(ends)]
        found = Aligned(*ids, *ends, *(np.array(list(map(len, side))) for side in sides))
        pairs, at_a, at_b = [], 0, 0
        for own_a, own_b, groups, n in zip(*sides, found.group_texts(), sizes):
            for i, (low, high) in enumerate(zip([0, *own_a], own_a)):
                pairs += [((at_a + i) * 3, (at_b + j) * 3 + 1) for j, (s, e) in enumerate(zip([0, *own_b], own_b)) if s < high and e > low]
            cuts = sorted(set(own_a) & set(own_b))
            wanted = ";".join("|".join(",".join(str((at + i) * 3 + k) for i, e in enumerate(own) if low < e <= high) for k, at, own in ((0, at_a, own_a), (1, at_b, own_b))) for low, high in zip([0, *cuts], cuts))
            assert groups.decode() == wanted
            at_a, at_b = at_a + len(own_a), at_b + len(own_b)
        assert sorted(pairs) == sorted((int(p) >> 32, int(p) & 0xFFFFFFFF) for p in found.pairs)


def test_odd_texts(spark, tokens_of):
    rnd = random.Random(2)
    texts = [None, "", " ", "  a", "a\tb\n c", "<|endoftext|> <s> </s>", "▁ under", "é漢🙂 x", "\0", "aaaa" * 50, "Ä  ö\r\n", "é ﻿ x", "the same", "the same"]
    texts += ["".join(rnd.choices(["a", "The", " ", "  ", "\n", "é", "漢", "12", "'s", ".", "▁", "<s>"], k=rnd.randint(1, 40))) for _ in range(150)]
    rows = [(i if i % 7 else None, text) for i, text in enumerate(texts)] + [(1, "repeated id"), (1, "repeated id")]
    frame = spark.createDataFrame([(*r, 1, "x", [2]) for r in rows], SCHEMA + ", n_a int, slice string, pairs array<int>").repartition(3)
    check(align(frame).collect(), brute(rows, tokens_of))
    assert align(frame.limit(0)).collect() == []


def test_long_text(spark, tokens_of):
    rows = [(1, "word and another one, " * 60_000), (2, "word"), (3, None)]
    check(align(spark.createDataFrame(rows, SCHEMA)).collect(), brute(rows, tokens_of))


def test_whole_table(spark, tokens_of):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    check(alignment_report(frame).collect(), brute(rows, tokens_of))


def test_workers_let_go_of_what_they_remember():
    alignment.aligned(["some words of a text"])
    assert alignment.stretches.cache_info().currsize == 1
    assert list(alignment.judged(iter([]))) == []
    kept = (alignment.stretches, alignment.numerals, alignment.pieces, alignment.level_tokens, alignment.lookup)
    assert not any(f.cache_info().currsize for f in kept)


def test_memory_of_remembered_stretches_and_of_a_slice():
    both, rnd = Stretches(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")), random.Random(3)
    words = ["".join(rnd.choices("abcdefgh", k=7)) for _ in range(20_000)]
    both.encoded(words[:10])
    tracemalloc.start()
    both.encoded([" ".join(words)])
    each = tracemalloc.get_traced_memory()[0] / len(words)
    tracemalloc.stop()
    assert each < 160  # the string, its ids of both tokenizers as one value, and a place in one table


def test_a_slice_is_aligned_part_by_part(spark, tokens_of, monkeypatch):
    sizes, run = [], alignment.aligned
    monkeypatch.setattr(alignment, "PART_BYTES", 200)
    monkeypatch.setattr(alignment, "aligned", lambda texts: sizes.append(sum(map(len, texts))) or run(texts))
    rows = [(i, f"text number {i} and the same end " * (i % 3)) for i in range(60)]
    check(align(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect(), brute(rows, tokens_of))

    class Frame:
        schema = {"id": type("Field", (), {"dataType": type("Kind", (), {"simpleString": lambda: "bigint"})})}
        select = lambda self, *a: self
        mapInArrow = lambda self, f, kind: f  # noqa: E731,N815

    slice_ = alignment.pa.RecordBatch.from_pydict({"id": [i for i, _ in rows], "text": [t for _, t in rows]})
    sizes.clear()
    (row,) = alignment.aligned_slices(Frame())(iter([slice_]))
    assert len(sizes) > 5 and max(sizes) < 300 and len(row["digests"][0]) == 60
