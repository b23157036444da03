from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.packing import best_fit, cut, lookup, lower_bound, pack, pack_documents, packing_report

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [x.ids + [2] for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_equal_those_of_the_library():
    rnd = random.Random(2)
    texts = ["".join(rnd.choices(["a", "the", " ", "  ", "\n", "\t", "é", "漢", "1", "'s", ".", "\0", "<|endoftext|>", " "], k=rnd.choice([0, 1, 5, 40]))) for _ in range(800)]
    assert [np.frombuffer(x, "<u4").tolist() for x in lookup(PATH).packed(texts)] == [x[:-1] for x in brute_ids(texts)]


def test_each_stretch_is_looked_at_once(monkeypatch):
    seen = []
    judge = packing.beside_white_space
    monkeypatch.setattr(packing, "beside_white_space", lambda stretch: seen.append(stretch) or judge(stretch))
    texts = [f"One two{'' if i % 3 else '  three'} four {i % 7} five\0"[: 90 if i % 5 == 0 else -1] for i in range(500)]
    found = packing.Lookup(PATH).packed(texts)
    assert len(seen) == len(set(seen)) < 30
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [x[:-1] for x in brute_ids(texts)]
    assert lookup(PATH).packed([]) == []


def test_best_fit_and_bounds():
    rnd = np.random.default_rng(1)
    for _ in range(60):
        lengths = rnd.integers(1, rnd.choice([20, 400, 1024]), rnd.integers(1, 300))
        bins, offsets, free = best_fit(lengths)
        assert (np.bincount(bins, lengths) + free == 1024).all() and (free >= 0).all()
        order = np.lexsort((offsets, bins))
        same = np.diff(bins[order]) == 0
        assert (offsets[order][1:][same] == (offsets + lengths)[order][:-1][same]).all()
        assert lower_bound(lengths) <= len(free)
    assert lower_bound(np.array([600] * 7)) == 7 and lower_bound(np.array([400] * 4)) == 2 and lower_bound(np.array([], np.int64)) == 0
    assert lower_bound(np.array([342] * 6)) == 3
    assert cut(1) == [0, 1] and cut(1024) == [0, 1024] and cut(2500) == [0, 452, 1476, 2500]


def test_exchange_saves_sequences(spark):
    lengths = np.random.default_rng(2).integers(1, 1000, 20_000)
    frame = spark.createDataFrame([(i, int(x)) for i, x in enumerate(lengths)], "key long, length long")
    rows = pack(frame).collect()
    assert len(rows) == len(lengths)
    used = len({r.sequence_id for r in rows})
    assert lower_bound(lengths) <= used <= 1.01 * lower_bound(lengths)
    assert pack(frame.limit(0)).count() == 0


def test_documents(spark):
    rows = [(1, "word " * 3000, 5), (1, "word " * 3000, 5), (2, None, 6), (None, "", 7), (3, "One two three", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset long")
    ids = brute_ids([t for _, t, _ in rows])
    got = packing_report(docs).collect()
    wanted = [(i, p, a, b - a, zlib.crc32(np.array(x[a:b], "<u4").tobytes())) for (i, *_), x in zip(rows, ids) for p, (a, b) in enumerate(zip(cut(len(x)), cut(len(x))[1:]))]
    assert sorted(map(repr, wanted)) == sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got)
    check_sequences(got)
    assert all(len(r.ids) == 4 * r.length for r in pack_documents(docs).collect())
    assert packing_report(docs.limit(0)).count() == 0


def check_sequences(rows):
    at: dict[int, list] = {}
    for r in rows:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = docs.collect()
    total = {t.doc_id: len(x) for t, x in zip(texts, brute_ids([t.text for t in texts]))}
    rows = packing_report(docs).collect()
    check_sequences(rows)
    sums: dict[int, int] = {}
    for r in rows:
        sums[r.doc_id] = sums.get(r.doc_id, 0) + r.length
    assert sums == total
    assert len({r.sequence_id for r in rows}) <= -(-sum(total.values()) // 1024) + 2
