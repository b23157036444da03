from __future__ import annotations

import collections
import hashlib
import random

from tidemark.llm import suffix_dedup
from tidemark.llm.suffix_dedup import cut_repeats, repeated_spans, suffix_report


def brute(texts: list[str | None]) -> list[tuple]:
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[i : i + 200] for t in data for i in range(len(t) - 199))
    out = []
    for t in data:
        gone = bytearray(len(t) + 1)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        edges = [i for i in range(len(t) + 1) if gone[i] != (gone[i - 1] if i else 0)]
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), [[a, b] for a, b in zip(edges[::2], edges[1::2])], hashlib.sha256(kept).hexdigest()))
    return out


def sample_texts(seed: int) -> list[str | None]:
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdeé", k=rnd.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n) for n in (30, 45, 60, 200)] + [prose(50)[:200], prose(50)[:199], "a" * 450, "xyz" * 150]
    texts: list[str | None] = ["", None, "short", "a" * 1500, "ab" * 400]
    for _ in range(90):
        texts.append(" ".join(rnd.choice([prose(rnd.randint(1, 80)), rnd.choice(shared)]) for _ in range(rnd.randint(1, 5))))
    near = prose(150).split()
    for _ in range(25):
        own = list(near)
        for _ in range(rnd.randint(0, 4)):
            own[rnd.randrange(len(own))] = word()
        texts.append(" ".join(own))
    return texts + [texts[7]] * 6 + [shared[3]] * 2


def test_equal_to_brute_force(spark, monkeypatch):
    for seed, size in ((1, 48 << 20), (2, 6000)):
        monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", size)
        monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 4000)
        texts = sample_texts(seed)
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
        got = {r.doc_id: (r.n_bytes, r.spans, r.kept_sha256) for r in repeated_spans(frame).collect()}
        assert got == dict(enumerate(brute(texts)))


def test_whole_in_another_batch(spark):
    long = "A passage of some length that two texts end with and a third one has again: " + " ".join(map(str, range(90)))
    texts = ["A. " + long, "B! " + long]
    for copy in texts:  # one of the two is the array's suffix for the key, whichever has the lesser hash
        for batches in ([texts, [copy]], [[copy], texts], [texts, [copy, copy]]):
            every = [(10 * b + i, t, b) for b, batch in enumerate(batches) for i, t in enumerate(batch)]
            docs = spark.createDataFrame(every, "doc_id long, text string, batch int").repartitionById(2, "batch")
            got = {r.doc_id: (r.n_bytes, r.spans, r.kept_sha256) for r in repeated_spans(docs).collect()}
            assert got == dict(zip([i for i, *_ in every], brute([t for _, t, _ in every])))


def test_edge_cases(spark):
    long = "The one and only passage, é, with words that nobody else has: " + " ".join(map(str, range(100)))
    rows = [(1, "A. " + long, "x"), (1, "B! " + long + " end", "x"), (None, long, None), (None, long, None), (2, None, "z"), (3, "", "z"), (4, "fine", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    wanted = sorted((str(i), n, sum(b - a for a, b in s), len(s), d) for (i, *_), (n, s, d) in zip(rows, brute([t for _, t, _ in rows])))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_report(docs).collect()) == wanted
    left = cut_repeats(docs)
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == [("1", "A."), ("1", "B! end"), ("2", ""), ("3", ""), ("4", "fine")]
    assert suffix_report(docs.limit(0)).count() == 0


def test_passage_in_very_many_contexts(spark, monkeypatch):
    """Texts with a common passage of 120 bytes share no 200 bytes, however many there are."""
    passage = "".join(random.Random(0).choices("abcdefgh", k=120))
    rnd = random.Random(3)
    own = lambda: "".join(rnd.choices("ijklmnopqr ", k=150))
    docs = spark.range(1).selectExpr("explode(sequence(0, 39999)) AS doc_id").selectExpr(
        "CAST(doc_id AS long) AS doc_id",
        f"concat(substr(sha2(concat('a', doc_id), 512), 1, 128), substr(sha2(concat('b', doc_id), 512), 1, 22), '{passage}', substr(sha2(concat('c', doc_id), 512), 1, 128), 'yyyyyyyyyyyyyyyyyyyyyy') AS text",
    )
    assert suffix_report(docs).where("n_removed > 0").count() == 0
    text = own() + passage + own()
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 2000)
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 900)
    texts = [own() + passage + own() for _ in range(40)] + [text, text, "x" + text[10:], text[:-7] + "z"]
    got = {r.doc_id: (r.n_bytes, r.spans, r.kept_sha256) for r in repeated_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_clashing_columns_and_one_id(spark):
    long = "Words that two rows of one id have in common, and a third one too: " + " ".join(map(str, range(100)))
    rows = [(None, f"{i} {long}" if i % 3 == 0 else f"row {i} only", i, i, "t", "w", True) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, doc int, number int, __text string, whole string, had boolean")
    wanted = sorted((n, d) for n, _, d in brute([r[1] for r in rows]))
    assert sorted((r.n_bytes, r.kept_sha256) for r in suffix_report(docs).collect()) == wanted
    left = cut_repeats(docs)
    assert left.columns == docs.columns and {r.doc for r in left.collect()} == set(range(30))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.n_bytes, r.spans, r.kept_sha256) for r in repeated_spans(docs).collect()}
    assert got == dict(zip([i for i, _ in texts], brute([t for _, t in texts])))
