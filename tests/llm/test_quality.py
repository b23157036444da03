from __future__ import annotations

import collections
import re

from tidemark.llm.quality import Measured, judge_quality, quality_report, train

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


TEXTS = ["", None, " \n\t", "a", "a b c a b c", "x y x y x y x", "é 漢 <|>\n\nline\nline\n line\nline", "a b c \x1c d", "one two three\n" * 400, "w " * 9000, "a b c"]


def test_counts():
    assert [tuple(x) for x in Measured([(t or "").encode() for t in TEXTS]).counts.tolist()] == [brute(t) for t in TEXTS]
    assert Measured([]).counts.shape == (0, 5) and Measured([]).features().shape[0] == 0


def test_edge_cases(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "a", "y"), (3, "a", "x")], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(0, None), (None, 1), (3, 1), (3, 1)], "doc_id long, quality int")
    got = judge_quality(docs, train(docs, labels)).collect()
    assert len(got) == len(TEXTS) + 2
    assert all(r.base_failed == (not r.kept) for r in got)  # labels of one class: no model
    assert quality_report(docs.limit(0), labels.limit(0)).count() == 0


def test_labelled_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality_report(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    for r in rows[::20]:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) > 0.97 * len(good)
    assert sum(not r.kept for r in bad) > 0.97 * len(bad)
