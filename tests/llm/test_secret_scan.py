from __future__ import annotations

import random
import re
import time

from tidemark.llm.secret_scan import RULES, mask_secrets, scan_secrets, scanner, secret_report

# The same rules for Python's engine.
PLAIN = {
    "assign": re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "hex": re.compile(rb"[0-9a-f]+"),
    "github": re.compile(rb"gh[oprsu]_[A-Za-z0-9]+"),
    "jwt": re.compile(rb"eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+"),
    "key_block": re.compile(rb"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
}


def brute(text: str) -> list[tuple[str, int, int]]:
    data, out = text.encode(), []
    for number, rule in enumerate(RULES):
        for m in PLAIN[rule.kind].finditer(data):
            if len(m.group(1 if rule.kind == "assign" else 0)) >= rule.minimum:
                low = len(data[: m.start()].decode())
                out.append((low, number, low + m.end() - m.start()))
    return [(RULES[n].kind, a, b) for a, n, b in sorted(out)]


PIECES = ["token", "Secret", "PASSWORD", "passwd", "api_key", "ApiKey", '"', "'", " ", ":", "=", "AKIA", "AKIAAKIA", "0123456789", "ABCDEFGH12345678", "abcdef0123", "deadbeef", "ghp_", "x" * 36, "eyJ", ".", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "é", "漢", "\n", ",", "=abc", "_", "word"]


def test_spans_equal_those_of_the_patterns():
    rnd = random.Random(3)
    texts = ["".join(rnd.choices(PIECES, k=rnd.choice([1, 3, 8, 30, 200]))) for _ in range(1500)]
    texts += ["", "token=" + "a" * 5000, "token = token = abcdefgh", "f" * 3000, "x" * 9000, "é" * 700 + " secret: abcdefg"]
    assert scanner(RULES).scan([t.encode() for t in texts]) == [brute(t) for t in texts]
    assert scanner(RULES).scan([]) == []


def test_long_texts_of_failing_starts_take_linear_time():
    texts = ["eyJ" * 100_000, "0a" * 500_000, "token=" * 50_000, "AKIA" * 100_000 + " ", "-----BEGIN " * 30_000, "eyJa." * 60_000, "g" * 300_000]
    scanner(RULES)
    begin = time.perf_counter()
    got = scanner(RULES).scan([t.encode() for t in texts])
    assert time.perf_counter() - begin < 10
    assert got[0] == got[4] == got[6] == [] and got[1] == [("hex", 0, 1_000_000)] and got[3] == [("access", 0, 400_000)]
    short = ["eyJ" * 300, "0a" * 700, "token=" * 200, "-----BEGIN " * 90, "eyJa." * 100, "eyJa.eyJ" * 50 + ".x"]
    assert scanner(RULES).scan([t.encode() for t in short]) == [brute(t) for t in short]


def test_frames(spark):
    rows = [(1, "password: hunter22", "a"), (1, "password: hunter22", "a"), (2, None, None), (None, "", "b"), (3, "é token=abc123 " + "0" * 24, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets string")
    got = {(r.doc_id, r.spans, r.n_assign, r.n_hex) for r in secret_report(docs).collect()}
    assert got == {(1, "assign:0:18", 1, 0), (2, "", 0, 0), (None, "", 0, 0), (3, "assign:2:14,hex:15:39", 1, 1)}
    assert scan_secrets(docs).count() == 5 and scan_secrets(docs.limit(0)).count() == 0
    masked = mask_secrets(docs)
    assert masked.schema == docs.schema
    assert sorted(r.text or "-" for r in masked.collect()) == ["-", "-", "<assign>", "<assign>", "é <assign> <hex>"]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.spans for r in secret_report(docs).collect()}
    assert got == {i: ",".join(f"{k}:{a}:{b}" for k, a, b in brute(t)) for i, t in texts.items()}
    assert any(got.values())
