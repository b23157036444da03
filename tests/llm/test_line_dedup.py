from __future__ import annotations

import hashlib
import random
from collections import defaultdict

from tidemark.llm.line_dedup import LineRuns, drop_shared_lines, line_report, tallied

SCHEMA = "doc_id long, text string"
WHITE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(rows, min_chars=20, min_docs=3):
    ids = defaultdict(set)
    low = lambda i: -(2**63) if i is None else i
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                ids[key_of(line)].add(low(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(ids[key_of(x)]) < min_docs or max(ids[key_of(x)]) == low(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def check(spark, rows):
    wanted = brute(rows)
    got = line_report(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(repr((i, n, d, digest(kept))) for i, n, d, kept in wanted)


def test_random_documents(spark):
    rnd = random.Random(7)
    lines = [f"a line that several documents share {i}" for i in range(12)] + ["", "short", " \t", "ÄÖ" * 10, "İ" * 19, "x" * 20]
    odd = lambda x: rnd.choice(["", "  ", "\t\x0b"]) + (x.upper() if rnd.random() < 0.3 else x) + rnd.choice(["", "\r", "\x0c "])
    rows = [(rnd.choice([None, *range(40)]), "\n".join(odd(rnd.choice(lines)) for _ in range(rnd.randint(0, 9)))) for _ in range(60)]
    check(spark, rows + [(50, None), (51, ""), (52, "\n\n"), *[rows[0]] * 3])


def test_one_line_in_most_documents(spark):
    common = "This line stands in nearly every document."
    rows = [(i, f"{common}\nown line number {i} of its document\n{common}") for i in range(400)]
    check(spark, rows + [(1000 + i, f"{common}\n" * 50) for i in range(2)])


def test_one_id_with_most_rows(spark):
    rows = [(7, f"line that is in many rows of one id\nown words of row {i} here") for i in range(200)] + [(i, "line that is in many rows of one id") for i in range(2)]
    check(spark, rows)


def test_very_long_text(spark):
    long = "\n".join(f"line {i % 30_000} of a text with very many lines" for i in range(60_000))
    check(spark, [(1, long), (2, long), (3, long), (4, "short")])


def test_rows_keep_their_columns(spark):
    shared = "a line that three documents share"
    rows = [(i, f"{shared}\n{i}", 1, "h", {"a": 1}) for i in range(3)] + [(9, None, 2, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA + ", doc int, h1 string, `row.kept` map<string,int>")
    got = drop_shared_lines(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {0: "0", 1: "1", 2: f"{shared}\n2", 9: ""}
    assert drop_shared_lines(docs.limit(0)).count() == 0


def test_runs_are_levelled_and_disjoint(spark):
    runs = LineRuns(spark, fan_in=2)
    batches = [[(1, 1, 1, 5), (2, 2, 2, 9)], [(2, 2, 1, 3), (3, 3, 1, 4)], [(1, 1, 1, 8), (4, 4, 1, 1)], [(1, 1, 4, 2)], [(5, 5, 1, 1)]]
    frames = [spark.createDataFrame(b, "h1 long, h2 long, docs long, keeper long") for b in batches]
    for frame in frames:
        runs.add(frame)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = [tuple(r)[:2] for run in runs.runs() for r in run.collect()]
    assert sorted(held) == [(i, i) for i in range(1, 6)]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    assert sorted(map(tuple, runs.totals().collect())) == sorted(map(tuple, tallied(union).collect()))
    run = runs.runs()[0]
    plan = frames[0].join(run.hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1  # the batch's, not the run's
    runs.drop()
