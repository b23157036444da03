from __future__ import annotations

import itertools

import numpy as np

from tidemark.llm.toxicity import Machine, drop_toxic, fit, fold, score_toxicity, terms, toxicity_report, train
from pyspark.sql import functions as F


def test_pairs_equal_the_definition():
    rng = np.random.default_rng(1)
    m = Machine(0.3, rng.normal(size=1 << 17), rng.normal(size=(1 << 17, 4)), np.ones(1 << 17, bool))
    bounds, columns, values = terms([b"Some words here, some twice.", b"", b"other thing"])
    got = m.logits(bounds, columns, values)
    for k in range(3):
        c, v = columns[bounds[k] : bounds[k + 1]], values[bounds[k] : bounds[k + 1]]
        pairs = sum(m.vectors[a] @ m.vectors[b] * x * y for (a, x), (b, y) in itertools.combinations(list(zip(c, v)), 2))
        assert np.isclose(got[k], 0.3 + (m.weights[c] * v).sum() + pairs, rtol=1e-4)
    assert np.array_equal(terms([b"A b"])[1], terms([b"a B"])[1])


def test_interaction_is_learned():
    rng = np.random.default_rng(2)
    rows = []
    for i in range(1200):
        a, b = rng.integers(0, 2, 2)
        present = [c for c, has in ((11, a), (22, b)) if has] + rng.integers(100, 130, 3).tolist()
        columns = np.unique(present)
        rows.append((columns, np.ones(len(columns), np.float32), int(a and b)))
    m = fit(rows)
    score = lambda *c: m.logits(np.array([0, len(c)]), np.array(c), np.ones(len(c), np.float32))[0]
    assert score(11, 22) > max(score(11), score(22)) + 1


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (1, "", 0.5), (None, "x " * 50_000, 0.1), (2, "é", 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    got = toxicity_report(docs, labels).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 and r.predicted == 0 for r in got)
    machine = train(docs, labels)
    assert drop_toxic(docs, machine).schema == docs.schema and drop_toxic(docs, machine).count() == 4
    assert toxicity_report(docs.limit(0), labels.limit(0)).count() == 0 and score_toxicity(docs.limit(0), machine).count() == 0


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity_report(docs, labels).join(labels, "doc_id").where(fold(F.col("doc_id"), 3) == 1).collect()
    toxic, clean = [r.predicted for r in rows if r.toxic], [r.predicted for r in rows if not r.toxic]
    assert all(r.held_out for r in rows)
    assert np.mean(toxic) > 0.88 and np.mean(clean) < 0.01
