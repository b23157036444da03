"""Each stage against brute force over what the stage before it has kept."""

from __future__ import annotations

from test_secret_scan import brute as brute_secrets
from test_simhash import brute_bits, brute_roots
from test_suffix_dedup import brute as brute_spans

import corpus_pipeline
from tidemark.llm.components import stored
from tidemark.llm.secret_scan import masked
from tidemark.llm.toxicity import THRESHOLD, fold, score_toxicity, train
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


def by_id(frame):
    rows = {r.doc_id: r for r in frame.collect()}
    assert len(rows) == frame.count()
    return rows


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], SF_DIR), name))
    assert all(f.columns == docs.columns for f in frames[:-1])
    start, clean, single, cut, masked_docs = map(by_id, frames[:-1])

    machine = train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"), where=fold(F.col("doc_id"), 3) != 1)
    scores = {r.doc_id: r.score for r in score_toxicity(docs, machine).collect()}
    assert set(clean) == {i for i in start if scores[i] < THRESHOLD}

    bits = {i: brute_bits(r.text) for i, r in clean.items()}
    roots = brute_roots(set(bits.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    assert set(single) == {min(i for i, b in bits.items() if roots[b] == root) for root in set(roots.values())}

    ids = list(single)
    for i, (_, spans, _) in zip(ids, brute_spans([single[i].text for i in ids])):
        data, at, left = single[i].text.encode(), 0, ""
        for a, b in [*spans, [len(data), len(data)]]:
            left, at = left + data[at:a].decode("utf-8", "ignore"), b
        assert (i in cut) == (bool(left) or not data) and (not left or cut[i].text == left)

    assert set(masked_docs) == set(cut)
    for i, r in cut.items():
        assert masked_docs[i].text == masked(r.text, brute_secrets(r.text)) and masked_docs[i].n_chars == len(masked_docs[i].text)

    packed = frames[-1]
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(masked_docs)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).where("n <> end OR n > 1024").count() == 0
    assert corpus_pipeline.run(spark, SF_DIR).count() == packed.count()
