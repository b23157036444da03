from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm.labelled import sample
from tidemark.llm.quality import judge_quality, train


def test_one_row_for_each_id_however_many_it_has(spark):
    docs = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    rows = sample(docs, labels, "quality", 50).collect()
    assert len({r.doc_id for r in rows}) == len(rows) <= 100
    everything = sample(docs, labels, "quality", 3000).collect()
    assert sum(r.doc_id == 7 for r in everything) == 1 and len(everything) == docs.select("doc_id").distinct().count()
    assert sample(docs, labels.limit(0), "quality").count() == 0


def test_quality_of_labels_that_were_not_fitted(spark):
    """Fitted on two thirds of the labels, judged on the others."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    judge = train(docs, labels.where(~held_out))
    others = docs.join(labels.where(held_out).select("doc_id"), "doc_id", "left_semi")
    rows = judge_quality(others, judge).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert len(bad) > 100 and sum(r.kept for r in good) > 0.95 * len(good)
    assert sum(not r.kept for r in bad) > 0.95 * len(bad)
