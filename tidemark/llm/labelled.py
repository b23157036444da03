"""Bounded samples of labelled documents, and blocks of terms of a buffer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of each class that a classifier is fitted on, at most.
SAMPLE_ROWS = 2_000


def sample(docs: DataFrame, labels: DataFrame, label: str, rows_of_class: int = SAMPLE_ROWS, where: Column | None = None) -> DataFrame:
    """``text`` and ``label`` of at most ``rows_of_class`` documents of each class.

    Which ones is decided by a hash of the document's id, so it is the same in every run. Labels that are null or
    whose id is null are left out; of several labels of an id the largest counts, and of several rows of an id the text
    with the least hash. ``where`` is a condition on ``doc_id``. The ids are bounded by the parameter, so joining them
    is a broadcast, and what is returned has one row for each, however many rows an id has.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    known = (known if where is None else known.where(where)).groupBy("doc_id").agg(F.max("label").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.where(F.col("label") == value).orderBy(*order).limit(rows_of_class) for value in (0, 1)]
    ids = chosen[0].unionByName(chosen[1])
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    first = rows.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    return first.select("doc_id", "first.text", "label")
