"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next one.

Toxic documents go, one document of each near-duplicate group stays, strings that repeat are cut out, secrets are
masked, and what is left is packed into sequences. Every stage but the last returns the columns of documents;
``n_chars`` follows the text. Null texts have a score as empty ones, are near-duplicates of each other, and pack as an
end id alone; stages handle repeated rows, empty tables and clashing column names as their operators state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.components import stored
from tidemark.llm.packing import packing_report
from tidemark.llm.queries import table
from tidemark.llm.secret_scan import mask_secrets
from tidemark.llm.simhash import drop_near_duplicates
from tidemark.llm.suffix_dedup import cut_repeats
from tidemark.llm.toxicity import drop_toxic, fold, train

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the text now has them, where there is such a column."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = train(docs, table(spark, sf_dir, "labels"), where=fold(F.col("doc_id"), 3) != 1)
    return drop_toxic(docs, machine)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return counted(cut_repeats(docs))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return counted(mask_secrets(docs))


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing_report(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each),
    ("suffix_dedup", without_repeats),
    ("secrets", without_secrets),
    ("packing", in_sequences),
]

# The first stage is a trained model, which SQL cannot express; tests compare the others with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
