"""Landed Parquet files as a stream or a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.envelope import ENVELOPE_SCHEMA


def landing_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New envelope files below ``path``, at any depth, as an unbounded table."""
    reader = spark.readStream.schema(ENVELOPE_SCHEMA).option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).withColumn("_uoid", F.col("table_id.uoid"))


def sync_log(spark: SparkSession, path: str) -> DataFrame:
    """The sync log as a table; ``sync_date`` is a partition column."""
    return spark.read.parquet(path)
