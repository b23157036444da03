"""Landed envelopes into one bronze table that is read by all tables of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.envelope import ENVELOPE_SCHEMA
from tidemark.sources.landing import landing_stream


def start_bronze(spark: SparkSession, landing: str, bronze: str, checkpoint: str, max_files: int | None = None) -> StreamingQuery:
    """Appends new landed files to bronze, partitioned by table, and stops when it has caught up.

    The file sink records the files of each batch, so a repeated batch adds nothing.
    """
    stream = landing_stream(spark, landing, max_files).withColumn("_seq_num", F.expr("try_cast(cursor.seqNum as bigint)"))
    return (
        stream.writeStream.format("parquet")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .partitionBy("_uoid")
        .trigger(availableNow=True)
        .start()
    )


BRONZE_SCHEMA = T.StructType([*ENVELOPE_SCHEMA.fields]).add("_seq_num", "long").add("_uoid", "string")


def bronze_table(spark: SparkSession, bronze: str) -> DataFrame:
    """Bronze as a batch table."""
    return spark.read.schema(BRONZE_SCHEMA).parquet(bronze)


def bronze_stream(spark: SparkSession, bronze: str, max_files: int | None = None) -> DataFrame:
    """Bronze as a stream."""
    reader = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(bronze)
