"""Writing landed data, silver snapshots and the sync log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import partition_day
from tidemark.operators.envelope import type_null_columns, with_table_partition

# Accepted codec names and the one used when none is given.
CODECS = ("none", "snappy", "gzip", "brotli", "lz4", "zstd")
DEFAULT_CODEC = "zstd"
ROWS_PER_FILE = 1_000_000
DAY = "part_date"


def codec(name: str | None) -> str:
    """Accepted spelling of a compression codec."""
    chosen = (name or DEFAULT_CODEC).lower()
    if chosen not in CODECS:
        raise ValueError(f"compression {name!r} is not one of {sorted(CODECS)}")
    return chosen


def _writer(df: DataFrame, compression: str | None, level: int | None, rows_per_file: int, mode: str):
    chosen = codec(compression)
    writer = df.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    # lz4_raw is the framing the format defines; plain lz4 is an older one few readers accept.
    writer = writer.option("compression", {"lz4": "lz4_raw"}.get(chosen, chosen))
    if level is not None:
        writer = writer.option(f"parquet.compression.codec.{chosen}.level", level)
    return writer


def _evened(df: DataFrame, *columns: str) -> DataFrame:
    """Partitions of even size before a write; those with much data are split, small ones joined."""
    return df.hint("rebalance", *[F.col(c) for c in columns]) if columns else df.hint("rebalance")


def write_table(
    df: DataFrame,
    path: str,
    partition_column: str | None = None,
    compression: str | None = None,
    level: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    mode: str = "append",
) -> bool:
    """Native columns as Parquet, by day of ``partition_column`` if given. Writes nothing for no rows."""
    df = type_null_columns(df)
    if df.isEmpty():
        return False
    if partition_column is None or partition_column not in df.columns:
        _writer(df, compression, level, rows_per_file, mode).parquet(path)
        return True
    day = partition_day(F.col(partition_column), df.schema[partition_column].dataType)
    by_day = _evened(df.withColumn(DAY, day), DAY)
    _writer(by_day, compression, level, rows_per_file, mode).partitionBy(DAY).parquet(path)
    return True


def write_landing(
    envelopes: DataFrame,
    path: str,
    load_date: str,
    reload: bool = False,
    compression: str | None = None,
    level: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Envelopes below one folder per table.

    ``reload`` replaces all that was landed before for the tables in ``envelopes``, and only for these; a table that is
    empty now is among them by its reload barrier.
    """
    dated = with_table_partition(envelopes).withColumn("load_date", F.lit(load_date).cast("date"))
    writer = _writer(_evened(dated, "_uoid"), compression, level, rows_per_file, "overwrite" if reload else "append")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("_uoid").parquet(path)


def write_sync_log(rows: DataFrame, path: str) -> None:
    """Appends log rows of a run below their ``sync_date``; concurrent runs add files of their own."""
    _evened(rows, "sync_date").write.mode("append").partitionBy("sync_date").parquet(path)


def write_snapshot(silver: DataFrame, path: str, version: int) -> str:
    """A whole silver table as a folder of its own version."""
    target = f"{path}/v={version}"
    _evened(silver).write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(target)
    return target
