from __future__ import annotations

from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.diff import snapshot_changes
from tidemark.operators.envelope import to_envelope
from tidemark.operators.sinks import codec, write_landing, write_snapshot, write_sync_log, write_table
from tidemark.sources.landing import sync_log


def files(folder):
    return [f for f in Path(folder).rglob("*.parquet") if not f.name.startswith(("_", "."))]


def test_files_are_split_by_rows(spark, folder):
    df = spark.range(11).coalesce(1)
    assert write_table(df, f"{folder}/t", rows_per_file=5)
    counts = sorted(spark.read.parquet(str(f)).count() for f in files(f"{folder}/t"))
    assert counts == [1, 5, 5]


def test_nothing_is_written_for_no_rows(spark, folder):
    assert not write_table(spark.range(0), f"{folder}/t")
    assert not Path(f"{folder}/t").exists()


def test_day_partitions(spark, folder):
    df = spark.sql("SELECT * FROM VALUES (1, timestamp'2025-02-25 10:00:00'), (2, timestamp'2025-02-25 23:00:00'), (3, timestamp'2025-02-26 00:00:00'), (4, null) AS t(id, dt)")
    write_table(df, f"{folder}/t", partition_column="dt")
    assert sorted(p.name for p in Path(f"{folder}/t").glob("part_date=*")) == [
        "part_date=2025-02-25", "part_date=2025-02-26", "part_date=_unknown",
    ]
    assert spark.read.parquet(f"{folder}/t").count() == 4


@pytest.mark.parametrize("name", ["none", "snappy", "GZIP", "lz4", "zstd", None])
def test_codecs(spark, folder, name):
    write_table(spark.range(5), f"{folder}/t", compression=name)
    assert spark.read.parquet(f"{folder}/t").count() == 5


def test_zstd_level_and_unknown_codec(spark, folder):
    write_table(spark.range(5), f"{folder}/t", compression="zstd", level=9)
    assert spark.read.parquet(f"{folder}/t").count() == 5
    assert codec("") == "zstd"
    with pytest.raises(ValueError):
        codec("zip")


def test_untyped_columns_can_be_written(spark, folder):
    write_table(spark.range(2).withColumn("n", F.lit(None)), f"{folder}/t")
    assert dict(spark.read.parquet(f"{folder}/t").dtypes)["n"] == "bigint"


def _envelopes(spark, table, n):
    changes = spark.range(n).select(F.lit(1).cast("bigint").alias("SYS_CHANGE_VERSION"), F.lit("L").alias("SYS_CHANGE_OPERATION"), "id")
    return to_envelope(changes, "db", "dbo", table)


def test_a_reload_replaces_only_its_own_table(spark, folder):
    path = f"{folder}/landing"
    write_landing(_envelopes(spark, "a", 3), path, "2024-01-01")
    write_landing(_envelopes(spark, "a", 2), path, "2024-01-02")
    write_landing(_envelopes(spark, "b", 4), path, "2024-01-02")
    write_landing(_envelopes(spark, "a", 7), path, "2024-01-03", reload=True)
    landed = spark.read.parquet(path).groupBy("table_id.name").agg(F.count("*"), F.min(F.col("load_date").cast("string")))
    assert rows(landed) == [("a", 7, "2024-01-03"), ("b", 4, "2024-01-02")]


def test_sync_logs_of_several_runs_add_up(spark, folder):
    for run in ("r1", "r2"):
        log = spark.createDataFrame([(run, "t1"), (run, "t2")], "run_id string, table_name string")
        write_sync_log(log.withColumn("sync_date", F.lit("2026-03-03").cast("date")), f"{folder}/log")
    assert rows(sync_log(spark, f"{folder}/log").groupBy("sync_date").count().select(F.col("sync_date").cast("string"), "count")) == [("2026-03-03", 4)]


def test_snapshots_and_their_difference(spark, folder):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    new = spark.createDataFrame([(2, "B"), (3, None), (4, "d")], "id int, v string")
    first, second = write_snapshot(old, f"{folder}/s", 1), write_snapshot(new, f"{folder}/s", 2)
    changes = snapshot_changes(spark.read.parquet(first), spark.read.parquet(second), ["id"])
    assert rows(changes) == [("delete", 1, "a"), ("insert", 4, "d"), ("update_postimage", 2, "B"), ("update_preimage", 2, "b")]
