"""Extraction of typed tables: one job, and errors that stay with their table."""

from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from tidemark.plans.extract import SourceTable, extract_tables, write_together
from tidemark.plans.job import SyncJob, TypedDatabase, run_apply
from tidemark.sources.feed import CREATION_VERSION, OPERATION, VERSION

BOUNDS = "table_name string, min_version bigint, max_version bigint"


def feed(spark, changes, keys="id long"):
    return lambda: spark.createDataFrame(changes, f"{VERSION} bigint, {CREATION_VERSION} bigint, {OPERATION} string, {keys}")


def source(spark, bounds, *tables):
    return TypedDatabase("db", tables, spark.createDataFrame([(t, 1, v) for t, v in bounds], BOUNDS), catalog="lake", target_schema="silver")


def test_tables_of_different_schemas_in_two_runs(spark, folder):
    job = SyncJob(spark, f"{folder}/job")
    a = lambda *r: lambda: spark.createDataFrame(list(r), "id long, v string")
    b = lambda *r: lambda: spark.createDataFrame(list(r), "k int, x double, y boolean")
    first = job.run_tables(source(spark, [("dbo.a", 5), ("s.b", 3)], SourceTable("dbo.a", a((1, "p"), (2, None)), ("id",)), SourceTable("s.b", b((7, 1.5, True)), ("k",), scd_type=2)))
    assert rows(first.select("table", "status", "mode", "rows_written")) == [("dbo.a", None, "full", 2), ("s.b", None, "full", 1)]
    assert all(r.duration_seconds is not None and r.duration_seconds < 60 for r in first.collect())
    silver = run_apply(spark, job.landing, f"{folder}/lake", job.apply_plan(), buckets=2)
    assert rows(silver["lake.silver.a"].read()) == [(1, "p"), (2, None)]
    changes = feed(spark, [(6, None, "U", 2), (7, None, "D", 1), (8, 8, "I", 3), (4, None, "U", 9)])
    second = job.run_tables(source(spark, [("dbo.a", 8), ("s.b", 3)], SourceTable("dbo.a", a((2, "q"), (3, "r")), ("id",), changes), SourceTable("s.b", b(), ("k",), scd_type=2)))
    assert rows(second.select("table", "status", "mode", "since_version", "rows_written")) == [("dbo.a", None, "incremental", 5, 3), ("s.b", "skipped", None, None, None)]
    silver = run_apply(spark, job.landing, f"{folder}/lake", job.apply_plan(), buckets=2)
    assert rows(silver["lake.silver.a"].read()) == [(2, "q"), (3, "r")]
    assert rows(job.watermarks().select("table_name", "version", "rows_synced")) == [("dbo.a", 8, 3), ("s.b", 5, 1)]


def test_a_table_that_fails_stands_alone(spark, folder):
    def closed():
        raise ConnectionError("no route")

    good = [SourceTable(f"dbo.t{i}", lambda i=i: spark.range(i, i + 3), ("id",)) for i in range(5)]
    broken = SourceTable("dbo.broken", lambda: spark.range(3).withColumn("v", F.raise_error(F.lit("page is torn"))), ("id",))
    missing = SourceTable("dbo.missing", lambda: spark.read.parquet(f"{folder}/nothing"), ("id",))
    tables = [*good[:3], SourceTable("dbo.closed", closed, ("id",)), broken, missing, *good[3:]]
    job = SyncJob(spark, f"{folder}/job")
    results = job.run_tables(source(spark, [(t.name, 1) for t in tables], *tables))
    got = {r.table: (r.status, r.rows_written, r.error_type) for r in results.collect()}
    assert {t: g for t, g in got.items() if t in {x.name for x in good}} == {t.name: (None, 3, None) for t in good}
    assert got["dbo.closed"] == ("error", None, "ConnectionError")
    assert got["dbo.broken"][:2] == got["dbo.missing"][:2] == ("error", None)
    assert all(r.error for r in results.where("status = 'error'").collect())
    assert {r[0] for r in job.watermarks().select("table_name").collect()} == {t.name for t in good}
    assert rows(spark.read.parquet(job.landing).groupBy("operation").count()) == [("LOAD", 15), ("RELOAD", 5)]


def test_an_empty_full_read_replaces_what_was_landed(spark, folder):
    job = SyncJob(spark, f"{folder}/job")
    with_rows = SourceTable("dbo.a", lambda: spark.range(4), ("id",))
    job.run_tables(source(spark, [("dbo.a", 1)], with_rows))
    lost = source(spark, [], SourceTable("dbo.a", lambda: spark.range(0), ("id",)))
    assert rows(job.run_tables(lost).select("status", "error")) == [("error", "not tracked by the source")]
    stale = TypedDatabase("db", (SourceTable("dbo.a", lambda: spark.range(0), ("id",), feed(spark, [])),), spark.createDataFrame([("dbo.a", 5, 9)], BOUNDS))
    assert rows(job.run_tables(stale).select("mode", "rows_written")) == [("full", 0)]
    left = [r for r in spark.read.schema("operation string, _uoid string").parquet(job.landing).collect() if r.operation == "LOAD"]
    assert left == []


def test_the_feed_is_scanned_once(spark, folder):
    feed(spark, [(2, None, "U", 1)])().write.parquet(f"{folder}/feed")
    spark.range(3).write.parquet(f"{folder}/rows")
    table = SourceTable("dbo.a", lambda: spark.read.parquet(f"{folder}/rows"), ("id",), lambda: spark.read.parquet(f"{folder}/feed"))
    plans = []
    marks, bounds = spark.createDataFrame([("dbo.a", 1)], "table_name string, version bigint"), spark.createDataFrame([("dbo.a", 1, 2)], BOUNDS)

    def write(frame, mode):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        frame.write.mode("append").parquet(f"{folder}/out")

    done = extract_tables(spark, "db", [table], marks, bounds, write, 1)
    assert len(plans) == 1 and plans[0].count("FileScan parquet") == 2  # the feed and the table
    assert rows(done.results.select("status", "rows_written")) == [("success", 1)]


def test_outcomes_of_empty_frames(spark, folder):
    done = write_together({"a": spark.range(5), "b": spark.range(0), "c": spark.range(3).where("false")}, lambda df: df.write.parquet(f"{folder}/out"))
    assert {name: o.rows for name, o in done.items()} == {"a": 5, "b": 0, "c": 0}
    assert write_together({}, None) == {}
