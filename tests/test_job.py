from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.widening import UnsupportedTypeChange
from tidemark.plans.job import ApplyFailed, SourceDatabase, SyncJob, run_apply

FEED = "table_name string, SYS_CHANGE_VERSION bigint, SYS_CHANGE_CREATION_VERSION bigint, SYS_CHANGE_OPERATION string, key string, data string"


def source(spark, feed, snapshots, columns=("id:int", "v:nvarchar")):
    tables = spark.createDataFrame([("dbo.a", None, 1, False), ("dbo.b", "full_incremental", 2, True), ("dbo.n", "incremental", 1, False)], "table_name string, mode string, scd_type int, soft_delete boolean")
    described = [(t, i + 1, *c.split(":"), None, None) for t in ("dbo.a", "dbo.b") for i, c in enumerate(columns)]
    return SourceDatabase(
        name="db",
        tables=tables,
        feed=spark.createDataFrame(feed, FEED),
        snapshots=spark.createDataFrame(snapshots, "table_name string, key string, data string"),
        bounds=spark.createDataFrame([("dbo.a", 1), ("dbo.b", 1), ("dbo.n", 1)], "table_name string, min_version bigint"),
        keys=spark.createDataFrame([("dbo.a", ["id"]), ("dbo.b", ["id"])], "table_name string, primary_key array<string>"),
        columns=spark.createDataFrame(described, "table_name string, ordinal int, name string, type string, precision int, scale int"),
        catalog="lake",
        target_schema="silver",
    )


def data(i, v):
    return '{"id":%d,"v":%s}' % (i, "null" if v is None else f'"{v}"')


def test_two_runs_and_two_applies(spark, folder):
    job = SyncJob(spark, f"{folder}/job")
    first = job.run(source(spark, [("dbo.a", 5, 5, "I", "1", data(1, "x"))], [("dbo.a", "1", data(1, "x")), ("dbo.b", "7", data(7, "p"))]))
    assert rows(first.select("table", "status", "mode", "rows_written")) == [
        ("dbo.a", None, "full", 1), ("dbo.b", None, "full", 1), ("dbo.n", "error", None, None),
    ]
    silver = run_apply(spark, job.landing, f"{folder}/lake", job.apply_plan(), buckets=2)
    assert rows(silver["lake.silver.a"].read()) == [(1, "x")]
    assert rows(silver["lake.silver.b"].read()) == [(7, "p", False, 5, None)]

    feed = [("dbo.a", 5, 5, "I", "1", data(1, "x")), ("dbo.a", 6, None, "D", "1", data(1, None)), ("dbo.a", 7, 7, "I", "2", data(2, "y"))]
    second = job.run(source(spark, feed, []))
    assert rows(second.select("table", "status", "mode", "since_version", "rows_written", "reason")) == [
        ("dbo.a", None, "incremental", 5, 2, None), ("dbo.b", "skipped", None, None, None, "no changes"), ("dbo.n", "error", None, None, None, None),
    ]
    silver = run_apply(spark, job.landing, f"{folder}/lake", job.apply_plan(), buckets=2)
    assert list(silver) == ["lake.silver.a"] and rows(silver["lake.silver.a"].read()) == [(2, "y")]
    assert rows(job.watermarks().select("table_name", "version", "mode")) == [("dbo.a", 7, "incremental"), ("dbo.b", 5, "full")]
    log = spark.read.parquet(job.log_path)
    assert log.count() == 6 and len(log.columns) == 31
    assert rows(log.groupBy("run_status").count()) == [("partial_failure", 6)]


def test_rows_count_though_the_books_fail(spark, folder, monkeypatch):
    job = SyncJob(spark, f"{folder}/job")

    def broken(*_):
        raise RuntimeError("no catalog")

    monkeypatch.setattr(SyncJob, "_update_history", broken)
    results = job.run(source(spark, [], [("dbo.a", "1", data(1, "x"))]))
    assert rows(results.where("table = 'dbo.a'").select("status", "rows_written")) == [(None, 1)]
    assert job.watermarks().count() == 2 and job.manifest.read().count() == 1


def test_nothing_is_recorded_when_landing_fails(spark, folder, monkeypatch):
    job = SyncJob(spark, f"{folder}/job")
    monkeypatch.setattr(SyncJob, "_land", lambda *_: (_ for _ in ()).throw(OSError("disk")))
    try:
        job.run(source(spark, [], [("dbo.a", "1", data(1, "x"))]))
        raise AssertionError("the run should fail")
    except OSError:
        assert job.watermarks().count() == 0


def test_schema_changes_show_in_the_results(spark, folder):
    job = SyncJob(spark, f"{folder}/job")
    job.run(source(spark, [("dbo.a", 1, 1, "I", "1", data(1, "x"))], [("dbo.a", "1", data(1, "x"))]))
    feed = [("dbo.a", 2, None, "U", "1", data(1, "z"))]
    results = job.run(source(spark, feed, [], columns=("id:bigint", "v:nvarchar", "w:int")))
    assert rows(results.where("table = 'dbo.a'").select("schema_changed")) == [(True,)]
    history = job.history.read().where(F.col("table_name") == "dbo.a").select("ordinal", "name", "type", "previous_type")
    assert rows(history) == [(1, "id", "bigint", "int"), (2, "v", "nvarchar", None), (3, "w", "int", None)]


def database(spark, name, configured, feed, snapshots, tracked=(("dbo.a", 1),)):
    return SourceDatabase(
        name=name,
        tables=spark.createDataFrame([(t, None, 1, False) for t in configured], "table_name string, mode string, scd_type int, soft_delete boolean"),
        feed=spark.createDataFrame(feed, FEED),
        snapshots=spark.createDataFrame(snapshots, "table_name string, key string, data string"),
        bounds=spark.createDataFrame(list(tracked), "table_name string, min_version bigint"),
        keys=spark.createDataFrame([("dbo.a", ["id"])], "table_name string, primary_key array<string>"),
        columns=spark.createDataFrame([("dbo.a", 1, "id", "int", None, None)], "table_name string, ordinal int, name string, type string, precision int, scale int"),
        catalog="lake",
        target_schema=name,
    )


def test_names_are_resolved_and_untracked_tables_refused(spark, folder):
    job = SyncJob(spark, f"{folder}/job")
    results = job.run(database(spark, "db", ["DBO.A", "lost"], [("dbo.a", 5, 5, "I", "1", data(1, "x"))], [("dbo.a", "1", data(1, "x"))]))
    assert rows(results.select("table", "status", "rows_written", "error")) == [("DBO.A", None, 1, None), ("lost", "error", None, "not tracked by the source")]
    assert rows(job.watermarks().select("table_name", "version")) == [("DBO.A", 5)]
    later = [("dbo.a", 5, 5, "I", "1", data(1, "x")), ("dbo.a", 6, 6, "I", "2", data(2, "y"))]
    results = job.run(database(spark, "db", ["DBO.A", "lost"], later, []))
    assert rows(results.select("table", "mode", "rows_written")) == [("DBO.A", "incremental", 1), ("lost", None, None)]


def test_databases_with_the_same_table_keep_apart(spark, folder):
    job = SyncJob(spark, f"{folder}/job")
    for name in ("one", "two"):
        results = job.run(database(spark, name, ["dbo.a"], [("dbo.a", 5, 5, "I", "1", data(1, name))], [("dbo.a", "1", data(1, name))]))
        assert rows(results.select("mode", "rows_written")) == [("full", 1)]
    assert rows(job.watermarks().select("database", "table_name", "version")) == [("one", "dbo.a", 5), ("two", "dbo.a", 5)]
    assert rows(job.history.read().select("database", "name")) == [("one", "id"), ("two", "id")]
    # A row of each database, and the barrier ahead of it.
    assert rows(spark.read.parquet(job.landing).groupBy("operation").count()) == [("LOAD", 2), ("RELOAD", 2)]


def test_a_reload_of_an_empty_table_clears_it(spark, folder):
    job = SyncJob(spark, f"{folder}/job")
    job.run(database(spark, "db", ["dbo.a"], [("dbo.a", 5, 5, "I", "1", data(1, "x"))], [("dbo.a", "1", data(1, "x"))]))
    # The watermark is older than what the source still has: the table is read anew, and is empty.
    results = job.run(database(spark, "db", ["dbo.a"], [("dbo.a", 9, None, "D", "1", data(1, None))], [], tracked=[("dbo.a", 8)]))
    assert rows(results.select("mode", "rows_written")) == [("full", 0)]
    # Nothing is left of what was landed but the barrier, which empties the table downstream too.
    assert rows(spark.read.parquet(job.landing).select("operation", "data")) == [("RELOAD", None)]


def test_a_refused_table_does_not_stop_the_others(spark, folder):
    job, first = SyncJob(spark, f"{folder}/job"), [("dbo.a", 5, 5, "I", "1", data(1, "x")), ("dbo.b", 5, 5, "I", "7", data(7, "p"))]
    rows_now = [(t, k, d) for t, _, _, _, k, d in first]
    job.run(source(spark, first, rows_now))
    plan = job.apply_plan()
    run_apply(spark, job.landing, f"{folder}/lake", plan, buckets=2)
    job.run(source(spark, [*first, ("dbo.b", 6, 6, "I", "8", data(8, "q"))], rows_now))
    # Column v of the first table turns into a number, which stored texts cannot be read as.
    narrowed = F.transform("columns", lambda c: c.withField("type", F.when((F.col("table_name") == "a") & (c["name"] == "v"), "int").otherwise(c["type"])))
    with pytest.raises(ApplyFailed) as failed:
        run_apply(spark, job.landing, f"{folder}/lake", plan.withColumn("columns", narrowed), buckets=2)
    assert isinstance(failed.value.errors["lake.silver.a"], UnsupportedTypeChange)
    assert rows(failed.value.tables["lake.silver.b"].read().select("id", "v")) == [(7, "p"), (8, "q")]
