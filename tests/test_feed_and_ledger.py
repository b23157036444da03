from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import ledger
from tidemark.plans.sync_run import sync_tables
from tidemark.sources import jdbc
from tidemark.sources.catalog import primary_key_map, resolve_tables
from tidemark.sources.feed import current_version, feed_bounds, full_load, incremental_changes, net_changes
from tidemark.spec import TableSpec, tables_frame

LOG = "SYS_CHANGE_VERSION bigint, SYS_CHANGE_CREATION_VERSION bigint, SYS_CHANGE_OPERATION string, id int"


def test_full_and_incremental_reads_have_one_schema(spark):
    people = spark.createDataFrame([(1, "Alice"), (2, "Bob")], "id int, name string")
    feed = spark.createDataFrame([(101, 101, "I", 2), (102, None, "D", 3), (90, None, "U", 1)], LOG)
    full = full_load(people, 100)
    assert rows(full) == [(100, None, "L", 1, "Alice"), (100, None, "L", 2, "Bob")]
    changes = incremental_changes(feed, people, ["ID"], 100)
    assert rows(changes) == [(101, 101, "I", 2, "Bob"), (102, None, "D", 3, None)]
    assert full.dtypes == changes.dtypes
    with pytest.raises(ValueError):
        incremental_changes(feed, people, [], 100)


def test_net_changes(spark):
    log = spark.createDataFrame(
        [(1, 1, "I", 1), (2, None, "U", 1), (3, None, "U", 2), (4, None, "D", 3), (5, 5, "I", 3), (6, 6, "I", 4), (7, None, "D", 4), (8, None, "L", 5)], LOG
    )
    assert rows(net_changes(log, ["id"])) == [(2, 1, "I", 1), (3, None, "U", 2), (5, 5, "I", 3), (7, 6, "D", 4), (8, None, "L", 5)]
    assert rows(net_changes(log, ["id"], since=5)) == [(7, 6, "D", 4), (8, None, "L", 5)]


def test_bounds_of_an_empty_feed(spark):
    empty = spark.createDataFrame([], f"table_name string, {LOG}")
    assert rows(feed_bounds(empty)) == [] and current_version(empty) == 0


def test_names_are_resolved_without_case(spark):
    configured = spark.createDataFrame([("T1",), (" DBO.t2 ",), ("nope",), ("Sales.X",)], "table_name string")
    tracked = spark.createDataFrame([("dbo.t1",), ("dbo.T2",), ("sales.x",)], "table_name string")
    assert rows(resolve_tables(configured, tracked)) == [
        (" DBO.t2 ", "dbo.T2", "ok"), ("Sales.X", "sales.x", "ok"), ("T1", "dbo.t1", "ok"), ("nope", None, "error"),
    ]


def test_keys_come_in_key_order(spark):
    indexes = spark.createDataFrame([("t", 1, True), ("t", 2, False)], "table_name string, index_id int, is_primary_key boolean")
    members = spark.createDataFrame([("t", 1, 2, 10), ("t", 1, 1, 20), ("t", 2, 1, 30)], "table_name string, index_id int, key_ordinal int, column_id int")
    columns = spark.createDataFrame([("t", 10, "b"), ("t", 20, "a"), ("t", 30, "c")], "table_name string, column_id int, name string")
    assert rows(primary_key_map(indexes, members, columns)) == [("t", ["a", "b"])]


def test_old_entries_are_bare_numbers(spark):
    raw = spark.createDataFrame([("a", "42"), ("b", '{"version":7,"mode":"full","files":["f"]}')], "table_name string, entry string")
    assert rows(ledger.parse_entries(raw).select("table_name", "version", "mode", "files")) == [("a", 42, None, None), ("b", 7, "full", ["f"])]


def test_latest_watermark_and_history_order(spark):
    entries = spark.createDataFrame([("a", 5, "t2"), ("a", 3, "t1"), ("b", 1, "t1")], "table_name string, version bigint, synced_at string")
    assert rows(ledger.latest_watermarks(entries).select("table_name", "version")) == [("a", 5), ("b", 1)]
    assert [r.version for r in ledger.sync_history(entries).collect()] == [3, 1, 5]


def test_entries_of_a_run(spark):
    results = spark.createDataFrame(
        [("a", 9, 5, 3, "incremental", None, 1.23456, None), ("b", 9, None, None, None, None, None, "error"), ("c", 9, None, None, None, None, None, "skipped")],
        "table_name string, current_version bigint, since_version bigint, rows_written bigint, mode string, files array<string>, duration_seconds double, status string",
    )
    assert rows(ledger.ledger_entry(results, F.lit("now"))) == [("a", 9, 5, 3, "incremental", [], 1.23, "now")]


MODES = [
    # configured, watermark, lowest version -> actual mode, since
    ("full_incremental", None, 5, "full", None),
    ("full_incremental", 10, 5, "incremental", 10),
    ("full_incremental", 5, 5, "incremental", 5),
    ("full_incremental", 4, 5, "full", None),
    ("incremental", 10, 5, "incremental", 10),
    ("incremental", 4, 5, "full", None),
    ("incremental", None, 5, None, None),
    ("full", 10, 5, None, None),
    (None, 10, None, "incremental", 10),
]


@pytest.mark.parametrize("mode,mark,low,actual,since", MODES)
def test_modes(spark, mode, mark, low, actual, since):
    tables = spark.createDataFrame([("T", mode)], "table_name string, mode string")
    marks = spark.createDataFrame([("dbo.t", mark)] if mark is not None else [], "table_name string, version bigint")
    bounds = spark.createDataFrame([("dbo.t", low)], "table_name string, min_version bigint")
    got = ledger.resolve_modes(tables, marks, bounds).first()
    assert (got.actual_mode, got.since_version) == (actual, since)
    assert (got.status == "error") == (actual is None)


def test_an_incremental_read_without_key_is_an_error_row(spark):
    tables = spark.createDataFrame([("dbo.t", "incremental")], "table_name string, mode string")
    marks = spark.createDataFrame([("dbo.t", 9)], "table_name string, version bigint")
    bounds = spark.createDataFrame([("dbo.t", 1)], "table_name string, min_version bigint")
    no_keys = spark.createDataFrame([], "table_name string, primary_key array<string>")
    assert ledger.resolve_modes(tables, marks, bounds, no_keys).first().error == "no primary key for an incremental read"


def test_one_run_over_many_tables(spark):
    feed = spark.createDataFrame(
        [("dbo.a", 11, "U", "1", "{}"), ("dbo.a", 12, "U", "2", "{}"), ("dbo.b", 3, "I", "1", "{}"), ("dbo.c", 5, "I", "1", "{}"), ("dbo.c", 14, "D", "1", None)],
        "table_name string, SYS_CHANGE_VERSION bigint, SYS_CHANGE_OPERATION string, key string, data string",
    )
    tables = spark.createDataFrame([("dbo.a", None), ("dbo.b", None), ("dbo.c", None), ("dbo.d", "incremental")], "table_name string, mode string")
    marks = spark.createDataFrame([("dbo.a", 11), ("dbo.b", 3), ("dbo.c", 2)], "table_name string, version bigint")
    bounds = spark.createDataFrame([("dbo.a", 1), ("dbo.b", 1), ("dbo.c", 4), ("dbo.d", 1)], "table_name string, min_version bigint")
    snapshots = spark.createDataFrame([("dbo.c", "8", "{}"), ("dbo.c", "9", "{}"), ("dbo.a", "1", "{}")], "table_name string, key string, data string")
    run = sync_tables(tables, marks, bounds, feed, snapshots)
    got = run.results.select("table_name", "actual_mode", "since_version", "current_version", "rows_written", "status")
    assert rows(got) == [
        ("dbo.a", "incremental", 11, 14, 1, "success"), ("dbo.b", None, None, None, None, "skipped"),
        ("dbo.c", "full", None, 14, 2, "success"), ("dbo.d", None, None, None, None, "error"),
    ]
    assert rows(run.changes.select("table_name", "SYS_CHANGE_OPERATION", "key")) == [("dbo.a", "U", "2"), ("dbo.c", "L", "8"), ("dbo.c", "L", "9")]


@pytest.mark.parametrize("field,value", [("mode", "full"), ("scd_type", 3), ("soft_delete", "yes")])
def test_specs_are_checked(field, value):
    with pytest.raises(ValueError):
        TableSpec("d", "s", "t", ("id",), **{field: value})


def test_specs_become_a_control_table(spark):
    specs = [TableSpec("d", "s", "t", "id"), TableSpec("d", "s", "u", ["a", "b"], "incremental", 2, True)]
    assert rows(tables_frame(spark, specs)) == [
        ("d", "s.t", "full_incremental", 1, False, ["id"]), ("d", "s.u", "incremental", 2, True, ["a", "b"]),
    ]


class _Reader:
    """Stands in for a session and its reader and remembers the options."""

    def __init__(self):
        self.read, self.seen = self, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **values):
        self.seen |= values
        return self

    def load(self):
        return self.seen


def test_jdbc_options():
    whole = jdbc.read_jdbc(_Reader(), "jdbc:x", table="dbo.t")
    assert whole == {"format": "jdbc", "url": "jdbc:x", "fetchsize": 10_000, "dbtable": "dbo.t"}
    ranged = jdbc.read_jdbc(_Reader(), "jdbc:x", query="SELECT 1", partition_column="ID", bounds=(1, 9), partitions=4, snapshot_isolation=True)
    assert ranged["dbtable"] == "(SELECT 1) ranged" and ranged["numPartitions"] == 4 and "SNAPSHOT" in ranged["sessionInitStatement"]
    with pytest.raises(ValueError):
        jdbc.read_jdbc(_Reader(), "jdbc:x")
    with pytest.raises(ValueError):
        jdbc.read_jdbc(_Reader(), "jdbc:x", table="t", partition_column="ID")
