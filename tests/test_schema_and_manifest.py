from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import manifest, schema_history
from tidemark.plans import runlog

COLUMNS = "table_name string, ordinal int, name string, type string, precision int, scale int"


def at(day):
    return F.lit(day).cast("timestamp")


def history(spark, columns, version=1):
    df = spark.createDataFrame([("t", i + 1, *c) for i, c in enumerate(columns)], COLUMNS)
    return df.select("*", F.lit(None).cast("string").alias("previous_type"), at("2024-01-01").alias("last_seen"), F.lit(version).cast("bigint").alias("schema_version"))


def incoming(spark, columns):
    return spark.createDataFrame([("t", i + 1, *c) for i, c in enumerate(columns)], COLUMNS)


def merged(spark, old, new, version=2):
    versions = spark.createDataFrame([("t", version)], "table_name string, schema_version bigint")
    df = schema_history.merge_schema(history(spark, old), incoming(spark, new), versions, at("2024-02-01"))
    shown = df.orderBy("ordinal").select("ordinal", "name", "type", "precision", "scale", "previous_type", F.date_format("last_seen", "MM"), "schema_version")
    return [tuple(r) for r in shown.collect()]


INT, TEXT = ("id", "int", 10, 0), ("note", "nvarchar", None, None)


def test_columns_are_added_and_never_removed(spark):
    assert merged(spark, [INT, TEXT], [("x", "bit", None, None), INT, ("y", "date", None, None)]) == [
        (1, "id", "int", 10, 0, None, "02", 2), (2, "note", "nvarchar", None, None, None, "01", 2),
        (3, "x", "bit", None, None, None, "02", 2), (4, "y", "date", None, None, None, "02", 2),
    ]


def test_a_new_type_replaces_the_old_one_and_its_size(spark):
    assert merged(spark, [("a", "decimal", 9, 2)], [("a", "int", None, None)]) == [(1, "a", "int", None, None, "decimal", "02", 2)]
    assert merged(spark, [("a", "decimal", 9, 2)], [("a", "decimal", 12, None)]) == [(1, "a", "decimal", 12, 2, None, "02", 2)]


def test_nothing_moves_while_nothing_changed(spark):
    assert merged(spark, [INT, TEXT], [INT], version=1) == [(1, "id", "int", 10, 0, None, "01", 1), (2, "note", "nvarchar", None, None, None, "01", 1)]
    assert [r[6] for r in merged(spark, [INT, TEXT], [INT], version=5)] == ["02", "01"]


def test_names_differ_by_case(spark):
    assert [r[1] for r in merged(spark, [INT], [("ID", "int", 10, 0)])] == ["id", "ID"]


def test_a_table_without_history_starts_one(spark):
    assert merged(spark, [], [INT, TEXT]) == [(1, "id", "int", 10, 0, None, "02", 2), (2, "note", "nvarchar", None, None, None, "02", 2)]
    assert rows(schema_history.schema_diff(history(spark, []), incoming(spark, [INT]))) == []


def test_drift_without_a_column_change(spark):
    versions = spark.createDataFrame([("t", 9)], "table_name string, schema_version bigint")
    status = schema_history.schema_status(history(spark, [INT]), incoming(spark, [INT]), versions)
    assert rows(status) == [("t", 0, False, True)]


RESULT = "database string, table string, status string, files array<string>, rows_written bigint, scd_type int, soft_delete boolean, primary_key array<string>"


def results(spark, *rows_):
    return spark.createDataFrame([(*r, 1, True, ["id"]) for r in rows_], RESULT)


@pytest.mark.parametrize(
    "status,files,written,listed",
    [(None, ["f"], 0, True), (None, [], 9, False), (None, None, 3, True), (None, None, 0, False), (None, None, None, True), ("error", ["f"], 1, False)],
)
def test_which_results_are_listed(spark, status, files, written, listed):
    got = manifest.entries(results(spark, ("db", "dbo.t", status, files, written)), "/data", "parquet")
    assert got.count() == int(listed)


def test_known_entries_stay(spark):
    targets = spark.createDataFrame([("db", "dbo", "lake", "silver")], "database string, schema_name string, catalog_target string, schema_target string")
    first = manifest.entries(results(spark, ("db", "dbo.a", None, ["f"], 1)), "/old", "parquet", targets)
    again = manifest.entries(results(spark, ("db", "dbo.a", None, ["f"], 1), ("db", "dbo.b", None, ["f"], 1), ("db", "nodot", None, ["f"], 1)), "/new", "parquet", targets)
    listed = manifest.merge_add(first, again)
    assert rows(listed.select("table_name", "catalog_target", "table_target", "file_path")) == [("a", "lake", "a", "/old/db/dbo/a"), ("b", "lake", "b", "/new/db/dbo/b")]


def test_choice_of_manifest(spark):
    untargeted = manifest.incremental(results(spark, ("db", "dbo.a", None, ["f"], 1)), "/d", "parquet")
    targeted = untargeted.withColumns({"catalog_target": F.lit("c"), "schema_target": F.lit("s")})
    assert manifest.choose(untargeted, targeted) is targeted
    assert manifest.choose(targeted, None) is targeted
    with pytest.raises(FileNotFoundError):
        manifest.choose(untargeted, None)


def test_plan_has_defaults_and_leaves_out_unnamed_targets(spark):
    listed = spark.createDataFrame(
        [("db", "dbo", "a", "c", "s", "a", "/p", "parquet", None, None, None), ("db", "dbo", "b", None, "s", "b", "/p", "parquet", 2, True, ["id"])], manifest.FIELDS
    )
    history_ = spark.createDataFrame([("db", "dbo", "a", 2, "y", "int"), ("db", "dbo", "a", 1, "x", "int")], "database string, schema_name string, table_name string, ordinal int, name string, type string")
    plan = manifest.apply_plan(listed, history_.withColumns({c: F.lit(None).cast("int") for c in ("precision", "scale")})).collect()
    assert [(r.target, r.primary_key, r.scd_type, r.soft_delete, [c.name for c in r.columns]) for r in plan] == [("c.s.a", [], 1, False, ["x", "y"])]


def test_flatten_keeps_entries_without_targets(spark):
    document = '{"databases":{"db":{"uc_catalog_name":null,"dbo":{"uc_schema_name":"s","t1":{"file_path":"/p","primary_key":["id"]},"note":"text"}},"odd":"text"}}'
    got = manifest.flatten(spark.createDataFrame([(document,)], "manifest string")).select("database", "schema_name", "table_name", "catalog_target", "schema_target", "file_path", "primary_key")
    assert rows(got) == [("db", "dbo", "t1", None, "s", "/p", ["id"])]


def run(spark, *statuses):
    df = spark.createDataFrame([("r", s, 5, True) for s in statuses], "run_id string, status string, rows_written bigint, schema_changed boolean")
    return df.withColumn("files", F.array(F.lit("f")))


@pytest.mark.parametrize(
    "statuses,expected",
    [((None,), "success"), (("error", "error"), "failure"), (("error", None), "partial_failure"), (("skipped",), "success"), (("error", "skipped"), "partial_failure")],
)
def test_run_status(spark, statuses, expected):
    assert rows(runlog.run_status(run(spark, *statuses))) == [("r", expected)]


def test_totals_leave_failures_out(spark):
    assert rows(runlog.run_totals(run(spark, None, "error"))) == [("r", 5, True)]
    assert rows(runlog.run_totals(run(spark, "error"))) == [("r", 0, False)]
    assert rows(runlog.run_summary(run(spark, None, "error", "skipped"))) == [("r", 2, 10, 2, 1)]
