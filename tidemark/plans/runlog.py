"""Sync results: log rows, status and totals of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.identity import qualified_name, schema_part, table_part
from tidemark.spec import DEFAULT_MODE

RESULT_FIELDS = (
    "run_id string, database string, table string, status string, mode string, scd_type int, soft_delete boolean,"
    " since_version bigint, current_version bigint, rows_written bigint, files array<string>,"
    " duration_seconds double, primary_key array<string>, columns array<string>, schema_version bigint,"
    " schema_changed boolean, reason string, error string, error_type string"
)


def table_status() -> Column:
    """``error`` and ``skipped`` as reported, anything else is a success."""
    status = F.col("status")
    return F.when(status.isin("error", "skipped"), status).otherwise("success")


def run_status(results: DataFrame) -> DataFrame:
    """``failure`` if every table of a run failed, ``partial_failure`` if some did, else ``success``."""
    failed = table_status() == "error"
    grouped = results.groupBy("run_id").agg(F.every(failed).alias("_all"), F.bool_or(failed).alias("_some"))
    status = F.when(F.col("_all"), "failure").when(F.col("_some"), "partial_failure").otherwise("success")
    return grouped.select("run_id", status.alias("run_status"))


def log_rows(results: DataFrame, runs: DataFrame, configured: DataFrame | None = None, targets: DataFrame | None = None) -> DataFrame:
    """The 31 columns of the sync log.

    ``runs`` has one row per run: run_id, pipeline_id, run_started_at, run_completed_at, server,
    pipeline_config, ingest_pipeline. ``configured`` (database, table, mode) and ``targets`` (database,
    uc_catalog) add what was asked for; table names match without regard to case.
    """
    joined = results.join(runs, "run_id").join(run_status(results), "run_id")
    if configured is not None:
        asked = configured.select(
            "database", qualified_name(F.col("table")).alias("_name"), F.coalesce("mode", F.lit(DEFAULT_MODE)).alias("configured_mode")
        )
        joined = joined.withColumn("_name", qualified_name(F.col("table"))).join(asked, ["database", "_name"], "left")
    else:
        joined = joined.withColumn("configured_mode", F.lit(None).cast("string"))
    if targets is not None:
        joined = joined.join(targets.select("database", "uc_catalog"), "database", "left")
    else:
        joined = joined.withColumn("uc_catalog", F.lit(None).cast("string"))
    schema_name, table_name = schema_part(F.col("table")), table_part(F.col("table"))
    elapsed = F.unix_micros(F.col("run_completed_at")) - F.unix_micros(F.col("run_started_at"))

    def length(column: str) -> Column:
        return F.when(F.size(column) > 0, F.size(column))

    return joined.select(
        "run_id", "pipeline_id", "run_started_at", "run_completed_at",
        F.round(elapsed / F.lit(1_000_000.0), 2).alias("run_duration_seconds"),
        "run_status", "pipeline_config", "server", "database",
        schema_name.alias("schema_name"),
        table_name.alias("table_name"),
        F.concat_ws(".", "database", schema_name, table_name).alias("table_fqn"),
        "uc_catalog", "ingest_pipeline", "configured_mode",
        F.col("mode").alias("actual_mode"),
        "scd_type", "soft_delete",
        F.col("since_version").alias("ct_since_version"),
        F.col("current_version").alias("ct_current_version"),
        "rows_written",
        length("files").alias("files_written"),
        F.col("duration_seconds").alias("table_duration_seconds"),
        "schema_version", "schema_changed",
        length("columns").alias("column_count"),
        table_status().alias("table_status"),
        F.col("reason").alias("skip_reason"),
        F.col("error").alias("error_message"),
        "error_type",
        F.to_date("run_started_at").alias("sync_date"),
    )


def run_totals(results: DataFrame) -> DataFrame:
    """Rows changed and whether any schema changed, over the tables of each run that did not fail."""
    ok = table_status() != "error"
    return results.groupBy("run_id").agg(
        F.coalesce(F.sum(F.when(ok, F.col("rows_written"))), F.lit(0)).alias("total_rows_changed"),
        F.coalesce(F.bool_or(F.when(ok, F.col("schema_changed"))), F.lit(False)).alias("schema_changes_detected"),
    )


def run_summary(results: DataFrame) -> DataFrame:
    """Tables done, rows, files and failures of each run; a skipped table counts as done, with no rows."""
    failed = table_status() == "error"
    return results.groupBy("run_id").agg(
        F.count_if(~failed).alias("tables_completed"),
        F.coalesce(F.sum(F.when(~failed, F.col("rows_written"))), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(~failed & F.col("files").isNotNull(), F.size("files"))), F.lit(0)).alias("total_files"),
        F.count_if(failed).alias("tables_failed"),
    )
