"""How syncs went: views over the gateway event log and the sync log, and reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LAST_PART = r"([^\.]+)$"

# Only the fields the views use are parsed, once per row.
_DETAILS = (
    "flow_progress struct<status:string,metrics:struct<executor_time_ms:string,executor_cpu_time_ms:string>>,"
    "stream_progress struct<progress_json:string>,"
    "background_operation struct<op_type:string,status:string,duration_ms:string,"
    "num_rows_deleted:string,num_bytes_deleted:string,num_files_deleted:string>"
)
_ORIGIN = "cloud string, region string, org_id string, cluster_id string"


def gateway_parsed(gateway: DataFrame) -> DataFrame:
    """Flow events of the gateway with their JSON details as columns."""
    parsed = gateway.where(F.col("flow_name").isNotNull()).withColumns(
        {"_d": F.from_json("details", _DETAILS), "_o": F.from_json("origin", _ORIGIN)}
    )
    flow, work = "_d.flow_progress", "_d.background_operation"
    return parsed.select(
        F.col("id").alias("gateway_event_id"),
        "timestamp",
        F.col("update_id").alias("run_id"),
        "pipeline_id",
        "pipeline_name",
        "_o.cloud", "_o.region", "_o.org_id", "_o.cluster_id",
        "flow_name",
        F.regexp_extract("flow_name", LAST_PART, 1).alias("table_identifier"),
        "event_type", "level", "maturity_level", "message",
        F.col(f"{flow}.status").alias("flow_status"),
        F.col(f"{flow}.metrics.executor_time_ms").alias("executor_time_ms"),
        F.col(f"{flow}.metrics.executor_cpu_time_ms").alias("executor_cpu_time_ms"),
        F.col("_d.stream_progress.progress_json").alias("stream_progress_raw"),
        F.col(f"{work}.op_type").alias("bg_op_type"),
        F.col(f"{work}.status").alias("bg_op_status"),
        F.col(f"{work}.duration_ms").alias("bg_op_duration_ms"),
        F.col(f"{work}.num_rows_deleted").alias("bg_rows_deleted"),
        F.col(f"{work}.num_bytes_deleted").alias("bg_bytes_deleted"),
        F.col(f"{work}.num_files_deleted").alias("bg_files_deleted"),
    )


def pipeline_parsed(sync_log: DataFrame) -> DataFrame:
    """Sync log rows under the names the reports use."""
    return sync_log.select(
        "run_id",
        F.col("pipeline_id").alias("ct_pipeline_id"),
        "pipeline_config", "run_started_at", "run_completed_at", "run_duration_seconds",
        F.col("run_status").alias("overall_run_status"),
        "sync_date",
        F.col("server").alias("source_server"),
        F.col("database").alias("source_database"),
        "table_fqn", "table_name", "schema_name", "uc_catalog", "ingest_pipeline",
        F.regexp_extract("table_name", "(.+)$", 1).alias("table_identifier"),
        "rows_written", "files_written", "table_duration_seconds", "table_status",
        "configured_mode", "actual_mode", "scd_type", "soft_delete",
        "ct_since_version", "ct_current_version",
        "schema_version", "schema_changed", "column_count",
        "error_message", "error_type", "skip_reason",
    )


def _number(column: str) -> Column:
    return F.expr(f"try_cast({column} as double)")


def unified_metrics(gateway: DataFrame, pipeline: DataFrame) -> DataFrame:
    """Gateway events and sync results side by side, matched on run and table; ``pipeline`` is parsed.

    The full outer join is a left join, whose heavy groups Spark can split on the event side, and the
    results no event matches. Several events of one run and table repeat its result.
    """
    keys = ["run_id", "table_identifier"]
    events = gateway_parsed(gateway).select(
        *keys,
        F.col("timestamp").alias("gateway_timestamp"),
        "event_type", "level",
        _number("executor_time_ms").alias("executor_time_ms"),
        _number("executor_cpu_time_ms").alias("executor_cpu_time_ms"),
        "flow_status", "bg_op_type",
        _number("bg_op_duration_ms").alias("bg_op_duration_ms"),
        "cluster_id",
        F.col("message").alias("gateway_message"),
        F.lit(True).alias("_event"),
    )
    results = pipeline.select(
        *keys, "table_fqn", "table_name", "schema_name",
        F.col("source_database").alias("database_name"),
        "uc_catalog", "rows_written", "files_written", "table_duration_seconds", "table_status",
        "configured_mode", "actual_mode", "scd_type", "ct_current_version", "error_message",
        "run_started_at", "run_completed_at", "overall_run_status",
        F.lit(True).alias("_result"),
    )
    matched = events.join(results, keys, "left")
    seen = events.select(*keys).distinct()
    unmatched = results.join(seen, keys, "left_anti")
    both = matched.unionByName(unmatched, allowMissingColumns=True)
    seconds = F.col("executor_time_ms") / F.lit(1000.0)
    duration, written = F.col("table_duration_seconds"), F.col("rows_written")
    # A missing side is told by its run id, so a row without one counts as missing too.
    return both.select(
        *keys, "table_fqn", "table_name", "gateway_timestamp", "run_started_at", "run_completed_at",
        "overall_run_status", "table_status", "flow_status",
        F.col("event_type").alias("gateway_event_type"),
        F.col("level").alias("gateway_log_level"),
        "executor_time_ms", "executor_cpu_time_ms",
        seconds.alias("executor_time_seconds"),
        duration.alias("sync_duration_seconds"),
        "rows_written", "files_written",
        F.when((duration > 0) & (written > 0), written / duration).alias("rows_per_second"),
        "configured_mode", "actual_mode", "scd_type",
        F.col("ct_current_version").alias("change_tracking_version"),
        "bg_op_type", "bg_op_duration_ms", "error_message", "gateway_message",
        "database_name", "schema_name", "uc_catalog", "cluster_id",
        (F.col("_event").isNull() | F.col("run_id").isNull()).alias("missing_gateway_data"),
        (F.col("_result").isNull() | F.col("run_id").isNull()).alias("missing_pipeline_data"),
        F.abs(seconds - duration).alias("timing_variance_seconds"),
    )


def newest_first(unified: DataFrame) -> DataFrame:
    """The unified view in display order.

    The event time comes last, so that the many events of one run and table can be sorted in several tasks.
    Sorting samples its input first; the rows are shuffled before that, so that nothing is parsed twice.
    """
    return unified.hint("rebalance").orderBy(
        F.coalesce("run_started_at", "gateway_timestamp").desc(), "table_fqn", F.desc("gateway_timestamp")
    )


def recent(unified: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Rows whose event or run falls into the last ``days`` days before ``now``."""
    since = now - F.make_dt_interval(F.lit(days))
    return unified.where((F.col("gateway_timestamp") > since) | (F.col("run_started_at") > since))


def timing_variance(unified: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` successful syncs whose reported durations differ most."""
    compared = unified.where((F.col("table_status") == "success") & F.col("timing_variance_seconds").isNotNull())
    return (
        compared.select(
            "table_fqn", "run_id",
            F.col("sync_duration_seconds").alias("pipeline_reported_seconds"),
            F.col("executor_time_seconds").alias("gateway_reported_seconds"),
            "timing_variance_seconds", "rows_written",
        )
        .orderBy(
            F.desc("timing_variance_seconds"), "table_fqn", "run_id",
            "gateway_reported_seconds", "pipeline_reported_seconds", "rows_written",
        )
        .limit(k)
    )


def cpu_outliers(unified: DataFrame) -> DataFrame:
    """Processor time per written row of tables with more than one event."""
    grouped = unified.where(F.col("gateway_event_type") == "flow_progress").groupBy("table_fqn").agg(
        F.avg("executor_cpu_time_ms").alias("avg_cpu_ms"),
        F.avg("rows_written").alias("avg_rows"),
        F.count("*").alias("sync_count"),
    )
    per_row = F.col("avg_cpu_ms") / F.nullif(F.col("avg_rows"), F.lit(0.0))
    outliers = grouped.where(F.col("sync_count") > 1).withColumn("cpu_ms_per_row", per_row)
    return outliers.select("table_fqn", "avg_cpu_ms", "avg_rows", "cpu_ms_per_row", "sync_count").orderBy(F.desc("cpu_ms_per_row"))


def incomplete_runs(unified: DataFrame) -> DataFrame:
    """Runs for which some tables left no gateway event."""
    missing = F.col("missing_gateway_data")
    grouped = unified.groupBy("run_id").agg(
        F.count("*").alias("pipeline_table_count"),
        F.count_if(~missing).alias("gateway_event_count"),
        F.count_if(missing).alias("missing_gateway_count"),
    )
    return grouped.where(F.col("pipeline_table_count") != F.col("gateway_event_count")).orderBy(F.desc("missing_gateway_count"))


def throughput(unified: DataFrame) -> DataFrame:
    """Rows per second of successful syncs by table and mode."""
    worked = unified.where((F.col("table_status") == "success") & (F.col("rows_written") > 0))
    return worked.groupBy("table_fqn", "configured_mode", "actual_mode").agg(
        F.avg("rows_written").alias("avg_rows"),
        F.avg("sync_duration_seconds").alias("avg_duration"),
        F.avg("rows_per_second").alias("avg_throughput_rps"),
        F.max("rows_per_second").alias("peak_throughput_rps"),
    ).orderBy(F.desc("avg_throughput_rps"))


def background_operations(unified: DataFrame) -> DataFrame:
    """Count and duration of background operations by table and kind."""
    return unified.where(F.col("bg_op_type").isNotNull()).groupBy("table_fqn", "bg_op_type").agg(
        F.count("*").alias("op_count"),
        F.avg("bg_op_duration_ms").alias("avg_duration_ms"),
        F.max("bg_op_duration_ms").alias("max_duration_ms"),
    ).orderBy(F.desc("avg_duration_ms"))


SUMMARY_KEYS = ["sync_date", "table_fqn", "uc_catalog", "database_name", "schema_name", "configured_mode", "scd_type"]


def metrics_summary(unified: DataFrame) -> DataFrame:
    """Daily totals per table, with the exact median duration.

    Rows are first added up per group and duration, on the map side too. What is left of a group, one row
    per distinct duration, is ordered to find its middle, so no group is ever held in memory.
    """
    return finish_summary(summary_parts(unified))


def summary_parts(unified: DataFrame) -> DataFrame:
    """Sums, counts and maxima per group and duration; parts of disjoint rows make up one summary."""
    status = F.col("table_status")
    background = F.col("bg_op_type").isNotNull()
    sums = {
        "rows_written": F.col("rows_written").cast("double"),
        "executor_time": F.col("executor_time_seconds"),
        "cpu_time": F.col("executor_cpu_time_ms") / F.lit(1000.0),
        "rps": F.col("rows_per_second"),
        "bg_duration": F.when(background, F.col("bg_op_duration_ms")),
    }
    keyed = unified.withColumn("sync_date", F.date_trunc("day", F.coalesce("run_started_at", "gateway_timestamp")))
    return keyed.groupBy(*SUMMARY_KEYS, "sync_duration_seconds").agg(
        F.count("*").alias("n"),
        F.count_if(status == "success").alias("ok"),
        F.sum("rows_written").alias("rows_total"),
        F.sum("files_written").alias("files_total"),
        F.max("rows_per_second").alias("rps_max"),
        F.count_if(background).alias("bg_n"),
        *[F.sum(e).alias(f"{c}_sum") for c, e in sums.items()],
        *[F.count(e).alias(f"{c}_n") for c, e in sums.items()],
    )


def finish_summary(by_duration: DataFrame) -> DataFrame:
    """The summary from its parts."""
    seconds = F.col("sync_duration_seconds")
    group = W.partitionBy(*SUMMARY_KEYS)
    timed = F.when(seconds.isNotNull(), F.col("n")).otherwise(0)
    ranked = by_duration.withColumns(
        {
            "_upto": F.sum(timed).over(group.orderBy(F.col("sync_duration_seconds").asc_nulls_first())
                                       .rowsBetween(W.unboundedPreceding, W.currentRow)),
            "_timed": F.sum(timed).over(group),
        }
    ).withColumn("_from", F.col("_upto") - timed)

    def at_rank(rank: Column) -> Column:
        return F.max(F.when(seconds.isNotNull() & (F.col("_from") < rank) & (rank <= F.col("_upto")), seconds))

    low, high = F.expr("(_timed + 1) div 2"), F.expr("_timed div 2 + 1")

    def mean(name: str) -> Column:
        return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))

    return ranked.groupBy(*SUMMARY_KEYS).agg(
        F.sum("n").alias("total_sync_attempts"),
        F.sum("ok").alias("successful_syncs"),
        (F.sum("n") - F.sum("ok")).alias("failed_syncs"),
        F.sum("rows_total").alias("total_rows_written"),
        F.sum("files_total").alias("total_files_written"),
        mean("rows_written").alias("avg_rows_per_sync"),
        F.try_divide(F.sum(seconds * F.col("n")), F.sum(timed)).alias("avg_sync_duration"),
        F.max(seconds).alias("max_sync_duration"),
        ((at_rank(low) + at_rank(high)) / 2).alias("median_sync_duration"),
        mean("executor_time").alias("avg_executor_time"),
        mean("cpu_time").alias("avg_cpu_time_seconds"),
        mean("rps").alias("avg_throughput_rps"),
        F.max("rps_max").alias("peak_throughput_rps"),
        F.sum("bg_n").alias("bg_op_count"),
        mean("bg_duration").alias("avg_bg_op_duration_ms"),
    )
