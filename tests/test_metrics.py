from __future__ import annotations

import datetime
import random

from conftest import rows
from pyspark.sql import functions as F

from tidemark.plans import metrics, refresh
from tidemark.plans.refresh import RefreshedSummary

GATEWAY = (
    "id string, timestamp timestamp, update_id string, pipeline_id string, pipeline_name string, origin string, flow_name string,"
    " event_type string, level string, maturity_level string, message string, details string"
)
PIPELINE = (
    "run_id string, table_identifier string, table_fqn string, table_name string, schema_name string, source_database string,"
    " uc_catalog string, rows_written bigint, files_written int, table_duration_seconds double, table_status string,"
    " configured_mode string, actual_mode string, scd_type int, ct_current_version bigint, error_message string,"
    " run_started_at timestamp, run_completed_at timestamp, overall_run_status string"
)
FLOW = '{"flow_progress":{"status":"COMPLETED","metrics":{"executor_time_ms":%d,"executor_cpu_time_ms":%d}}}'


def gateway(spark, *events):
    """Events given as (run, flow, details)."""
    rows_ = [(str(i), None, run, "p", "n", '{"cluster_id":"c"}', flow, "flow_progress", "INFO", "STABLE", "m", details) for i, (run, flow, details) in enumerate(events)]
    return spark.createDataFrame(rows_, GATEWAY)


def pipeline(spark, *results):
    """Results given as (run, table, rows, seconds)."""
    rows_ = [(run, t, f"db.dbo.{t}", t, "dbo", "db", "c", n, 1, s, "success", "full_incremental", "full", 1, 9, None, None, None, "success") for run, t, n, s in results]
    return spark.createDataFrame(rows_, PIPELINE)


def test_flow_names_and_details(spark):
    parsed = metrics.gateway_parsed(gateway(spark, ("r", "cat.sch.t1", FLOW % (1500, 70)), ("r", None, None), ("r", "t2", "broken")))
    got = parsed.select("table_identifier", "flow_status", "executor_time_ms", "cluster_id")
    assert rows(got) == [("t1", "COMPLETED", "1500", "c"), ("t2", None, None, "c")]


def test_both_sides_are_kept(spark):
    events = gateway(spark, ("r1", "a.t1", FLOW % (1000, 1)), ("r1", "a.t1", FLOW % (3000, 1)), ("r2", "a.t1", FLOW % (1, 1)), (None, "a.t9", FLOW % (1, 1)))
    results = pipeline(spark, ("r1", "t1", 10, 2.0), ("r3", "t1", 10, 0.0), (None, "t9", 1, 1.0))
    unified = metrics.unified_metrics(events, results)
    got = unified.select("run_id", "table_identifier", "executor_time_seconds", "rows_per_second", "missing_gateway_data", "missing_pipeline_data", "timing_variance_seconds")
    assert rows(got) == rows(spark.createDataFrame(
        [
            ("r1", "t1", 1.0, 5.0, False, False, 1.0), ("r1", "t1", 3.0, 5.0, False, False, 1.0), ("r2", "t1", 0.001, None, False, True, None),
            ("r3", "t1", None, None, True, False, None), (None, "t9", 0.001, None, True, True, None), (None, "t9", None, 1.0, True, True, None),
        ],
        got.schema,
    ))


def test_summary_median_is_exact(spark):
    rng = random.Random(1)
    results = [(f"r{i}", rng.choice(["t1", "t2"]), 1, rng.choice([None, round(rng.random() * 5, 2)])) for i in range(101)]
    unified = metrics.unified_metrics(gateway(spark), pipeline(spark, *results))
    summary = metrics.metrics_summary(unified).select("table_fqn", "median_sync_duration", "avg_sync_duration", "total_sync_attempts")
    plain = unified.groupBy("table_fqn").agg(
        F.expr("percentile_cont(0.5) WITHIN GROUP (ORDER BY sync_duration_seconds)"), F.avg("sync_duration_seconds"), F.count("*")
    )
    for got, want in zip(rows(summary), rows(plain), strict=True):
        assert got[0] == want[0] and got[3] == want[3]
        assert abs(got[1] - want[1]) < 1e-9 and abs(got[2] - want[2]) < 1e-9


def test_rows_without_a_status_count_as_failed(spark):
    unified = metrics.unified_metrics(gateway(spark, ("r", "a.t", FLOW % (1, 1))), pipeline(spark))
    assert rows(metrics.metrics_summary(unified).select("total_sync_attempts", "successful_syncs", "failed_syncs")) == [(1, 0, 1)]


LOG = "run_id string, pipeline_id string, pipeline_config string, run_started_at timestamp, run_completed_at timestamp, run_duration_seconds double, run_status string, sync_date date, server string, database string, table_fqn string, table_name string, schema_name string, uc_catalog string, ingest_pipeline string, rows_written bigint, files_written int, table_duration_seconds double, table_status string, configured_mode string, actual_mode string, scd_type int, soft_delete boolean, ct_since_version bigint, ct_current_version bigint, schema_version bigint, schema_changed boolean, column_count int, error_message string, error_type string, skip_reason string"


def log_row(day, table, seconds):
    at = datetime.datetime(2024, 1, day, 23)
    values = {"run_id": f"run{day}", "run_started_at": at, "sync_date": at.date(), "table_fqn": f"db.dbo.{table}", "table_name": table, "schema_name": "dbo",
              "rows_written": day, "files_written": 1, "table_duration_seconds": seconds, "table_status": "success"}
    return tuple(values.get(field.split()[0]) for field in LOG.split(", "))


def test_a_summary_refreshed_by_day_equals_the_whole_one(spark, folder, monkeypatch):
    rng = random.Random(4)
    log_rows = [log_row(day, rng.choice(["t1", "t2"]), round(rng.random() * 9, 2)) for day in (3, 4, 6) for _ in range(25)]
    # Each run has events on its own day and after midnight.
    stamps = [(day, datetime.datetime(2024, 1, day, 23, 30) + datetime.timedelta(hours=h)) for day in (3, 4, 6) for h in (0, 1, 5)]
    events = [(str(i), at, f"run{day}", "p", "n", "{}", f"a.{t}", "flow_progress", "INFO", "STABLE", "m", FLOW % (day * 100, 7)) for i, ((day, at), t) in enumerate((s, t) for s in stamps for t in ("t1", "t2"))]
    gateway_log = spark.createDataFrame(events, GATEWAY)

    def landed():
        return spark.read.schema(LOG).parquet(f"{folder}/log")

    summary, seen = RefreshedSummary(spark, f"{folder}/summary"), []
    monkeypatch.setattr(refresh, "pipeline_parsed", lambda results: seen.append(results) or metrics.pipeline_parsed(results))
    goes = [log_rows[:40], log_rows[40:50], log_rows[50:]]  # days 3 and 4, the rest of day 4, day 6
    refreshed = []
    for rows_ in goes:
        spark.createDataFrame(rows_, LOG).write.mode("append").partitionBy("sync_date").parquet(f"{folder}/log")
        refreshed.append([d.day for d in summary.refresh(gateway_log, landed())])
    assert refreshed == [[3, 4], [4], [6]] and summary.refresh(gateway_log, landed()) == []
    # The last refresh has read the one partition of its day; the day before has none.
    assert {r[0].day for r in seen[-1].select("sync_date").distinct().collect()} == {6}
    plan = seen[-1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-06" in plan and "2024-01-04" not in plan
    whole = metrics.metrics_summary(metrics.unified_metrics(gateway_log, metrics.pipeline_parsed(landed())))
    assert rows(summary.read()) == rows(whole) and summary.read().count() == 6
