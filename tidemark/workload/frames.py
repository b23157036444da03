"""Change feeds, logs and control tables derived from the given tables.

Everything here reads a whole table and grows with it. ``oracle.py`` states the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.operations import OPERATION_NAMES
from tidemark.plans.runlog import log_rows
from tidemark.sources.feed import CREATION_VERSION, OPERATION, VERSION

USERS_PAYLOAD = (
    T.StructType().add("user_id", "long").add("event_type", "string").add("value", "double").add("k", "integer")
)
WATERMARK_CUT = "2024-01-15"
FEED_SINCE = 365  # the version of the first of January 1996


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``k`` of their properties as a column, parsed once."""
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int")).drop("props")


# ---- change log of a "users" table, from events ----------------------------------------------------


def event_operation() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "signup", "I").when(kind == "error", "D").otherwise("U")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a change of its user: signups insert, errors delete, the others update."""
    kind = F.col("event_type")
    return parsed_events(spark, sf_dir).select(
        (F.col("event_id") + 1).alias(VERSION),
        F.when(kind == "signup", F.col("event_id") + 1).alias(CREATION_VERSION),
        event_operation().alias(OPERATION),
        "user_id",
        "event_type",
        F.when(~kind.isin("view", "error"), F.col("value")).alias("value"),
        F.when(~kind.isin("click", "error"), F.col("k")).alias("k"),
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log as typed events, as they come out of an envelope."""
    names = F.create_map(*[F.lit(x) for pair in OPERATION_NAMES.items() for x in pair])
    return change_log(spark, sf_dir).select(
        F.col(VERSION).alias("_seq_num"), names[F.col(OPERATION)].alias("operation"), "user_id", "event_type", "value", "k"
    )


def keyed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event type as a table of its own; the user is the key."""
    return change_log(spark, sf_dir).select(
        F.concat(F.lit("dbo."), F.col("event_type")).alias("table_name"),
        VERSION, CREATION_VERSION, OPERATION,
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct("value", "k")).alias("data"),
    )


# ---- an "orders" table with a change feed ----------------------------------------------------------


def day_number(column: str, first: str = "1995-01-01") -> Column:
    return F.datediff(F.col(column), F.lit(first).cast("date")).cast("bigint")


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One net change per order: finished ones are deleted, pending ones new, open ones updated."""
    status = F.col("o_orderstatus")
    version = day_number("o_orderdate") + 1
    return table(spark, sf_dir, "orders").select(
        version.alias(VERSION),
        F.when(status == "P", version).alias(CREATION_VERSION),
        F.when(status == "F", "D").when(status == "P", "I").otherwise("U").alias(OPERATION),
        "o_orderkey",
    )


def current_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders still in the source: all but the finished ones."""
    return table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "F")


# ---- watermarks and runs ---------------------------------------------------------------------------


def day() -> Column:
    return F.date_format("ts", "yyyy-MM-dd")


def event_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last version of each event type before a date; purchases were never synced, views not since the start."""
    kind = F.col("event_type")
    seen = table(spark, sf_dir, "events").where((F.col("ts") < F.lit(WATERMARK_CUT).cast("timestamp_ntz")) & (kind != "purchase"))
    version = F.when(kind == "view", F.min("event_id")).otherwise(F.max("event_id") + 1)
    return seen.groupBy("event_type").agg(version.alias("version")).select(
        F.concat(F.lit("dbo."), kind).alias("table_name"), "version"
    )


def event_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest version still available per event type."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg((F.min("event_id") + 1).alias("min_version")).select(
        F.concat(F.lit("dbo."), F.col("event_type")).alias("table_name"), "min_version"
    )


def configured_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured names in mixed spelling, one per event type and one that no source has."""
    kind = F.col("event_type")
    name = F.when(kind == "click", "Click").when(kind == "view", " dbo.VIEW ").otherwise(F.concat(F.lit("dbo."), kind))
    mode = F.when(kind.isin("purchase", "click"), "incremental").when(kind != "signup", "full_incremental")
    events = table(spark, sf_dir, "events")
    missing = events.select(F.concat(F.lit("old_"), kind).alias("table_name"), F.lit("incremental").alias("mode"))
    return events.select(name.alias("table_name"), mode.alias("mode")).unionByName(missing).distinct()


def event_database() -> Column:
    """Clicks are kept in a database of their own."""
    return F.when(F.col("event_type") == "click", "asia").otherwise("app")


def sync_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per day over all event types but errors, which are the tables of the run."""
    kind, rows = F.col("event_type"), F.col("n")
    grouped = parsed_events(spark, sf_dir).where(kind != "error").groupBy(day().alias("run_id"), "event_type").agg(
        F.count("*").alias("n"),
        F.sum(F.col("value").cast("decimal(18,2)")).alias("total"),
        F.max("event_id").alias("last_id"),
        F.max("k").alias("max_k"),
    )
    failed, skipped = rows % 7 == 0, rows % 7 == 1
    error = F.when(failed, "connection lost")
    ok = ~failed & ~skipped
    part = F.concat_ws("/", F.lit("landing"), "event_type", "run_id")
    return grouped.select(
        "run_id",
        event_database().alias("database"),
        F.when(kind == "view", "view").otherwise(F.concat(F.lit("web."), kind)).alias("table"),
        F.when(failed, "error").when(skipped, "skipped").alias("status"),
        F.when(~skipped, F.when(kind == "signup", "full").otherwise("incremental")).alias("mode"),
        F.when(ok, F.when(kind == "click", 2).otherwise(1)).alias("scd_type"),
        F.when(ok, kind == "purchase").alias("soft_delete"),
        F.when(ok & (kind != "signup"), F.col("last_id") + 1 - rows).alias("since_version"),
        F.when(ok, F.col("last_id") + 1).alias("current_version"),
        F.when(ok, rows).alias("rows_written"),
        F.when(ok, F.when(rows % 2 == 0, F.array(part)).otherwise(F.array(part, F.concat(part, F.lit("_2"))))).alias("files"),
        F.when(ok, F.round(F.col("total") / 100, 2).cast("double")).alias("duration_seconds"),
        F.when(ok, F.array(F.lit("user_id"))).alias("primary_key"),
        F.when(ok, F.array(F.lit("user_id"), F.lit("value"), F.lit("k"))).alias("columns"),
        F.when(ok, F.col("max_k").cast("bigint")).alias("schema_version"),
        F.when(ok, F.col("max_k") < 98).alias("schema_changed"),
        F.when(skipped, "no changes").alias("reason"),
        error.alias("error"),
        F.when(failed, "ConnectionError").alias("error_type"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each run started and ended."""
    bounds = table(spark, sf_dir, "events").groupBy(day().alias("run_id")).agg(
        F.date_trunc("second", F.min("ts").cast("timestamp")).alias("run_started_at"),
        F.date_trunc("second", F.max("ts").cast("timestamp")).alias("run_completed_at"),
    )
    return bounds.select(
        "run_id", F.lit("web_changes").alias("pipeline_id"), "run_started_at", "run_completed_at",
        F.lit("db.example").alias("server"), F.lit("web.yaml").alias("pipeline_config"),
        F.lit("/ingest/web").alias("ingest_pipeline"),
    )


def configured_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        event_database().alias("database"),
        F.when(kind == "view", "DBO.View").otherwise(F.concat(F.lit("web."), kind)).alias("table"),
        F.when(kind == "click", "incremental").alias("mode"),
    ).distinct()


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target catalog of each database: one per region, named after it."""
    return table(spark, sf_dir, "region").select(
        F.when(F.col("r_regionkey") == 0, "app").otherwise(F.lower("r_name")).alias("database"),
        F.concat(F.lit("lake_"), F.lower("r_name")).alias("uc_catalog"),
    )


def sync_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_rows(
        sync_results(spark, sf_dir), runs(spark, sf_dir), configured_modes(spark, sf_dir), targets(spark, sf_dir)
    )


def gateway_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events other than signups as gateway events; errors are background operations, the rest flow progress."""
    kind, k = F.col("event_type"), F.col("k")
    flow = F.concat(
        F.lit('{"flow_progress":{"status":"'), F.when(k % 10 == 0, "FAILED").otherwise("COMPLETED"),
        F.lit('","metrics":{"executor_time_ms":'), k * 100, F.lit(',"executor_cpu_time_ms":'), k * 10,
        F.lit('}},"stream_progress":{"progress_json":"{\\"rows\\":'), k, F.lit('}"}}'),
    )
    work = F.concat(
        F.lit('{"background_operation":{"op_type":"'), F.when(k < 50, "VACUUM").otherwise("OPTIMIZE"),
        F.lit('","status":"DONE","duration_ms":'), k * 7, F.lit(',"num_rows_deleted":'), k * 3,
        F.lit(',"num_bytes_deleted":'), k * 1024, F.lit(',"num_files_deleted":'), k, F.lit("}}"),
    )
    user = F.col("user_id")
    return parsed_events(spark, sf_dir).where(kind != "signup").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.date_format("ts", "yyyy-MM-dd").alias("update_id"),
        F.lit("web_changes").alias("pipeline_id"),
        F.lit("web").alias("pipeline_name"),
        F.concat(
            F.lit('{"cloud":"cloud-a","region":"r'), k % 5, F.lit('","org_id":"org","cluster_id":"c'), user, F.lit('"}')
        ).alias("origin"),
        F.when(k != 99, F.concat(F.lit("lake.app_web."), F.when(kind == "error", "click").otherwise(kind))).alias("flow_name"),
        F.when(kind == "error", "background_operation").otherwise("flow_progress").alias("event_type"),
        F.when(kind == "error", "WARN").otherwise("INFO").alias("level"),
        F.lit("STABLE").alias("maturity_level"),
        F.concat(F.lit("user "), user).alias("message"),
        F.when(kind == "error", work).otherwise(flow).alias("details"),
    )


# ---- ledger ----------------------------------------------------------------------------------------


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One watermark entry per day and event type as JSON text; those of views are bare numbers."""
    kind = F.col("event_type")
    grouped = table(spark, sf_dir, "events").groupBy(day().alias("d"), "event_type").agg(
        F.max("event_id").alias("last_id"), F.count("*").alias("n")
    )
    entry = F.to_json(
        F.struct(
            (F.col("last_id") + 1).alias("version"),
            (F.col("last_id") + 1 - F.col("n")).alias("since_version"),
            F.col("n").alias("rows_synced"),
            F.lit("incremental").alias("mode"),
            F.array(F.col("d")).alias("files"),
            (F.col("n") / F.lit(4.0)).alias("duration_seconds"),
            F.concat("d", F.lit("T23:59:59Z")).alias("synced_at"),
        )
    )
    bare = (F.col("last_id") + 1).cast("string")
    return grouped.select(
        F.concat(F.lit("dbo."), kind).alias("table_name"), "d", F.when(kind == "view", bare).otherwise(entry).alias("entry")
    )


# ---- source catalog: every customer is a table -----------------------------------------------------


def information_schema(spark: SparkSession, sf_dir: str, later: bool = False) -> DataFrame:
    """Columns of one source table per customer.

    All have an id, a change column and an amount whose size follows the nation; depending on the market
    segment there is a note, and ``later`` the amount was retyped, the note dropped or a flag added.
    """
    segment = F.col("c_mktsegment")
    size = (F.col("c_nationkey") + 5).cast("int")
    none = F.lit(None).cast("int")

    def column(ordinal: int, name: str, kind: Column | str, precision: Column = none, scale: Column = none, when: Column | None = None):
        described = F.struct(
            F.lit(ordinal).alias("ordinal_position"), F.lit(name).alias("column_name"),
            (F.lit(kind) if isinstance(kind, str) else kind).alias("data_type"),
            precision.alias("numeric_precision"), scale.alias("numeric_scale"),
        )
        return described if when is None else F.when(when, described)

    noted = segment.isin("BUILDING", "MACHINERY")
    if not later:
        columns = [
            column(1, "id", "int", F.lit(10), F.lit(0)),
            column(2, "SYS_CHANGE_VERSION", "bigint"),
            column(3, "amount", "decimal", size, F.lit(2)),
            column(4, "note", "nvarchar", none, F.lit(9), noted),
        ]
    else:
        columns = [
            column(1, "id", F.when(segment == "FURNITURE", "bigint").otherwise("int"), F.when(segment == "FURNITURE", 19).otherwise(10), F.lit(0)),
            column(2, "amount", F.when(segment == "BUILDING", "money").otherwise("decimal"), F.when(segment == "HOUSEHOLD", size + 1).otherwise(size), F.lit(2)),
            column(3, "note", "nvarchar", none, F.lit(9), segment == "MACHINERY"),
            column(4, "flag", "bit", none, none, segment == "AUTOMOBILE"),
        ]
    described = F.explode(F.filter(F.array(*columns), lambda c: c.isNotNull()))
    return table(spark, sf_dir, "customer").select(
        F.lit("crm").alias("table_schema"), F.col("c_name").alias("table_name"), described.alias("c")
    ).select("table_schema", "table_name", "c.*")


# ---- manifest: every supplier is a table -----------------------------------------------------------


def supplier_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sync result per supplier; its balance decides how the sync went."""
    balance, nation = F.col("s_acctbal"), F.col("s_nationkey")
    cents = F.round(balance * 100).cast("bigint")
    failed = balance < 0
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("db"), nation % 5).alias("database"),
        F.when(cents % 11 == 0, F.col("s_name")).otherwise(F.concat(F.lit("sales."), F.col("s_name"))).alias("table"),
        F.when(failed, "error").when(cents % 13 == 0, "skipped").alias("status"),
        F.when(cents % 3 != 0, F.when(cents % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("f1")))).alias("files"),
        F.when(cents % 4 != 0, cents % 7).alias("rows_written"),
        (1 + nation % 2).cast("int").alias("scd_type"),
        (nation % 3 == 0).alias("soft_delete"),
        F.array(F.lit("id")).alias("primary_key"),
    )


def manifest_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target names per database; one database has no catalog."""
    key = F.col("r_regionkey")
    return table(spark, sf_dir, "region").select(
        F.concat(F.lit("db"), key).alias("database"),
        F.lit("sales").alias("schema_name"),
        F.when(key != 3, F.lower("r_name")).alias("catalog_target"),
        F.lit("sales_lake").alias("schema_target"),
    )


def known_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of the first nations are already listed, with a path a user has set."""
    nation = F.col("s_nationkey")
    return table(spark, sf_dir, "supplier").where(nation < 12).select(
        F.concat(F.lit("db"), nation % 5).alias("database"),
        F.lit("sales").alias("schema_name"),
        F.col("s_name").alias("table_name"),
        F.when(nation != 4, F.lit("custom")).alias("catalog_target"),
        F.lit("sales_lake").alias("schema_target"),
        F.concat(F.lit("t_"), F.col("s_suppkey")).alias("table_target"),
        F.concat(F.lit("/user/"), F.col("s_name")).alias("file_path"),
        F.lit("parquet").alias("file_type"),
        F.lit(None).cast("int").alias("scd_type"),
        F.lit(None).cast("boolean").alias("soft_delete"),
        F.lit(None).cast("array<string>").alias("primary_key"),
    )


def nested_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as nested manifest documents: one small document per supplier."""
    nation = F.col("s_nationkey")
    entry = F.struct(
        F.concat(F.lit("t_"), F.col("s_suppkey")).alias("uc_table_name"),
        F.concat(F.lit("/data/"), F.col("s_name")).alias("file_path"),
        F.lit("parquet").alias("file_type"),
        (1 + nation % 2).cast("int").alias("scd_type"),
        (nation % 3 == 0).alias("soft_delete"),
        F.array(F.lit("id"), F.lit("line")).alias("primary_key"),
    )
    document = F.concat(
        F.lit('{"databases":{"db'), nation % 5, F.lit('":{"uc_catalog_name":"lake'), nation,
        F.lit('","sales":{"uc_schema_name":"sales_lake","'), F.col("s_name"), F.lit('":'), F.to_json(entry), F.lit("}}}}"),
    )
    return table(spark, sf_dir, "supplier").select(document.alias("manifest"))
