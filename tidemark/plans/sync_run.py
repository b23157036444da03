"""One sync run over many tables as a single Spark job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.identity import qualified_name
from tidemark.operators.ledger import resolve_modes, unchanged_tables
from tidemark.sources.feed import OPERATION, VERSION, current_version


@dataclass(frozen=True)
class SyncRun:
    """Decision and result rows per table, and the change rows to land."""

    decisions: DataFrame
    changes: DataFrame
    results: DataFrame


def by_name(rows: DataFrame) -> DataFrame:
    """Rows with their table's name in the form in which names are compared."""
    return rows.withColumn("table_name", qualified_name(F.col("table_name")))


def plan_tables(
    tables: DataFrame, watermarks: DataFrame, bounds: DataFrame, feed: DataFrame, keys: DataFrame | None = None, override: str | None = None
) -> DataFrame:
    """Mode decision of every table, with unchanged ones skipped and failures kept as rows.

    Names are compared without regard to case in all inputs. A table without a row in ``bounds`` is not tracked by the
    source: an error, so that its watermark never moves past rows nobody has read.
    """
    modes = resolve_modes(tables, watermarks, bounds, keys, override)
    tracked = bounds.select(qualified_name(F.col("table_name")).alias("_name")).distinct().withColumn("_tracked", F.lit(True))
    modes = modes.withColumn("_name", qualified_name(F.col("table_name"))).join(tracked, "_name", "left")
    lost = F.col("_tracked").isNull() & (F.col("status") == "ok")
    modes = modes.withColumns({
        "error": F.when(lost, "not tracked by the source").otherwise(F.col("error")),
        "actual_mode": F.when(~lost, F.col("actual_mode")),
        "since_version": F.when(~lost, F.col("since_version")),
        "status": F.when(lost, "error").otherwise(F.col("status")),
    })
    skipped = unchanged_tables(by_name(watermarks), by_name(bounds), by_name(feed)).select(F.col("table_name").alias("_name"), F.lit(True).alias("_skip"), "reason")
    joined = modes.join(skipped, "_name", "left")
    skip = F.coalesce("_skip", F.lit(False)) & (F.col("status") == "ok")
    return joined.select(
        "table_name", "configured_mode",
        F.when(~skip, F.col("actual_mode")).alias("actual_mode"),
        F.when(~skip, F.col("since_version")).alias("since_version"),
        F.when(skip, "skipped").otherwise(F.col("status")).alias("status"),
        F.when(skip, F.col("reason")).alias("reason"),
        "error",
    )


def sync_tables(
    tables: DataFrame,
    watermarks: DataFrame,
    bounds: DataFrame,
    feed: DataFrame,
    snapshots: DataFrame,
    keys: DataFrame | None = None,
    override: str | None = None,
) -> SyncRun:
    """Reads all tables of a run at once.

    ``feed`` (table_name, change columns, key, data) holds the changes of all tables and ``snapshots``
    (table_name, key, data) their current rows, payload as JSON text. Tables read in full come from the
    snapshots, the others from the feed after their own watermark; one failing table is one error row. Result rows
    have the names as configured, change rows too, however the source spells them.
    """
    decisions = plan_tables(tables, watermarks, bounds, feed, keys, override)
    version = current_version(feed)
    name = qualified_name(F.col("table_name"))
    reading = decisions.where(F.col("status") == "ok").select(name.alias("_name"), "table_name", "actual_mode", "since_version")

    def read(rows: DataFrame, tables_: DataFrame) -> DataFrame:
        return rows.withColumn("_name", name).drop("table_name").join(tables_, "_name")

    whole = read(snapshots, reading.where(F.col("actual_mode") == "full")).select(
        "table_name",
        F.lit(version).cast("bigint").alias(VERSION),
        F.lit("L").alias(OPERATION),
        "key", "data", "actual_mode",
    )
    after = (F.col("actual_mode") == "incremental") & (F.col(VERSION) > F.col("since_version"))
    partial = read(feed, reading).where(after).select(
        "table_name", VERSION, OPERATION, "key", "data", "actual_mode"
    )
    changes = whole.unionByName(partial)
    counts = changes.groupBy("table_name").agg(F.count("*").alias("_rows"))
    ok = F.col("status") == "ok"
    results = decisions.join(counts, "table_name", "left").select(
        "table_name", "configured_mode", "actual_mode", "since_version",
        F.when(ok, F.lit(version)).cast("bigint").alias("current_version"),
        F.when(ok, F.coalesce("_rows", F.lit(0))).alias("rows_written"),
        F.when(ok, "success").otherwise(F.col("status")).alias("status"),
        "reason", "error",
    )
    return SyncRun(decisions, changes, results)
