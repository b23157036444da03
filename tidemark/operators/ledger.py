"""Watermark ledger and the decisions a sync run takes from it.

All of these work on control tables with one row per table, or fold a feed to that before anything else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.identity import qualified_name
from tidemark.sources.feed import VERSION
from tidemark.spec import DEFAULT_MODE, MODES

ENTRY_SCHEMA = (
    "version bigint, since_version bigint, rows_synced bigint, mode string, files array<string>,"
    " duration_seconds double, synced_at string"
)


def ledger_entry(results: DataFrame, synced_at: Column) -> DataFrame:
    """Ledger rows from the results of a sync run; failed and skipped tables leave none."""
    done = results.where(F.coalesce(F.col("status"), F.lit("success")) == "success")
    named = [F.col("database")] if "database" in results.columns else []
    return done.select(
        *named,
        F.col("table_name"),
        F.col("current_version").alias("version"),
        F.col("since_version"),
        F.col("rows_written").alias("rows_synced"),
        F.col("mode"),
        F.coalesce(F.col("files"), F.array().cast("array<string>")).alias("files"),
        F.round("duration_seconds", 2).alias("duration_seconds"),
        synced_at.alias("synced_at"),
    )


def parse_entries(raw: DataFrame, entry: str = "entry") -> DataFrame:
    """Watermark entries kept as JSON text; an old entry is a bare version number."""
    bare = F.expr(f"try_cast({entry} as bigint)")
    parsed = F.from_json(entry, ENTRY_SCHEMA)
    rest = [f"_e.{name}" for name in ("since_version", "rows_synced", "mode", "files", "duration_seconds", "synced_at")]
    others = [c for c in raw.columns if c != entry]
    return raw.withColumn("_e", parsed).select(*others, F.coalesce(bare, F.col("_e.version")).alias("version"), *rest)


def latest_watermarks(ledger: DataFrame) -> DataFrame:
    """Newest ledger row of every table (of a database, where there is such a column); at one time the higher version."""
    by = [c for c in ("database", "table_name") if c in ledger.columns]
    rest = [c for c in ledger.columns if c not in (*by, "synced_at", "version")]
    newest = F.max(F.struct("synced_at", "version", *rest)).alias("w")
    return ledger.groupBy(*by).agg(newest).select(*by, "w.*")


def sync_history(ledger: DataFrame) -> DataFrame:
    """Ledger rows, oldest first."""
    return ledger.orderBy("synced_at", "table_name", "version")


def min_valid_versions(tables: DataFrame, bounds: DataFrame) -> DataFrame:
    """Lowest version each listed table can be read from; 0 where the source gives none."""
    known = bounds.select("table_name", "min_version")
    return tables.select("table_name").join(known, "table_name", "left").select(
        "table_name", F.coalesce("min_version", F.lit(0)).alias("min_version")
    )


def changed_tables(watermarks: DataFrame, feed: DataFrame) -> DataFrame:
    """Tables with a change after their watermark; the feed is folded to one row per table first."""
    newest = feed.groupBy("table_name").agg(F.max(VERSION).alias("_newest"))
    on = [F.col("w.table_name") == F.col("f.table_name"), F.col("f._newest") > F.col("w.version")]
    return watermarks.alias("w").join(newest.alias("f"), on, "left_semi").select("table_name")


def unchanged_tables(watermarks: DataFrame, bounds: DataFrame, feed: DataFrame) -> DataFrame:
    """Tables to skip: the watermark is still valid and nothing changed since."""
    valid = (
        watermarks.join(bounds.select("table_name", "min_version"), "table_name", "left")
        .where(F.col("version") >= F.coalesce("min_version", F.lit(0)))
        .select("table_name", "version")
    )
    return valid.join(changed_tables(valid, feed), "table_name", "left_anti").select(
        "table_name", F.lit("skipped").alias("status"), F.lit("no changes").alias("reason")
    )


def resolve_modes(
    tables: DataFrame, watermarks: DataFrame, bounds: DataFrame, keys: DataFrame | None = None, override: str | None = None
) -> DataFrame:
    """How each configured table is read in this run: ``full``, ``incremental``, or an error row.

    ``tables`` has ``table_name`` and ``mode``; ``keys`` (``table_name``, ``primary_key``) adds the check that an
    incremental read has a key.
    """
    if override is not None and override not in MODES:
        raise ValueError(f"mode {override!r} is not one of {list(MODES)}")
    wanted = tables.withColumn("_name", qualified_name(F.col("table_name"))).withColumn(
        "configured_mode", F.coalesce(F.lit(override), F.col("mode"), F.lit(DEFAULT_MODE))
    )

    def named(control: DataFrame, *columns: str) -> DataFrame:
        return control.select(qualified_name(F.col("table_name")).alias("_name"), *columns)

    joined = wanted.join(named(watermarks, F.col("version").alias("since_version")), "_name", "left").join(
        named(bounds, F.coalesce("min_version", F.lit(0)).alias("min_version")), "_name", "left"
    )
    since, minimum = F.col("since_version"), F.coalesce("min_version", F.lit(0))
    first = since.isNull()
    unknown_mode = ~F.col("configured_mode").isin(*MODES)
    no_start = first & (F.col("configured_mode") == "incremental")
    stale = ~first & (since < minimum)
    full = first | stale
    no_key = F.lit(False)
    if keys is not None:
        joined = joined.join(named(keys, "primary_key"), "_name", "left")
        no_key = ~full & (F.coalesce(F.size("primary_key"), F.lit(0)) <= 0)
    error = (
        F.when(unknown_mode, "invalid mode")
        .when(no_start, "no watermark for an incremental read")
        .when(no_key, "no primary key for an incremental read")
    )
    actual = F.when(error.isNull(), F.when(full, "full").otherwise("incremental"))
    return joined.select(
        "table_name",
        "configured_mode",
        actual.alias("actual_mode"),
        F.when(actual == "incremental", since).alias("since_version"),
        minimum.alias("min_version"),
        F.when(error.isNull(), "ok").otherwise("error").alias("status"),
        error.alias("error"),
    )
