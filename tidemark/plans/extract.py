"""Extraction of typed tables with different schemas as one Spark job.

Every table becomes envelopes of one schema, so all of them are united into one keyed, rebalanced write. What each
table contributed, and when its first and last rows went through, is observed inside that write; no source is read a
second time for the books. A write that fails is tried again in halves, until a table that cannot be read stands alone
and is an error of its own.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.identity import uoid_of
from tidemark.functions.operations import RELOAD
from tidemark.operators.envelope import reload_barrier, to_envelope
from tidemark.plans.sync_run import plan_tables
from tidemark.sources.catalog import describe_columns
from tidemark.sources.feed import VERSION, full_load, incremental_changes
from tidemark.spec import DEFAULT_MODE

logger = logging.getLogger(__name__)

OUTCOME = "table_name string, rows_written bigint, duration_seconds double, error string, error_type string"
# Milliseconds at the moment a row passes; functions like current_timestamp stand still during a query.
CLOCK = "java_method('java.lang.System', 'currentTimeMillis')"


@dataclass(frozen=True)
class SourceTable:
    """One table of a source: its current rows, and the changes of its keys (at most one row per key).

    Both are given as functions, so that a table that cannot be opened is an error of this table only.
    """

    name: str
    rows: Callable[[], DataFrame]
    keys: tuple[str, ...] = ()
    changes: Callable[[], DataFrame] | None = None
    mode: str | None = DEFAULT_MODE
    scd_type: int = 1
    soft_delete: bool = False

    @property
    def parts(self) -> tuple[str, str]:
        """Schema and name."""
        schema, dot, name = self.name.partition(".")
        return (schema, name) if dot else ("dbo", self.name)

    def read(self, how: str, since: int | None, version: int) -> DataFrame:
        """Change rows of a full or incremental read; the feed is scanned once."""
        if how == "full":
            return full_load(self.rows(), version)
        if self.changes is None:
            raise ValueError(f"{self.name} has no change feed")
        return incremental_changes(self.changes(), self.rows(), self.keys, since, count_first=False)


@dataclass(frozen=True)
class Outcome:
    """What became of one table of a write."""

    rows: int | None = None
    seconds: float | None = None
    error: Exception | None = None

    def row(self, name: str) -> tuple:
        return name, self.rows, self.seconds, None if self.error is None else message(self.error), None if self.error is None else type(self.error).__name__


def message(error: Exception) -> str:
    """The first line of an error, which says what is wrong; what follows is a trace."""
    return (str(error).strip() or type(error).__name__).splitlines()[0][:1000]


def watched(rows: DataFrame, counts: Column) -> tuple[Observation, DataFrame]:
    """The rows, timed while they pass; those that meet a condition are counted."""
    seen = Observation()
    timed = rows.withColumn("__at", F.expr(CLOCK).cast("bigint"))
    timed = timed.observe(seen, F.count_if(counts).alias("rows"), F.min("__at").alias("first"), F.max("__at").alias("last"))
    return seen, timed.drop("__at")


def write_together(parts: Mapping[str, DataFrame], write: Callable[[DataFrame], None], counts: Column | None = None) -> dict[str, Outcome]:
    """Writes frames of one schema by one job, and tells what became of each.

    Rows that meet ``counts`` are counted (all, unless given). ``write`` has to be all or nothing. If it fails for several frames, each half of them is tried by itself.
    """
    if not parts:
        return {}
    seen, together = {}, None
    for name, rows in parts.items():
        seen[name], part = watched(rows, F.lit(True) if counts is None else counts)
        together = part if together is None else together.unionByName(part)
    try:
        write(together)
    except Exception as error:  # noqa: BLE001  which table it comes from shows when they are written apart
        names = list(parts)
        if len(names) == 1:
            logger.warning("%s cannot be read: %s", names[0], message(error))
            return {names[0]: Outcome(error=error)}
        half = len(names) // 2
        found: dict[str, Outcome] = {}
        for some in (names[:half], names[half:]):
            found |= write_together({name: parts[name] for name in some}, write, counts)
        return found
    counts = {name: observation.get for name, observation in seen.items()}
    return {name: Outcome(c["rows"], round(((c["last"] or 0) - (c["first"] or 0)) / 1000, 3)) for name, c in counts.items()}


@dataclass(frozen=True)
class Extraction:
    """Decisions for all tables, and what became of those that were read."""

    decisions: DataFrame
    results: DataFrame


def control_tables(spark: SparkSession, tables: Iterable[SourceTable]) -> tuple[DataFrame, DataFrame]:
    """Settings and keys of tables as the run's control tables."""
    settings = [(t.name, t.mode, t.scd_type, t.soft_delete) for t in tables]
    keys = [(t.name, list(t.keys)) for t in tables if t.keys]
    return (
        spark.createDataFrame(settings, "table_name string, mode string, scd_type int, soft_delete boolean"),
        spark.createDataFrame(keys, "table_name string, primary_key array<string>"),
    )


def column_rows(spark: SparkSession, tables: Iterable[SourceTable]) -> DataFrame:
    """Columns of every table that can be opened, as the schema history takes them."""
    listed = []
    for table in tables:
        try:
            columns = describe_columns(table.rows().schema)
        except Exception as error:  # noqa: BLE001  it gets its error row when it is read
            logger.warning("%s cannot be opened: %s", table.name, message(error))
            continue
        listed += [(table.name, c["ordinal"], c["name"], c["type"], c.get("precision"), c.get("scale")) for c in columns]
    return spark.createDataFrame(listed, "table_name string, ordinal int, name string, type string, precision int, scale int")


def extract_tables(
    spark: SparkSession,
    database: str,
    tables: Iterable[SourceTable],
    watermarks: DataFrame,
    bounds: DataFrame,
    write: Callable[[DataFrame, str], None],
    extracted_at_ms: int,
    catalog: str | None = None,
    override: str | None = None,
    count_rows: Callable[[], DataFrame] | None = None,
) -> Extraction:
    """Decides for every table how it is read and lands the envelopes of all of them with one job for each mode.

    ``watermarks`` (table_name, version) and ``bounds`` (table_name, min_version, max_version) are control tables, so
    no feed is read to decide. ``write`` takes envelopes and ``full`` or ``incremental``. ``count_rows`` gives the rows
    that were landed (table id, rows); where they differ from those observed, as after a lost executor whose tasks
    passed twice, the landed ones count.
    """
    by_name = {table.name: table for table in tables}
    settings, keys = control_tables(spark, by_name.values())
    newest = bounds.select("table_name", F.col("max_version").alias(VERSION))
    decisions = plan_tables(settings.select("table_name", "mode"), watermarks, bounds, newest, keys, override)
    decided = {row.table_name: row for row in decisions.collect()}
    version = bounds.agg(F.coalesce(F.max("max_version"), F.lit(0))).first()[0]
    outcomes: dict[str, Outcome] = {}
    reads: dict[str, dict[str, DataFrame]] = {"full": {}, "incremental": {}}
    for name, table in by_name.items():
        row = decided[name]
        if row.status != "ok":
            continue
        try:
            changes = table.read(row.actual_mode, row.since_version, version)
            envelopes = to_envelope(changes, database, *table.parts, catalog, extracted_at_ms)
            if row.actual_mode == "full":
                envelopes = envelopes.unionByName(reload_barrier(spark, database, *table.parts, version, extracted_at_ms, catalog))
            reads[row.actual_mode][name] = envelopes
        except Exception as error:  # noqa: BLE001  the others are still read
            logger.warning("%s cannot be read: %s", name, message(error))
            outcomes[name] = Outcome(error=error)
    for mode, parts in reads.items():
        outcomes |= write_together(parts, lambda rows, mode=mode: write(rows, mode), ~F.col("operation").eqNullSafe(RELOAD))
    if count_rows is not None:
        outcomes = recounted(outcomes, count_rows(), database, by_name)
    found = spark.createDataFrame([outcome.row(name) for name, outcome in outcomes.items()], OUTCOME)
    return Extraction(decisions, with_outcomes(decisions, found, version))


def recounted(outcomes: dict[str, Outcome], landed: DataFrame, database: str, tables: Mapping[str, SourceTable]) -> dict[str, Outcome]:
    """The outcomes with rows as landed."""
    rows = {r[0]: r[1] for r in landed.collect()}
    done = {name: rows.get(uoid_of(database, *tables[name].parts), 0) for name, outcome in outcomes.items() if outcome.error is None}
    return outcomes | {name: Outcome(n, outcomes[name].seconds) for name, n in done.items()}


def with_outcomes(decisions: DataFrame, outcomes: DataFrame, version: int) -> DataFrame:
    """Result rows: what was decided, and what became of it."""
    found = outcomes.select("table_name", F.struct("rows_written", "duration_seconds", "error", "error_type").alias("found"))
    failed = F.col("found.error").isNotNull()
    ok = (F.col("status") == "ok") & ~F.coalesce(failed, F.lit(False))
    return decisions.join(found, "table_name", "left").select(
        "table_name", "configured_mode", "actual_mode", "since_version",
        F.when(ok, F.lit(version)).cast("bigint").alias("current_version"),
        F.when(ok, F.col("found.rows_written")).alias("rows_written"),
        F.when(ok, "success").when(failed, "error").otherwise(F.col("status")).alias("status"),
        "reason",
        F.coalesce("found.error", "error").alias("error"),
        F.when(failed, F.col("found.error_type")).when(F.col("status") == "error", F.lit("SyncError")).alias("error_type"),
        F.when(ok, F.col("found.duration_seconds")).alias("duration_seconds"),
    )
