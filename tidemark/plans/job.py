"""A sync run from feed to landing with its control tables, and the apply run that follows it."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.identity import schema_part, table_part, table_uoid
from tidemark.functions.operations import RELOAD, decode_operation
from tidemark.functions.types import parse_schema
from tidemark.operators import ledger, manifest, schema_history
from tidemark.operators.apply import rules
from tidemark.operators.envelope import ENVELOPE_SCHEMA
from tidemark.operators.sinks import write_landing, write_sync_log
from tidemark.plans.extract import SourceTable, column_rows, control_tables, extract_tables
from tidemark.plans.runlog import log_rows
from tidemark.plans.sync_run import SyncRun, sync_tables
from tidemark.session import read_parquet
from tidemark.sources.catalog import schema_fingerprint
from tidemark.sources.feed import OPERATION, VERSION
from tidemark.streaming.bronze import start_bronze
from tidemark.streaming.generations import Generations, checkpoint_suffix
from tidemark.streaming.silver import BUCKETS, SilverTable, apply_all

logger = logging.getLogger(__name__)

LEDGER = (
    "database string, table_name string, version bigint, since_version bigint, rows_synced bigint, mode string, files array<string>,"
    " duration_seconds double, synced_at string"
)


class ControlTable:
    """A control table as one small snapshot per run; the newest one counts."""

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.path, self.schema = spark, path, schema

    def read(self) -> DataFrame:
        stored = read_parquet(self.spark, f"{self.schema}, run bigint", self.path)
        if stored is None:
            return self.spark.createDataFrame([], self.schema)
        return stored.where(F.col("run") == F.lit(stored.agg(F.max("run")).first()[0])).drop("run")

    def write(self, rows: DataFrame, run: int) -> None:
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/run={run}")

    def append(self, rows: DataFrame) -> None:
        rows.hint("rebalance").write.mode("append").parquet(self.path)


@dataclass(frozen=True)
class SourceDatabase:
    """What a run reads: one feed and one set of current rows for all tables, and the source catalog.

    ``tables`` (table_name, mode, scd_type, soft_delete), ``feed`` (table_name, change columns, key, data),
    ``snapshots`` (table_name, key, data), ``bounds`` (table_name, min_version), ``keys`` (table_name,
    primary_key), ``columns`` (table_name, ordinal, name, type, precision, scale).
    """

    name: str
    tables: DataFrame
    feed: DataFrame | None
    snapshots: DataFrame | None
    bounds: DataFrame
    keys: DataFrame
    columns: DataFrame
    server: str = ""
    catalog: str | None = None
    target_schema: str | None = None


@dataclass(frozen=True)
class TypedDatabase:
    """A source whose tables have columns of their own; ``bounds`` has table_name, min_version and max_version."""

    name: str
    tables: tuple[SourceTable, ...]
    bounds: DataFrame
    server: str = ""
    catalog: str | None = None
    target_schema: str | None = None


class SyncJob:
    """Lands the changes of a source database below one folder and keeps the books of it."""

    def __init__(self, spark: SparkSession, root: str, pipeline_id: str = "pipeline") -> None:
        self.spark, self.root, self.pipeline_id = spark, root.rstrip("/"), pipeline_id
        self.landing = f"{self.root}/data"
        self.ledger = ControlTable(spark, f"{self.root}/ledger", LEDGER)
        self.history = ControlTable(spark, f"{self.root}/schema_history", f"database string, {schema_history.HISTORY_FIELDS}")
        self.manifest = ControlTable(spark, f"{self.root}/manifest", manifest.FIELDS)
        self.incremental = ControlTable(spark, f"{self.root}/incremental_manifest", manifest.FIELDS)
        self.log_path = f"{self.root}/sync_log"

    def watermarks(self, database: str | None = None) -> DataFrame:
        """Newest entry of every table, of all databases or of one."""
        entries = read_parquet(self.spark, LEDGER, self.ledger.path)
        if entries is None:
            return self.spark.createDataFrame([], LEDGER)
        return ledger.latest_watermarks(entries if database is None else entries.where(F.col("database") == database))

    def known_columns(self, database: str) -> DataFrame:
        """Schema history of one database."""
        return self.history.read().where(F.col("database") == database).drop("database")

    def run(self, source: SourceDatabase, override: str | None = None) -> DataFrame:
        """One run: data first, then the watermarks, then what describes them.

        Data or watermarks that cannot be written fail the run, which then can be repeated. Schema history,
        manifests and log are tried once the rows are safe and only logged when they fail.
        """
        started = datetime.now(timezone.utc)
        extracted = int(started.timestamp() * 1000)
        plan = sync_tables(
            source.tables.select("table_name", "mode"), self.watermarks(source.name).select("table_name", "version"), source.bounds,
            source.feed, source.snapshots, source.keys, override,
        )
        versions = schema_fingerprint(source.columns)
        self._land(plan, source, versions, extracted, started)
        elapsed = F.lit((datetime.now(timezone.utc) - started).total_seconds())
        return self._book(plan.results.withColumn("duration_seconds", elapsed), source, versions, started, extracted)

    def run_tables(self, source: TypedDatabase, override: str | None = None) -> DataFrame:
        """One run over typed tables, by one job for those read in full and one for the others.

        A table that cannot be read is an error row and leaves no watermark; the others are landed. Rows and durations
        are those of each table.
        """
        started = datetime.now(timezone.utc)
        extracted = int(started.timestamp() * 1000)
        settings, keys = control_tables(self.spark, source.tables)
        described = SourceDatabase(
            source.name, settings, None, None, source.bounds, keys, column_rows(self.spark, source.tables), source.server, source.catalog, source.target_schema
        )
        day = started.date().isoformat()

        def landed() -> DataFrame:
            rows = read_parquet(self.spark, T.StructType([*ENVELOPE_SCHEMA.fields]).add("_uoid", "string"), self.landing)
            rows = self.spark.createDataFrame([], "_uoid string, n bigint") if rows is None else rows.where((F.col("extractionTimestamp") == extracted) & (F.col("operation") != RELOAD))
            return rows.groupBy("_uoid").agg(F.count("*").alias("n"))

        done = extract_tables(
            self.spark, source.name, source.tables, self.watermarks(source.name).select("table_name", "version"), source.bounds,
            lambda rows, mode: write_landing(rows, self.landing, day, reload=mode == "full"), extracted, source.catalog, override, landed,
        )
        return self._book(done.results, described, schema_fingerprint(described.columns), started, extracted)

    def _book(self, outcome: DataFrame, source: SourceDatabase, versions: DataFrame, started: datetime, extracted: int) -> DataFrame:
        """Watermarks of what was landed, then what describes it."""
        results = self._kept(self._results(outcome, source, versions), extracted)
        self.ledger.append(ledger.ledger_entry(results, F.lit(started.strftime("%Y-%m-%dT%H:%M:%SZ"))))
        for step in (self._update_history, self._update_manifests, self._write_log):
            try:
                step(results, source, versions, started, extracted)
            except Exception as error:  # noqa: BLE001
                logger.warning("%s failed, the rows are written: %s", step.__name__.strip("_"), error)
        return results

    def _land(self, plan: SyncRun, source: SourceDatabase, versions: DataFrame, extracted: int, started: datetime) -> None:
        # A table that is read in full sends a barrier ahead, so that what was there before goes, also if it is empty now.
        whole = plan.results.where("status = 'success' AND actual_mode = 'full'")
        nothing = F.lit(None).cast("string")
        barriers = whole.select("table_name", F.col("current_version").alias(VERSION), F.lit(RELOAD).alias(OPERATION), nothing.alias("key"), nothing.alias("data"), "actual_mode")
        envelopes = keyed_envelopes(plan.changes.unionByName(barriers), source.name, source.catalog, extracted, versions)
        for mode in ("full", "incremental"):
            own = envelopes.where(F.col("actual_mode") == mode).drop("actual_mode")
            write_landing(own, self.landing, started.date().isoformat(), reload=mode == "full")

    def _results(self, outcome: DataFrame, source: SourceDatabase, versions: DataFrame) -> DataFrame:
        """Result rows as the log and the manifest take them."""
        database = F.lit(source.name)
        landed = F.concat_ws("/", F.lit(self.landing), F.concat(F.lit("_uoid="), table_uoid(database, schema_part(F.col("table_name")), table_part(F.col("table_name")))))
        changed = schema_history.schema_status(self.known_columns(source.name), source.columns, versions).select("table_name", "schema_changed")
        settings = source.tables.select("table_name", "scd_type", "soft_delete")
        columns = source.columns.groupBy("table_name").agg(F.collect_list("name").alias("columns"))
        ok = F.col("status") == "success"
        joined = outcome
        for control in (settings, source.keys, versions, changed, columns):
            joined = joined.join(control, "table_name", "left")
        return joined.select(
            "table_name", database.alias("database"), F.col("table_name").alias("table"),
            F.when(~ok, F.col("status")).alias("status"),
            F.col("actual_mode").alias("mode"), "scd_type", "soft_delete", "since_version", "current_version", "rows_written",
            F.when(ok, F.when(F.col("rows_written") > 0, F.array(landed)).otherwise(F.array().cast("array<string>"))).alias("files"),
            F.when(ok, F.col("duration_seconds")).alias("duration_seconds"), "primary_key", "columns", "schema_version",
            F.coalesce("schema_changed", F.lit(False)).alias("schema_changed"),
            "reason", "error", (F.col("error_type") if "error_type" in outcome.columns else F.when(F.col("status") == "error", "SyncError")).alias("error_type"),
        )

    def _kept(self, results: DataFrame, run: int) -> DataFrame:
        """The results as a table of their own, so that later steps do not read the feed again."""
        path = f"{self.root}/results/run={run}"
        results.hint("rebalance").write.mode("overwrite").parquet(path)
        return self.spark.read.schema(results.schema).parquet(path)

    def _update_history(self, results, source, versions, started, extracted) -> None:
        synced = results.where(F.col("status").isNull()).select("table_name")
        columns = source.columns.join(synced, "table_name", "left_semi")
        merged = schema_history.merge_schema(
            self.known_columns(source.name), columns, versions.join(synced, "table_name", "left_semi"), F.lit(started).cast("timestamp")
        )
        others = self.history.read().where(F.col("database") != source.name)
        self.history.write(merged.withColumn("database", F.lit(source.name)).unionByName(others), extracted)

    def _update_manifests(self, results, source, versions, started, extracted) -> None:
        targets = None
        if source.catalog:
            schemas = results.select(F.col("database"), schema_part(F.col("table")).alias("schema_name")).distinct()
            targets = schemas.select(
                "*", F.lit(source.catalog).alias("catalog_target"),
                F.coalesce(F.lit(source.target_schema), F.col("schema_name")).alias("schema_target"),
            )
        added = manifest.entries(results, self.landing, "parquet", targets)
        self.manifest.write(manifest.merge_add(self.manifest.read(), added), extracted)
        self.incremental.write(manifest.incremental(results, self.landing, "parquet", targets), extracted)

    def _write_log(self, results, source, versions, started, extracted) -> None:
        completed = datetime.now(timezone.utc)
        with_run = results.withColumn("run_id", F.lit(f"{self.pipeline_id}-{extracted}"))
        run = with_run.select("run_id").limit(1).select(
            "run_id", F.lit(self.pipeline_id).alias("pipeline_id"), F.lit(started).alias("run_started_at"),
            F.lit(completed).alias("run_completed_at"), F.lit(source.server).alias("server"),
            F.lit(None).cast("string").alias("pipeline_config"), F.lit(self.root).alias("ingest_pipeline"),
        )
        configured = source.tables.select(F.lit(source.name).alias("database"), F.col("table_name").alias("table"), "mode")
        write_sync_log(log_rows(with_run, run, configured), self.log_path)

    def apply_plan(self) -> DataFrame:
        """Tables to apply after the latest run."""
        chosen = manifest.choose(self.incremental.read(), self.manifest.read())
        named = self.history.read().select(
            "database", schema_part(F.col("table_name")).alias("schema_name"), table_part(F.col("table_name")).alias("_table"),
            "ordinal", "name", "type", "precision", "scale",
        ).withColumnRenamed("_table", "table_name")
        return manifest.apply_plan(chosen, named)


def keyed_envelopes(
    changes: DataFrame, database: str, catalog: str | None, extracted_at_ms: int, versions: DataFrame
) -> DataFrame:
    """Envelopes of change rows whose payload is JSON text already."""
    name = F.col("table_name")
    parts = (F.lit(database), schema_part(name), table_part(name))
    version = F.col(VERSION).cast("string")
    null_text: Column = F.lit(None).cast("string")
    return changes.join(versions, "table_name", "left").select(
        "data",
        F.struct(
            F.lit(catalog or database).alias("catalog"), parts[1].alias("schema"), parts[2].alias("name"), table_uoid(*parts).alias("uoid")
        ).alias("table_id"),
        F.struct(
            null_text.alias("lsn"), version.alias("seqNum"), version.alias("sequence"), F.lit(None).cast("bigint").alias("timestamp")
        ).alias("cursor"),
        F.lit(extracted_at_ms).cast("bigint").alias("extractionTimestamp"),
        decode_operation(F.col(OPERATION)).alias("operation"),
        F.col("schema_version").alias("schemaVersion"),
        "actual_mode",
    )


def silver_table(spark: SparkSession, root: str, entry, buckets: int = BUCKETS) -> Generations:
    """The silver table of one row of an apply plan, with all its generations."""
    columns = [{k: v for k, v in c.asDict().items() if v is not None} for c in entry["columns"]]
    how = rules(entry["primary_key"], soft_delete=entry["soft_delete"])
    return Generations(spark, f"{root.rstrip('/')}/{entry['target']}", parse_schema(columns), how, entry["scd_type"], buckets)


class ApplyFailed(RuntimeError):
    """Some tables could not be applied; ``tables`` has the others, ``errors`` what stopped each, by target."""

    def __init__(self, tables: dict[str, SilverTable], errors: dict[str, Exception]) -> None:
        super().__init__("; ".join(f"{target}: {error}" for target, error in errors.items()))
        self.tables, self.errors = tables, errors


def run_apply(spark: SparkSession, landing: str, root: str, plan: DataFrame, buckets: int = BUCKETS, recompute: bool = False) -> dict[str, SilverTable]:
    """Landing to bronze to every silver table of a plan.

    The plan has one row per table. A table without a key gets no stream and stays empty. A table that fails does not
    stop the others; the run then ends with ``ApplyFailed``. A type change that stored rows cannot follow is such a
    failure, unless ``recompute`` asks for the table to be folded again from bronze.
    """
    root = root.rstrip("/")
    start_bronze(spark, landing, f"{root}/bronze", f"{root}/checkpoints/bronze").awaitTermination()
    entries = [e for e in plan.collect() if e["primary_key"]]
    tables: dict[str, SilverTable] = {}
    numbers: dict[str, int] = {}
    errors: dict[str, Exception] = {}
    known = {entry["uoid"]: silver_table(spark, f"{root}/silver", entry, buckets) for entry in entries}
    for uoid, generations in known.items():
        try:
            numbers[uoid], tables[uoid] = generations.prepare() if recompute else (generations.in_force(), generations.current())
        except Exception as error:  # noqa: BLE001  the others are still applied
            errors[uoid] = error
    suffixes = {uoid: checkpoint_suffix(number) for uoid, number in numbers.items()}
    errors |= apply_all(spark, f"{root}/bronze", list(tables.items()), f"{root}/checkpoints", suffixes=suffixes)
    target = {entry["uoid"]: entry["target"] for entry in entries}
    for uoid in tables.keys() - errors.keys():
        known[uoid].put_in_force(numbers[uoid])
    applied = {target[uoid]: silver for uoid, silver in tables.items() if uoid not in errors}
    if errors:
        raise ApplyFailed(applied, {target[uoid]: error for uoid, error in errors.items()})
    return applied
