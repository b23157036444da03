"""All tables of a bronze stream kept up to date by one query, whatever their columns.

Events of every table take one form: a row for each key and field, with the field's latest value as text and its
position. Taking maxima by table, key and field folds a whole micro-batch in one job, in any order of arrival, with
partial results on the map side; deletes, upserts and reload barriers are fields of their own. A table is read back
through its own partition and gets its types only then.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.operations import RELOAD, operation_rank
from tidemark.operators.apply import DELETED_FLAG, TIE_BITS
from tidemark.session import broadcast_if_small, read_parquet
from tidemark.streaming.bronze import bronze_stream

POSITION = "struct<seq: bigint, at: bigint, rank: bigint>"
STATE = f"key array<string>, field string, pos {POSITION}, value string, _uoid string"
REJECTED = "seq_num bigint, operation string, data string, reason string, _uoid string"
# Names of fields that are no columns; columns have a prefix.
DELETED, UPSERT, FENCE, COLUMN = "deleted", "upsert", "fence", "column:"
PARTS = 16


@dataclass(frozen=True)
class DemuxTable:
    """What a table needs to be folded (its key and kind of deletes) and to be read (its columns)."""

    uoid: str
    keys: tuple[str, ...]
    payload: T.StructType
    soft_delete: bool = False


def typed(text: Column, kind: T.DataType) -> Column:
    """A field's text as it stands in a JSON payload, as a value."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BinaryType):
        return F.unbase64(text)
    return text.try_cast(kind) if isinstance(kind, T.AtomicType) else F.from_json(text, kind)


def parsed(bronze: DataFrame, tables: DataFrame) -> DataFrame:
    """Events of all tables with their key, the fields of their payload, position, and why they are rejected, if so."""
    known = bronze.join(tables, F.col("table_id.uoid") == F.col("uoid"))
    payload = F.from_json("data", "map<string,string>")
    rank = F.shiftleft(operation_rank(F.col("operation")).cast("bigint"), TIE_BITS) + F.shiftrightunsigned(F.xxhash64("data"), 64 - TIE_BITS)
    position = F.struct(F.expr("try_cast(cursor.seqNum as bigint)").alias("seq"), F.col("extractionTimestamp").alias("at"), rank.alias("rank"))
    rows = known.select("uoid", "keys", "soft_delete", "operation", "data", payload.alias("payload"), position.alias("pos"))
    rows = rows.withColumn("key", F.transform("keys", lambda name: F.element_at("payload", name)))
    broken = F.when(F.col("data").isNull(), "no payload").when(F.col("payload").isNull(), "malformed payload").when(F.exists("key", F.isnull), "no key")
    return rows.withColumn("reason", F.when(~F.col("operation").eqNullSafe(RELOAD), broken))


def fold(rows: DataFrame) -> DataFrame:
    """The latest position and value by table, key and field."""
    latest = rows.groupBy("_uoid", "key", "field").agg(F.max(F.struct("pos", "value")).alias("latest"))
    return latest.select("key", "field", "latest.pos", "latest.value", "_uoid")


def fields_of(events: DataFrame) -> DataFrame:
    """A row for each field an event tells of."""
    deletes, barrier = F.col("operation") == "DELETE", F.col("operation") == RELOAD
    entry = lambda name, value: F.struct(name.alias("field"), value.alias("value"))
    only = lambda name: F.array(entry(F.lit(name), F.lit(None).cast("string")))
    own = F.map_entries(F.map_filter("payload", lambda name, value: value.isNotNull() & ~F.array_contains("keys", name)))
    columns = F.transform(own, lambda e: entry(F.concat(F.lit(COLUMN), e["key"]), e["value"]))
    told = (
        F.when(barrier, only(FENCE))
        .when(deletes & F.col("soft_delete"), F.concat(columns, only(DELETED)))
        .when(deletes, only(DELETED))
        .otherwise(F.concat(columns, only(UPSERT)))
    )
    key = F.when(barrier, F.array().cast("array<string>")).otherwise(F.col("key"))
    return events.select(F.col("uoid").alias("_uoid"), key.alias("key"), "pos", F.inline(told))


class DemuxedLake:
    """Type 1 tables of one bronze stream below one folder."""

    def __init__(self, spark: SparkSession, path: str, tables: Sequence[DemuxTable], parts: int = PARTS) -> None:
        self.spark, self.path, self.parts = spark, path.rstrip("/"), parts
        self.tables = {table.uoid: table for table in tables}

    def _control(self) -> DataFrame:
        rows = [(t.uoid, list(t.keys), t.soft_delete) for t in self.tables.values()]
        return broadcast_if_small(self.spark.createDataFrame(rows, "uoid string, keys array<string>, soft_delete boolean"))

    def in_force(self, before: int | None = None) -> tuple[int | None, list[int]]:
        """The last committed batch, and the batches whose parts make up the tables since."""
        commits = read_parquet(self.spark, "part bigint, batch bigint", f"{self.path}/commits")
        if commits is None:
            return None, []
        commits = commits if before is None else commits.where(F.col("batch") < before)
        last = commits.agg(F.max("batch")).first()[0]
        return last, [] if last is None else sorted(r["part"] for r in commits.where(F.col("batch") == last).collect())

    def state(self, parts: Sequence[int]) -> DataFrame:
        folders = [f"{self.path}/rows/batch={part}" for part in parts]
        if not folders:
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(f"{STATE}, batch bigint").option("basePath", f"{self.path}/rows").parquet(*folders).drop("batch")

    def apply_batch(self, bronze: DataFrame, batch: int) -> None:
        """Folds a micro-batch of all tables by one job; one that was committed before is passed over.

        Events that cannot be told a key are kept apart with the reason; those of tables not listed here are left out.
        """
        last, parts = self.in_force()
        if last is not None and batch <= last:
            return
        events = parsed(bronze, self._control()).persist()
        try:
            rejected = events.where("reason IS NOT NULL").select(F.col("pos.seq").alias("seq_num"), "operation", "data", "reason", F.col("uoid").alias("_uoid"))
            rejected.write.mode("overwrite").partitionBy("_uoid").parquet(f"{self.path}/rejected/batch={batch}")
            fresh = fold(fields_of(events.where("reason IS NULL")))
            if len(parts) >= self.parts:
                fresh, parts = fold(fresh.unionByName(self.state(parts))), []
            fresh.hint("rebalance", F.col("_uoid")).write.mode("overwrite").partitionBy("_uoid").parquet(f"{self.path}/rows/batch={batch}")
            commit = self.spark.createDataFrame([(part,) for part in [*parts, batch]], "part bigint")
            commit.write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")
        finally:
            events.unpersist()

    def read(self, uoid: str) -> DataFrame:
        """A table's current rows as of the last whole batch, read through its own partition."""
        table = self.tables[uoid]
        rows = fold(self.state(self.in_force()[1]).where(F.col("_uoid") == uoid))
        fence = rows.where(F.col("field") == FENCE).agg(F.max("pos").alias("pos"))
        names = [f.name for f in table.payload if f.name not in table.keys]
        latest = lambda field, what: F.max(F.when(F.col("field") == field, what))
        by_key = rows.where(F.col("field") != FENCE).groupBy("key").agg(
            latest(DELETED, F.col("pos")).alias("_deleted"), latest(UPSERT, F.col("pos")).alias("_upsert"),
            *[latest(COLUMN + name, F.struct("pos", "value")).alias(f"_{i}") for i, name in enumerate(names)],
        )
        gone = F.greatest(F.col("_deleted"), fence.scalar())
        by_key = by_key.withColumn("_gone", gone)
        live = F.col("_upsert").isNotNull() & (F.col("_gone").isNull() | (F.col("_upsert") > F.col("_gone")))
        types = {f.name: f.dataType for f in table.payload}
        keys = [typed(F.col("key")[i], types[name]).alias(name) for i, name in enumerate(table.keys)]

        def value(i: int, name: str) -> Column:
            held = typed(F.col(f"_{i}.value"), types[name])
            return (held if table.soft_delete else F.when(F.col("_gone").isNull() | (F.col(f"_{i}.pos") > F.col("_gone")), held)).alias(name)

        columns = {name: value(i, name) for i, name in enumerate(names)} | dict(zip(table.keys, keys))
        listed = [columns[f.name] for f in table.payload]
        return by_key.select(*listed, (~live).alias(DELETED_FLAG)) if table.soft_delete else by_key.where(live).select(*listed)

    def rejected(self) -> DataFrame:
        """Events that were kept apart, with the reason."""
        last = self.in_force()[0]
        held = read_parquet(self.spark, f"{REJECTED}, batch bigint", f"{self.path}/rejected")
        return self.spark.createDataFrame([], REJECTED) if held is None or last is None else held.where(F.col("batch") <= last).drop("batch")

    def apply_stream(self, bronze: str, checkpoint: str, max_files: int | None = None) -> StreamingQuery:
        """Applies what is new in bronze to all tables and stops when it has caught up."""
        return (
            bronze_stream(self.spark, bronze, max_files)
            .writeStream.foreachBatch(self.apply_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
