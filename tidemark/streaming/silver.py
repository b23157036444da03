"""Keeping silver tables up to date from the bronze stream, in any order of arrival.

Type 1: a batch adds its folded state; a reader takes the maxima per key. Buckets that collected many
parts are folded into one.

Type 2: the type 1 state gives the open versions and tells what later events start from. Keys whose
events all lie after what is known only add closed versions. Keys with an event from the past are folded
again from the typed events kept by bucket, and their closed versions replaced.

A reload barrier deletes every key that was there before it. Events from before a barrier that arrive later are
followed by that delete again. Envelopes that are no events are kept apart with the reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.operations import RELOAD
from tidemark.functions.types import widens
from tidemark.operators.apply import (
    DELETED_FLAG,
    END,
    LOWEST_RANK,
    START,
    ApplyRules,
    finish_state,
    fold_state,
    mark,
    merge_states,
    versions_of_marked,
)
from tidemark.operators.diff import snapshot_changes
from tidemark.operators.envelope import from_envelope, parse_envelope
from tidemark.operators.widening import UnsupportedTypeChange
from tidemark.session import broadcast_if_small, column, read_parquet
from tidemark.streaming.bronze import bronze_stream
from tidemark.streaming.buckets import BucketedTable, Parts, appended, crowded

BUCKETS = 256
PARTS_PER_BUCKET = 16
REJECTED = "seq_num bigint, operation string, data string, reason string"


@dataclass
class SilverTable:
    """One silver table: where it is kept and how events are applied to it.

    ``registry`` has the columns of earlier schema versions, so that payloads are parsed by the types they were written in.
    """

    spark: SparkSession
    path: str
    payload: T.StructType
    how: ApplyRules
    scd_type: int = 1
    buckets: int = BUCKETS
    parts_per_bucket: int = PARTS_PER_BUCKET
    registry: Mapping[int, T.StructType] | None = None

    def __post_init__(self) -> None:
        events = self._empty_events()
        state = fold_state(events, self.how).schema
        self.state = BucketedTable(self.spark, f"{self.path}/state", state, self.how.keys, self.buckets)
        closed = _closed(_versions_of(events, self.how)).schema
        self.closed = BucketedTable(self.spark, f"{self.path}/closed", closed, self.how.keys, self.buckets)
        if self.state.last_batch() is not None:
            self.state.check_settings()
        self._check_types(events)
        self.log_path = f"{self.path}/events"
        self.log_schema = T.StructType([*events.schema.fields]).add("batch", "long").add("bucket", "integer")

    def _check_types(self, events: DataFrame) -> None:
        """Refuses a payload that stored columns cannot be read as.

        Wider types are fine, the Parquet reader widens stored values; added columns read as NULL.
        """
        last = self.state.last_batch()
        if last is None:
            return
        stored = self.spark.read.parquet(f"{self.state.path}/rows/batch={last}").schema
        held = stored["_row"].dataType["value"].dataType if "_row" in stored.names else stored
        for name in self.how.values(events):
            if name in held.names:
                old = held[name].dataType if held is not stored else held[name].dataType["value"].dataType
                if not widens(old, events.schema[name].dataType):
                    raise UnsupportedTypeChange(f"{name}: {old.simpleString()} -> {events.schema[name].dataType.simpleString()}")

    def _empty_events(self) -> DataFrame:
        bronze = self.spark.createDataFrame([], "data string, cursor struct<seqNum:string>, extractionTimestamp bigint, operation string")
        return self.events(bronze)

    def events(self, bronze: DataFrame) -> DataFrame:
        """Typed events of a slice of bronze."""
        return from_envelope(bronze, self.payload, tie_break=True)

    # ---- reading ----

    def read(self) -> DataFrame:
        """The table as of the last whole batch, which is the last one whose state was committed."""
        state = merge_states(self.state.read(self.state.parts()), self.how)
        if self.scd_type == 1:
            return finish_state(state, self.how)
        open_versions = finish_state(state, self.how, with_start=True).withColumn(END, F.lit(None).cast("bigint"))
        last = self.state.last_batch()
        closed = self.closed.read({} if last is None else self.closed.parts(before=last + 1))
        return closed.unionByName(open_versions)

    def changes_between(self, first: int, last: int) -> DataFrame:
        """Inserts, deletes and images of updates that lead from the table after one batch to that after a later one.

        Commits are the versions. Only keys that the batches between have touched are folded, from the parts of their
        buckets that were in force after each of the two; the table is not read as a whole. Of a type 2 table these are
        the changes of its open versions.
        """
        if first > last:
            raise ValueError(f"batch {first} comes after batch {last}")
        before, after = self.state.parts(before=first + 1), self.state.parts(before=last + 1)
        added = {bucket: [p for p in parts if p not in before.get(bucket, [])] for bucket, parts in after.items()}
        added = {bucket: parts for bucket, parts in added.items() if parts}
        touched = self.state.read(added).select(*self.how.by).distinct()

        def then(parts: Parts) -> DataFrame:
            state = self.state.read(parts, added).join(touched, list(self.how.keys), "left_semi")
            return finish_state(merge_states(state, self.how), self.how)

        return snapshot_changes(then(before), then(after), self.how.keys)

    # ---- one batch ----

    def apply_batch(self, bronze: DataFrame, batch: int) -> None:
        """Applies a micro-batch.

        One that was committed before is passed over; one that was cut short starts from the same point.
        Batch numbers come from the checkpoint of the stream, so the two belong together: batches of another stream are
        refused, as their numbers would tell nothing about what was applied.
        """
        self._check_stream()
        last = self.state.last_batch()
        if last is not None and batch <= last:
            return
        parsed = parse_envelope(bronze, self.payload, self.how.keys, self.registry).persist()
        events = None
        try:
            barrier = F.when(F.col("operation") == RELOAD, F.struct("_seq_num", "_extracted_at"))
            found = parsed.agg(F.max(barrier).alias("barrier"), F.count_if(F.col("_reason").isNotNull()).alias("rejected")).first()
            if found["rejected"]:
                self._reject(parsed, batch)
            before = self.state.parts(before=batch)
            events = parsed.where(F.col("_reason").isNull() & ~F.col("operation").eqNullSafe(RELOAD)).drop("_reason", "_data")
            fence = self._fence(found["barrier"], batch)
            if fence is not None:
                events = events.unionByName(self._fenced_off(events, fence, before if found["barrier"] else {})).persist()
            touched = [r[0] for r in events.select(self.state.bucket()).distinct().collect()]
            if not touched:
                return
            fresh = fold_state(events, self.how)
            if self.scd_type == 1:
                self._commit_state(fresh, before, batch)
                return
            self._log(events, batch)
            met = broadcast_if_small(events.select(*self.how.by).distinct())
            stored = self.state.read(before, touched).join(met, list(self.how.keys), "left_semi")
            known = merge_states(stored, self.how)
            self._commit_closed(events, known, batch)
            # The state goes last: until it is committed, readers stay with the batch before.
            self._commit_state(fresh, before, batch)
        finally:
            parsed.unpersist()
            if events is not None:
                events.unpersist()

    def _reject(self, parsed: DataFrame, batch: int) -> None:
        rows = parsed.where("_reason IS NOT NULL").select(F.col("_seq_num").alias("seq_num"), "operation", F.col("_data").alias("data"), F.col("_reason").alias("reason"))
        rows.write.mode("overwrite").parquet(f"{self.path}/rejected/batch={batch}")

    def rejected(self) -> DataFrame:
        """Envelopes that were no events, with the reason."""
        held = read_parquet(self.spark, REJECTED, f"{self.path}/rejected")
        return self.spark.createDataFrame([], REJECTED) if held is None else held

    def _fence(self, barrier: Row | None, batch: int) -> tuple[int, int] | None:
        """The latest barrier up to this batch: version and time of the reload."""
        path = f"{self.path}/barriers"
        stored = read_parquet(self.spark, "seq bigint, at bigint, batch bigint", path)
        held = [] if stored is None else [tuple(r) for r in stored.where(F.col("batch") < batch).select("seq", "at").collect()]
        if barrier is not None:
            self.spark.createDataFrame([tuple(barrier)], "seq bigint, at bigint").write.mode("overwrite").parquet(f"{path}/batch={batch}")
            held.append(tuple(barrier))
        return max(held, default=None)

    def _fenced_off(self, events: DataFrame, fence: tuple[int, int], stored: Parts) -> DataFrame:
        """Deletes just before a reload, for keys with events from before it and those that ``stored`` parts hold."""
        seq, at = fence

        def earlier(seq_: str, at_: str) -> Column:
            return (F.col(seq_) < seq) | ((F.col(seq_) == seq) & (F.col(at_) < at))

        keys = events.where(earlier("_seq_num", "_extracted_at")).select(*self.how.by)
        if stored:
            state = merge_states(self.state.read(stored), self.how)
            live = F.col("_upsert_pos").isNotNull() & (F.col("_deleted_pos").isNull() | (F.col("_upsert_pos") > F.col("_deleted_pos")))
            keys = keys.unionByName(state.where(live & earlier("_upsert_pos.seq", "_upsert_pos.at")).select(*self.how.by))
        controls = {"_seq_num": F.lit(seq), "operation": F.lit("DELETE"), "_extracted_at": F.lit(at - 1)}
        own = set(self.how.keys)
        columns = [(controls[f.name] if f.name in controls else column(f.name) if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema]
        return keys.distinct().select(*columns)

    def _check_stream(self) -> None:
        """Remembers the id of the stream that writes the table; any other one is refused."""
        stream = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if stream is None:
            return
        held = read_parquet(self.spark, "stream string", f"{self.path}/stream")
        first = None if held is None else held.first()
        if first is None:
            self.spark.createDataFrame([(stream,)], "stream string").write.mode("overwrite").parquet(f"{self.path}/stream")
        elif first["stream"] != stream:
            raise RuntimeError(f"{self.path} is written by stream {first['stream']}; a stream with another checkpoint needs a new folder")

    def _log(self, events: DataFrame, batch: int) -> None:
        """Keeps the typed events of a batch, by bucket."""
        even = events.withColumn("bucket", self.state.bucket()).hint("rebalance", F.col("bucket"))
        even.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.log_path}/batch={batch}")

    def _logged(self, batch: int, buckets: Sequence[int]) -> DataFrame:
        """Events of some buckets up to and including a batch."""
        logged = self.spark.read.schema(self.log_schema).parquet(self.log_path)
        return logged.where((F.col("batch") <= batch) & F.col("bucket").isin(*buckets)).drop("batch", "bucket")

    def _commit_state(self, fresh: DataFrame, before: dict[int, list[int]], batch: int) -> None:
        full = crowded(before, self.parts_per_bucket)
        if full:
            fresh = merge_states(fresh.unionByName(self.state.read(before, full)), self.how)
        self.state.check_settings()
        written = self.state.write(fresh, batch)
        kept = {b: ps for b, ps in before.items() if b not in full}
        self.state.commit(appended(kept, written, batch), batch)

    def _commit_closed(self, events: DataFrame, known: DataFrame, batch: int) -> None:
        keys = list(self.how.keys)
        first = events.groupBy(*self.how.by).agg(F.min(self.how.position(events)).alias("_first_pos"))
        last = F.greatest("_deleted_pos", "_upsert_pos")
        late = F.coalesce(F.col("_first_pos") <= last, F.lit(False))
        met = first.join(known, keys, "left").withColumn("_late", late).persist()
        try:
            late_keys = met.where("_late").select(*self.how.by)
            before = self.closed.parts(before=batch)
            late_buckets = [r[0] for r in late_keys.select(self.closed.bucket()).distinct().collect()]
            rewrite = set(late_buckets) | set(crowded(before, self.parts_per_bucket))
            others = self.closed.read(before, rewrite)
            if late_buckets:
                late_keys = broadcast_if_small(late_keys)
                events = events.join(late_keys, keys, "left_anti")
                others = others.join(late_keys, keys, "left_anti")
                past = self._logged(batch, late_buckets).join(late_keys, keys, "left_semi")
                others = others.unionByName(_closed(_versions_of(past, self.how)))
            closed = _closed(_continued(events, met.where(~F.col("_late")), self.how)).unionByName(others)
            written = self.closed.write(closed, batch)
            kept = {b: ps for b, ps in before.items() if b not in rewrite}
            self.closed.commit(appended(kept, written, batch), batch)
        finally:
            met.unpersist()


def _versions_of(events: DataFrame, how: ApplyRules) -> DataFrame:
    return versions_of_marked(mark(events, how), how.values(events), how)


def _closed(versions: DataFrame) -> DataFrame:
    return versions.where(F.col(END).isNotNull())


def _continued(events: DataFrame, known: DataFrame, how: ApplyRules) -> DataFrame:
    """Versions of keys whose events follow all that is known: the open version joins in as an event.

    It carries its values under its own position, which lies before every new event.
    """
    values = how.values(events)
    met_before = F.coalesce("_upsert_pos", "_deleted_pos").isNotNull()
    open_rows = finish_state(known.where(met_before).drop("_first_pos", "_late"), how, with_start=True)
    deleted = F.col(DELETED_FLAG) if how.soft_delete else F.lit(False)
    lowest = F.struct(
        F.col(START).alias("seq"), F.lit(-1).cast("bigint").alias("at"), F.lit(LOWEST_RANK).cast("bigint").alias("rank")
    )
    base = open_rows.select(*how.by, *[column(c) for c in values], lowest.alias("_pos"), deleted.alias("_del"))
    return versions_of_marked(mark(events, how).unionByName(base), values, how)


def apply_stream(
    spark: SparkSession, bronze: str, uoid: str, silver: SilverTable, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Applies new bronze events of one table to its silver table and stops when it has caught up."""
    return (
        bronze_stream(spark, bronze, max_files)
        .where(F.col("_uoid") == uoid)
        .writeStream.foreachBatch(silver.apply_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def apply_all(
    spark: SparkSession, bronze: str, tables: Sequence[tuple[str, SilverTable]], checkpoints: str, at_once: int = 16, suffixes: Mapping[str, str] | None = None
) -> dict[str, Exception]:
    """One stream per table, ``at_once`` of them at a time; each reads only its own part of bronze.

    Checkpoints are named after table ids, and ``suffixes`` of these where there are any.

    A table whose stream fails does not stop the others; the errors come back by table id.
    """
    failed: dict[str, Exception] = {}
    suffixes = suffixes or {}
    for start in range(0, len(tables), at_once):
        group = tables[start : start + at_once]
        running = [(uoid, apply_stream(spark, bronze, uoid, silver, f"{checkpoints}/{uoid}{suffixes.get(uoid, '')}")) for uoid, silver in group]
        for uoid, query in running:
            try:
                query.awaitTermination()
            except StreamingQueryException as error:
                failed[uoid] = error
    return failed
