"""The registered queries. Each takes a session and the folder of the tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import partition_day
from tidemark.functions.identity import qualified_name, schema_part, table_part, table_uoid, uoid_of
from tidemark.functions.operations import decode_operation
from tidemark.operators import ledger, manifest, schema_history
from tidemark.operators.apply import (
    after_reload,
    apply_changes,
    current_versions,
    rules,
    versions_as_of,
)
from tidemark.operators.diff import snapshot_changes
from tidemark.operators.envelope import decode_generations, from_envelope, reload_barrier, schema_registry, schema_version, to_envelope, with_table_partition
from tidemark.operators.sinks import write_landing, write_sync_log
from tidemark.operators.widening import union_widened
from tidemark.plans import metrics, runlog
from tidemark.plans.extract import SourceTable, extract_tables
from tidemark.plans.refresh import RefreshedSummary
from tidemark.plans.sync_run import sync_tables
from tidemark.session import shared_folder
from tidemark.sources import catalog
from tidemark.sources.feed import OPERATION, VERSION, feed_bounds, full_load, incremental_changes, net_changes
from tidemark.sources.landing import sync_log
from tidemark.streaming.bronze import BRONZE_SCHEMA, bronze_table, start_bronze
from tidemark.streaming.demux import DemuxedLake, DemuxTable
from tidemark.streaming.generations import Generations
from tidemark.streaming.silver import SilverTable, apply_stream
from tidemark.workload import frames

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles at four places, so that the order of additions does not show.

    The small shift takes values off the middle between two results.
    """
    return df.withColumns({c: F.round(F.col(c) + 1e-9, 4) for c in columns})


# ---- sources ---------------------------------------------------------------------------------------


@query
def full_load_(spark: SparkSession, d: str) -> DataFrame:
    customers = frames.table(spark, d, "customer")
    return full_load(customers, 100)


@query
def incremental_changes_(spark: SparkSession, d: str) -> DataFrame:
    return incremental_changes(frames.order_feed(spark, d), frames.current_orders(spark, d), ["o_orderkey"], frames.FEED_SINCE)


def _user_type_rows(spark: SparkSession, d: str) -> DataFrame:
    """Current rows by user and event type."""
    return apply_changes(frames.user_events(spark, d), ["user_id", "event_type"], ignore_nulls=False)


@query
def incremental_changes_composite_key(spark: SparkSession, d: str) -> DataFrame:
    keys = ["user_id", "event_type"]
    feed = net_changes(frames.change_log(spark, d), keys)
    return incremental_changes(feed, _user_type_rows(spark, d), keys, 0)


@query
def net_changes_(spark: SparkSession, d: str) -> DataFrame:
    return net_changes(frames.change_log(spark, d), ["user_id"])


@query
def net_changes_first_insert(spark: SparkSession, d: str) -> DataFrame:
    return net_changes(frames.change_log(spark, d), ["user_id"], creation="first")


@query
def column_metadata(spark: SparkSession, d: str) -> DataFrame:
    return catalog.column_metadata(frames.information_schema(spark, d))


@query
def primary_key_map(spark: SparkSession, d: str) -> DataFrame:
    columns = catalog.column_metadata(frames.information_schema(spark, d))
    described = columns.select("table_name", F.col("ordinal").alias("column_id"), "name")
    tables = columns.select("table_name").distinct()
    indexes = tables.select("table_name", F.explode(F.array(F.lit(1), F.lit(2))).alias("index_id"))
    indexes = indexes.withColumn("is_primary_key", F.col("index_id") == 1)
    # The key order runs against the column order, so sorting by ordinal shows.
    indexed = described.select("table_name", F.lit(1).alias("index_id"), (10 - F.col("column_id")).alias("key_ordinal"), "column_id")
    keys = catalog.primary_key_map(indexes, indexed, described)
    return keys.select("table_name", F.array_join("primary_key", ",").alias("primary_key"))


@query
def resolve_tables(spark: SparkSession, d: str) -> DataFrame:
    tracked = frames.event_bounds(spark, d).select("table_name")
    return catalog.resolve_tables(frames.configured_tables(spark, d), tracked, carry=["mode"])


@query
def feed_bounds_(spark: SparkSession, d: str) -> DataFrame:
    return feed_bounds(frames.keyed_feed(spark, d))


def _written_log(spark: SparkSession, d: str) -> DataFrame:
    folder = shared_folder(spark, "sync_log")
    write_sync_log(frames.sync_log_rows(spark, d), folder)
    return sync_log(spark, folder)


@query
def sync_log_scan(spark: SparkSession, d: str) -> DataFrame:
    return _written_log(spark, d).groupBy("sync_date", "table_status").agg(
        F.count("*").alias("tables"), F.coalesce(F.sum("rows_written"), F.lit(0)).alias("rows_written")
    ).withColumn("sync_date", F.col("sync_date").cast("string"))


# ---- envelope --------------------------------------------------------------------------------------


def _users_envelope(spark: SparkSession, d: str) -> DataFrame:
    return to_envelope(frames.change_log(spark, d), "app", "web", "users", "lake", 1_700_000_000_000)


@query
def envelope_encode(spark: SparkSession, d: str) -> DataFrame:
    envelope = _users_envelope(spark, d)
    field = lambda name: F.get_json_object("data", f"$.{name}")
    return envelope.select(
        F.col("table_id.catalog").alias("catalog"), F.col("table_id.schema").alias("schema_name"),
        F.col("table_id.name").alias("table_name"), F.col("table_id.uoid").alias("uoid"),
        F.col("cursor.lsn").alias("lsn"), F.col("cursor.seqNum").alias("seq_num"),
        F.col("cursor.sequence").alias("sequence"), F.col("cursor.timestamp").alias("cursor_ts"),
        "extractionTimestamp", "operation", "schemaVersion",
        field("user_id").cast("bigint").alias("user_id"), field("event_type").alias("event_type"),
        field("value").cast("double").alias("value"), field("k").cast("int").alias("k"),
        F.array_join(F.json_object_keys("data"), ",").alias("fields"),
    )


@query
def envelope_decode(spark: SparkSession, d: str) -> DataFrame:
    return from_envelope(with_table_partition(_users_envelope(spark, d)), frames.USERS_PAYLOAD, uoid_of("app", "web", "users"))


@query
def envelope_timestamps(spark: SparkSession, d: str) -> DataFrame:
    """Timestamps of both types with added microseconds, through the envelope and back."""
    micros = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), ((F.col("event_id") * 7919) % 1_000_000 / 1_000_000).cast("decimal(18,6)"))
    stamp = F.col("ts").cast("timestamp") + micros
    changes = frames.table(spark, d, "events").select(
        F.lit(1).cast("bigint").alias(VERSION), F.lit("L").alias(OPERATION), "event_id", stamp.alias("at"), stamp.cast("timestamp_ntz").alias("local"),
    )
    payload = T.StructType().add("event_id", "long").add("at", "timestamp").add("local", "timestamp_ntz")
    back = from_envelope(to_envelope(changes, "app", "web", "events", extracted_at_ms=0), payload)
    text = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("at", "local")}
    return back.select("event_id", *[column.alias(f"{c}_text") for c, column in text.items()])


@query
def envelope_binary(spark: SparkSession, d: str) -> DataFrame:
    documents = frames.table(spark, d, "documents").select(
        F.lit(1).cast("bigint").alias(VERSION), F.lit("L").alias(OPERATION), "doc_id",
        F.when(F.col("lang") != "fr", F.encode("text", "UTF-8")).alias("body"),
    )
    envelope = to_envelope(documents, "docs", "dbo", "documents", extracted_at_ms=0)
    payload = T.StructType().add("doc_id", "long").add("body", "binary")
    decoded = envelope.select(F.get_json_object("data", "$.body").alias("base64"), F.from_json("data", payload).alias("p"))
    return decoded.select("p.doc_id", F.md5("base64").alias("base64_md5"), F.octet_length("p.body").alias("n_bytes"))


@query
def operation_decode(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    code = (
        F.when(kind == "signup", "I ").when(kind == "error", " D").when(kind == "view", "L")
        .when(kind == "purchase", F.substring("props", 7, 1)).when(F.col("value") < 50, "").when(F.col("value") < 75, "U")
    )
    return frames.table(spark, d, "events").select("event_id", decode_operation(code).alias("operation"))


@query
def table_uoid_(spark: SparkSession, d: str) -> DataFrame:
    return frames.table(spark, d, "customer").select(
        "c_custkey", table_uoid(F.lower("c_mktsegment"), F.concat(F.lit("a."), F.col("c_nationkey")), F.col("c_name")).alias("uoid")
    )


@query
def schema_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return catalog.schema_fingerprint(catalog.column_metadata(frames.information_schema(spark, d)))


@query
def soft_delete_flag(spark: SparkSession, d: str) -> DataFrame:
    return from_envelope(_users_envelope(spark, d), frames.USERS_PAYLOAD, soft_delete=True)


@query
def envelope_decode_generations(spark: SparkSession, d: str) -> DataFrame:
    """One bronze written under two schemas, a date that became a time and an added column, read by the schema of each."""
    events = frames.parsed_events(spark, d).select((F.col("event_id") + 1).alias(VERSION), F.lit("U").alias(OPERATION), "user_id", "ts", "value", "k")
    old = events.where(F.col(VERSION) % 3 == 0).select(VERSION, OPERATION, "user_id", F.col("ts").cast("date").alias("at"), F.col("value").cast("decimal(10,2)").alias("value"))
    new = events.where(F.col(VERSION) % 3 != 0).select(VERSION, OPERATION, "user_id", F.col("ts").cast("timestamp_ntz").alias("at"), "value", "k")
    bronze = to_envelope(old, "app", "web", "users", extracted_at_ms=0).unionByName(to_envelope(new, "app", "web", "users", extracted_at_ms=0))
    columns = [(i, c["ordinal"], c["name"], c["type"], c.get("precision"), c.get("scale")) for i, df in enumerate((old, new)) for c in catalog.describe_columns(df.schema)]
    versions = [df.limit(1).select(schema_version(df)).first() for df in (old, new)]
    known = [(versions[i][0], *rest) for i, *rest in columns if versions[i] is not None]
    history = spark.createDataFrame(known, "schema_version long, ordinal int, name string, type string, precision int, scale int")
    target = T.StructType().add("user_id", "long").add("at", "timestamp_ntz").add("value", "double").add("k", "integer")
    decoded = decode_generations(bronze, schema_registry(history), target)
    return decoded.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))


def _feed_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Each event type as a table of its own, all of them in one frame."""
    rows = frames.change_log(spark, d).select(VERSION, OPERATION, "user_id", "event_type", "value", "k")
    return to_envelope(rows, F.lit("app"), F.lit("dbo"), F.col("event_type"), extracted_at_ms=1_700_000_000_000)


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query
def demux_counts(spark: SparkSession, d: str) -> DataFrame:
    """All event types written into one bronze; each table is read back through its own partition."""
    folder = shared_folder(spark, "demux")
    write_landing(_feed_envelopes(spark, d), folder, "2024-02-01")
    bronze, counts = bronze_table(spark, folder), None
    for kind in EVENT_TYPES:
        events = from_envelope(bronze, T.StructType().add("user_id", "long"), uoid_of("app", "dbo", kind))
        own = events.agg(F.count("*").alias("events"), F.count_if(F.col("operation") == "DELETE").alias("deletes"), F.sum("user_id").alias("user_sum"))
        own = own.where("events > 0").select(F.lit(uoid_of("app", "dbo", kind)).alias("_uoid"), F.lit(kind).alias("table_name"), "*")
        counts = own if counts is None else counts.unionByName(own)
    return counts


@query
def demux_apply(spark: SparkSession, d: str) -> DataFrame:
    """Five tables folded by one stream over one bronze, landed in three goes with repeated and malformed events."""
    folder, payload = shared_folder(spark, "demux"), T.StructType().add("user_id", "long").add("value", "double").add("k", "integer")
    seq = F.col("cursor.seqNum").cast("bigint")
    broken = F.when(seq % 29 == 0, F.substring("data", 1, 20)).otherwise(F.col("data"))
    envelopes = _feed_envelopes(spark, d).withColumn("data", broken)
    lake = DemuxedLake(spark, f"{folder}/silver", [DemuxTable(uoid_of("app", "dbo", kind), ("user_id",), payload) for kind in EVENT_TYPES], parts=2)
    for go in (2, 0, 1):  # the latest events do not come last
        write_landing(envelopes.where((seq % 3 == go) | (seq % 5 == go)), f"{folder}/landing", "2024-02-01")
        start_bronze(spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/bronze_checkpoint").awaitTermination()
        lake.apply_stream(f"{folder}/bronze", f"{folder}/silver_checkpoint").awaitTermination()
    read = [lake.read(uoid_of("app", "dbo", kind)).select(F.lit(kind).alias("table_name"), "*") for kind in EVENT_TYPES]
    return reduce(DataFrame.unionByName, read)


@query
def rejected_rows(spark: SparkSession, d: str) -> DataFrame:
    """Envelopes that are no events, kept apart by a stream in three goes: cut short, of wrong types, without a key or payload."""
    seq, data = F.col("cursor.seqNum").cast("bigint"), F.col("data")
    broken = (
        F.when(seq % 13 == 0, F.expr("substring(data, 1, length(data) - 3)"))
        .when(seq % 17 == 0, F.regexp_replace("data", '"user_id":[0-9]+', '"user_id":null'))
        .when(seq % 19 == 0, F.regexp_replace("data", '"user_id":[0-9]+', '"user_id":"none"'))
        .when(seq % 23 != 0, data)
    )
    envelopes = _users_envelope(spark, d).withColumn("data", broken)
    folder, silver = shared_folder(spark, "rejected"), None
    for go in range(3):
        write_landing(envelopes.where(seq % 3 == go), f"{folder}/landing", "2024-02-01")
        silver = _stream_users(spark, folder)
    return silver.rejected().select("seq_num", "operation", "reason")


# ---- apply -----------------------------------------------------------------------------------------


def _users(spark: SparkSession, d: str) -> DataFrame:
    return frames.user_events(spark, d).drop("event_type")


@query
def scd1_apply(spark: SparkSession, d: str) -> DataFrame:
    """The whole path: change rows to envelopes, back to events, applied by key."""
    events = from_envelope(_users_envelope(spark, d), frames.USERS_PAYLOAD)
    return apply_changes(events.drop("event_type"), "user_id")


@query
def scd1_ignore_nulls(spark: SparkSession, d: str) -> DataFrame:
    return apply_changes(_users(spark, d), "user_id")


@query
def scd1_keep_nulls(spark: SparkSession, d: str) -> DataFrame:
    return apply_changes(_users(spark, d), "user_id", ignore_nulls=False)


@query
def scd1_soft_delete(spark: SparkSession, d: str) -> DataFrame:
    return apply_changes(_users(spark, d), "user_id", soft_delete=True)


@query
def scd1_out_of_order(spark: SparkSession, d: str) -> DataFrame:
    """Events in scrambled order and delivered twice lead to the same rows."""
    events = _users(spark, d)
    return apply_changes(events.unionByName(events).orderBy(F.xxhash64("_seq_num")), "user_id")


@query
def scd1_delete_predicate(spark: SparkSession, d: str) -> DataFrame:
    return apply_changes(_users(spark, d), "user_id", delete_when="operation = 'DELETE' OR k > 90")


@query
def scd1_composite_key(spark: SparkSession, d: str) -> DataFrame:
    return apply_changes(frames.user_events(spark, d), ["user_id", "event_type"])


@query
def scd1_after_reload(spark: SparkSession, d: str) -> DataFrame:
    """Users whose first view was a full load: what came before the last load is gone."""
    events = _users(spark, d)
    first = events.groupBy("user_id").agg(F.min("_seq_num").alias("_seq_num")).withColumn("first", F.lit(True))
    marked = events.join(first, ["user_id", "_seq_num"], "left").withColumn("operation", F.when(F.col("first"), "LOAD").otherwise(F.col("operation"))).drop("first")
    return apply_changes(after_reload(marked, rules("user_id")), "user_id")


@query
def scd2_apply(spark: SparkSession, d: str) -> DataFrame:
    return apply_changes(_users(spark, d), "user_id", scd_type=2)


@query
def scd2_soft_delete(spark: SparkSession, d: str) -> DataFrame:
    return apply_changes(_users(spark, d), "user_id", scd_type=2, soft_delete=True)


@query
def scd2_keep_nulls(spark: SparkSession, d: str) -> DataFrame:
    return apply_changes(_users(spark, d), "user_id", scd_type=2, ignore_nulls=False)


@query
def scd2_split_keys(spark: SparkSession, d: str) -> DataFrame:
    """Every key cut into blocks of the sequence, as a key with very many events would be."""
    return apply_changes(_users(spark, d), "user_id", scd_type=2, max_group_rows=10)


@query
def scd2_current(spark: SparkSession, d: str) -> DataFrame:
    return current_versions(scd2_apply(spark, d))


@query
def scd2_as_of(spark: SparkSession, d: str) -> DataFrame:
    """Versions in force when the first purchase above 90 happened."""
    purchases = frames.table(spark, d, "events").where((F.col("event_type") == "purchase") & (F.col("value") > 90))
    return versions_as_of(scd2_apply(spark, d), purchases.agg(F.min("event_id")).scalar())


def _landed(spark: SparkSession, d: str) -> tuple[str, str]:
    """Users in a landing folder and the bronze table that a stream has made of it."""
    folder = shared_folder(spark, "users")
    write_landing(_users_envelope(spark, d), f"{folder}/landing", "2024-02-01")
    start_bronze(spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/bronze_checkpoint").awaitTermination()
    return folder, f"{folder}/bronze"


@query
def bronze_stream(spark: SparkSession, d: str) -> DataFrame:
    folder, bronze = _landed(spark, d)
    return bronze_table(spark, bronze).groupBy("_uoid", "operation").agg(F.count("*").alias("events"), F.max("_seq_num").alias("last_seq"))


def _stream_users(spark: SparkSession, folder: str, scd_type: int = 1) -> SilverTable:
    """The silver table of users after all that has been landed below a folder."""
    start_bronze(spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/bronze_checkpoint").awaitTermination()
    payload = T.StructType([f for f in frames.USERS_PAYLOAD if f.name != "event_type"])
    silver = SilverTable(spark, f"{folder}/silver", payload, rules("user_id"), scd_type, buckets=8)
    apply_stream(spark, f"{folder}/bronze", uoid_of("app", "web", "users"), silver, f"{folder}/silver_checkpoint").awaitTermination()
    return silver


def _streamed(spark: SparkSession, d: str, scd_type: int) -> DataFrame:
    """Users landed in three goes: most events, late ones from among them and repeated ones, and the last ones."""
    folder, envelopes = shared_folder(spark, "users"), _users_envelope(spark, d)
    seq = F.col("cursor.seqNum").cast("bigint")
    last = frames.change_log(spark, d).agg(F.max(VERSION)).first()[0]
    late = seq % 97 == 0
    goes = ((seq <= last * 2 // 3) & ~late, late | (seq % 101 == 0), (seq > last * 2 // 3) & ~late)
    for go in goes:
        write_landing(envelopes.where(go), f"{folder}/landing", "2024-02-01")
        silver = _stream_users(spark, folder, scd_type)
    return silver.read()


@query
def scd1_streaming(spark: SparkSession, d: str) -> DataFrame:
    return _streamed(spark, d, 1)


@query
def scd2_streaming(spark: SparkSession, d: str) -> DataFrame:
    return _streamed(spark, d, 2)


@query
def recompute_after_type_change(spark: SparkSession, d: str) -> DataFrame:
    """A decimal column that becomes text halfway: the table is folded again from bronze and replaced."""
    folder, log = shared_folder(spark, "retyped"), frames.change_log(spark, d).drop("event_type")
    half = log.agg(F.max(VERSION)).first()[0] // 2
    amount = F.col("value").cast("decimal(10,2)")
    goes = [(log.where(F.col(VERSION) <= half).withColumn("value", amount), "decimal(10,2)"),
            (log.where(F.col(VERSION) > half).withColumn("value", F.concat(amount.cast("string"), F.lit(" EUR"))), "string")]
    registry = {}
    for changes, kind in goes:
        write_landing(to_envelope(changes, "app", "web", "users", extracted_at_ms=1_700_000_000_000), f"{folder}/landing", "2024-02-01")
        start_bronze(spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/bronze_checkpoint").awaitTermination()
        payload = T.StructType().add("user_id", "long").add("value", kind).add("k", "integer")
        registry[changes.limit(1).select(schema_version(changes)).first()[0]] = payload
        table = Generations(spark, f"{folder}/silver", payload, rules("user_id"), buckets=8, registry=registry)
        table.apply(f"{folder}/bronze", uoid_of("app", "web", "users"), f"{folder}/silver_checkpoint")
    return table.read()


@query
def scd1_streaming_reload(spark: SparkSession, d: str) -> DataFrame:
    """Events, then a full reload with a third of the users, then later events and some from before the reload again."""
    folder, log = shared_folder(spark, "reloaded"), frames.change_log(spark, d)
    version = log.agg(F.max(VERSION)).first()[0] // 2
    at = 1_700_000_000_000

    def land(envelopes: DataFrame, reload: bool = False) -> SilverTable:
        write_landing(envelopes, f"{folder}/landing", "2024-02-01", reload=reload)
        return _stream_users(spark, folder)

    as_users = lambda changes, ms: to_envelope(changes, "app", "web", "users", "lake", ms)
    land(as_users(log.where(F.col(VERSION) <= version), at))
    before = apply_changes(_users(spark, d).where(F.col("_seq_num") <= version), "user_id").where("user_id % 3 = 0")
    barrier = reload_barrier(spark, "app", "web", "users", version, at + 1000, "lake")
    land(as_users(full_load(before, version), at + 1000).unionByName(barrier), reload=True)
    repeated = (F.col(VERSION) < version) & (F.col(VERSION) % 7 == 0)
    return land(as_users(log.where((F.col(VERSION) > version) | repeated), at + 2000)).read()


@query
def silver_changes_between(spark: SparkSession, d: str) -> DataFrame:
    """Row changes of a streamed table between its first and its last batch, from the keys touched in between."""
    folder, log = shared_folder(spark, "versions"), frames.change_log(spark, d)
    last = log.agg(F.max(VERSION)).first()[0]
    version = F.col(VERSION)
    batches = []
    for go in (version <= last * 9 // 10, (version > last * 9 // 10) & (version % 2 == 0), (version > last * 9 // 10) & (version % 2 == 1)):
        envelopes = to_envelope(log.where(go), "app", "web", "users", "lake", 1_700_000_000_000)
        write_landing(envelopes, f"{folder}/landing", "2024-02-01")
        silver = _stream_users(spark, folder)
        batches.append(silver.state.last_batch())
    return silver.changes_between(batches[0], batches[-1])


@query
def silver_change_feed(spark: SparkSession, d: str) -> DataFrame:
    """Changes of the users table between the watermark date and now."""
    cut = F.lit(frames.WATERMARK_CUT).cast("timestamp_ntz")
    before = frames.table(spark, d, "events").where(F.col("ts") < cut).select((F.col("event_id") + 1).alias("_seq_num"))
    events = _users(spark, d)
    old = apply_changes(events.join(before, "_seq_num", "left_semi"), "user_id")
    return snapshot_changes(old, apply_changes(events, "user_id"), ["user_id"])


@query
def type_widening(spark: SparkSession, d: str) -> DataFrame:
    """Stored int and decimal columns meet wider ones and a new column."""
    parts = frames.table(spark, d, "part")
    stored = parts.where("p_size <= 25").select(
        "p_partkey", F.col("p_size").cast("int").alias("size"), F.col("p_retailprice").cast("decimal(10,2)").alias("price"), F.col("p_type").alias("old_type")
    )
    incoming = parts.where("p_size > 25").select(
        "p_partkey", F.col("p_size").cast("bigint").alias("size"), F.col("p_retailprice").cast("decimal(14,4)").alias("price"), "p_brand"
    )
    return union_widened(stored, incoming)


# ---- scalar functions ------------------------------------------------------------------------------


def _dated_text() -> Column:
    """Event times in several spellings, some of them not dates."""
    kind = F.col("event_type")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return (
        F.when(kind == "signup", F.concat(iso, F.lit("-05:00")))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
        .when(kind == "click", F.date_format("ts", "yyyy-MM-dd"))
        .when((kind == "error") & (F.col("value") < 30), F.concat(iso, F.lit("Z")))
        .when((kind == "error") & (F.col("value") < 60), F.concat(F.lit("2024-02-31T"), F.date_format("ts", "HH:mm")))
        .when(kind == "error", F.concat(F.lit("about "), F.date_format("ts", "yyyy")))
        .when(F.col("value") < 50, F.date_format("ts", "MM-dd"))
    )


@query
def partition_date(spark: SparkSession, d: str) -> DataFrame:
    return frames.table(spark, d, "events").select(
        "event_id",
        partition_day(F.col("ts"), T.TimestampNTZType()).alias("ts_day"),
        partition_day(_dated_text(), T.StringType()).alias("text_day"),
        partition_day(F.col("value"), T.DoubleType()).alias("number_day"),
    )


@query
def split_table_name(spark: SparkSession, d: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    name = (
        F.when(segment == "BUILDING", F.col("c_name"))
        .when(segment == "MACHINERY", F.concat(F.lit("a.b."), F.col("c_name")))
        .otherwise(F.concat_ws(".", segment, F.col("c_name")))
    )
    return frames.table(spark, d, "customer").select(
        "c_custkey", schema_part(name).alias("schema_name"), table_part(name).alias("table_name")
    )


# ---- ledger and planning ---------------------------------------------------------------------------


@query
def latest_watermarks(spark: SparkSession, d: str) -> DataFrame:
    entries = ledger.parse_entries(frames.raw_ledger(spark, d))
    dated = entries.withColumn("synced_at", F.coalesce("synced_at", "d")).drop("d")
    return ledger.latest_watermarks(dated).withColumn("files", F.array_join("files", ","))


@query
def sync_history(spark: SparkSession, d: str) -> DataFrame:
    entries = ledger.parse_entries(frames.raw_ledger(spark, d))
    dated = entries.withColumn("synced_at", F.coalesce("synced_at", "d")).drop("d", "files")
    return ledger.sync_history(dated)


@query
def min_valid_versions(spark: SparkSession, d: str) -> DataFrame:
    known = frames.event_bounds(spark, d).where(F.col("table_name") != "dbo.click")
    return ledger.min_valid_versions(frames.event_bounds(spark, d), known)


def _feed_until_cut(spark: SparkSession, d: str) -> DataFrame:
    """The keyed feed in which nothing happened to signups after the watermark date."""
    signups = F.col("table_name") == "dbo.signup"
    marks = frames.event_watermarks(spark, d).where(signups).select("version")
    return frames.keyed_feed(spark, d).where(~signups | (F.col(VERSION) <= marks.scalar()))


@query
def changed_tables(spark: SparkSession, d: str) -> DataFrame:
    return ledger.changed_tables(frames.event_watermarks(spark, d), _feed_until_cut(spark, d))


@query
def unchanged_tables(spark: SparkSession, d: str) -> DataFrame:
    return ledger.unchanged_tables(frames.event_watermarks(spark, d), frames.event_bounds(spark, d), _feed_until_cut(spark, d))


def _keys(spark: SparkSession, d: str) -> DataFrame:
    """Primary keys: errors have none."""
    name = F.col("table_name")
    key = F.when(name != "dbo.error", F.array(F.lit("user_id"))).otherwise(F.array().cast("array<string>"))
    return frames.event_bounds(spark, d).select("table_name", key.alias("primary_key"))


@query
def sync_mode(spark: SparkSession, d: str) -> DataFrame:
    return ledger.resolve_modes(
        frames.configured_tables(spark, d), frames.event_watermarks(spark, d), frames.event_bounds(spark, d), _keys(spark, d)
    )


@query
def sync_mode_override(spark: SparkSession, d: str) -> DataFrame:
    return ledger.resolve_modes(
        frames.configured_tables(spark, d), frames.event_watermarks(spark, d), frames.event_bounds(spark, d), override="incremental"
    )


def _tracked_tables(spark: SparkSession, d: str) -> DataFrame:
    return frames.event_bounds(spark, d).select(
        "table_name", F.when(F.col("table_name") == "dbo.purchase", "incremental").alias("mode")
    )


def _typed_tables(spark: SparkSession, d: str) -> list[SourceTable]:
    """Orders by their feed, customers for the first time, parts without a start, suppliers without a change."""
    read = lambda name: lambda: frames.table(spark, d, name)
    return [
        SourceTable("sales.orders", lambda: frames.current_orders(spark, d), ("o_orderkey",), lambda: frames.order_feed(spark, d)),
        SourceTable("customer", read("customer"), ("c_custkey",), scd_type=2),
        SourceTable("stock.part", read("part"), ("p_partkey",), mode="incremental"),
        SourceTable("stock.supplier", read("supplier"), ("s_suppkey",)),
    ]


@query
def sync_from_tables(spark: SparkSession, d: str) -> DataFrame:
    """Typed tables of different schemas extracted as one job: decisions, rows written, and the change rows landed."""
    names = ["sales.orders", "dbo.customer", "stock.part", "stock.supplier"]
    newest = frames.order_feed(spark, d).agg(F.max(VERSION)).first()[0]
    bounds = spark.createDataFrame([(n, 1, newest if n == "sales.orders" else 9) for n in names], "table_name string, min_version bigint, max_version bigint")
    marks = spark.createDataFrame([("sales.orders", frames.FEED_SINCE), ("stock.supplier", 9)], "table_name string, version bigint")
    folder = shared_folder(spark, "typed")
    done = extract_tables(spark, "shop", _typed_tables(spark, d), marks, bounds, lambda rows, mode: write_landing(rows, folder, "2024-02-01"), 1_700_000_000_000)
    field = lambda *names: F.coalesce(*[F.get_json_object("data", f"$.{name}") for name in names])
    landed = spark.read.schema(BRONZE_SCHEMA).parquet(folder).where("operation <> 'RELOAD'").select(
        F.concat_ws(".", "table_id.schema", "table_id.name").alias("_name"), "operation", F.col("cursor.seqNum").cast("bigint").alias("seq_num"),
        field("o_orderkey", "c_custkey").cast("bigint").alias("key"), F.round(field("o_totalprice", "c_acctbal").cast("double"), 2).alias("amount"),
        field("o_orderpriority", "c_mktsegment").alias("label"), F.size(F.json_object_keys("data")).alias("fields"),
    )
    named = done.results.withColumn("_name", qualified_name(F.col("table_name"))).drop("duration_seconds")
    return named.join(landed, "_name", "left").drop("_name")


@query
def multi_table_sync(spark: SparkSession, d: str) -> DataFrame:
    feed = _feed_until_cut(spark, d)
    snapshots = feed.groupBy("table_name", "key").agg(F.max_by("data", VERSION).alias("data"))
    run = sync_tables(
        _tracked_tables(spark, d), frames.event_watermarks(spark, d), frames.event_bounds(spark, d), feed, snapshots, _keys(spark, d)
    )
    return run.results


# ---- schema history --------------------------------------------------------------------------------


def _history(spark: SparkSession, d: str) -> DataFrame:
    columns = catalog.column_metadata(frames.information_schema(spark, d))
    versions = catalog.schema_fingerprint(columns)
    return columns.join(versions, "table_name").select(
        "table_name", "ordinal", "name", "type", "precision", "scale",
        F.lit(None).cast("string").alias("previous_type"),
        F.lit("2024-01-01").cast("timestamp").alias("last_seen"), "schema_version",
    )


@query
def schema_diff(spark: SparkSession, d: str) -> DataFrame:
    incoming = catalog.column_metadata(frames.information_schema(spark, d, later=True))
    return schema_history.schema_diff(_history(spark, d), incoming)


@query
def schema_drift(spark: SparkSession, d: str) -> DataFrame:
    incoming = catalog.column_metadata(frames.information_schema(spark, d, later=True))
    return schema_history.schema_status(_history(spark, d), incoming, catalog.schema_fingerprint(incoming))


@query
def schema_merge(spark: SparkSession, d: str) -> DataFrame:
    incoming = catalog.column_metadata(frames.information_schema(spark, d, later=True))
    merged = schema_history.merge_schema(
        _history(spark, d), incoming, catalog.schema_fingerprint(incoming), F.lit("2024-02-01").cast("timestamp")
    )
    return merged.withColumn("last_seen", F.date_format("last_seen", "yyyy-MM-dd"))


# ---- manifest --------------------------------------------------------------------------------------


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("primary_key", F.array_join("primary_key", ","))


@query
def manifest_merge_add(spark: SparkSession, d: str) -> DataFrame:
    added = manifest.entries(frames.supplier_results(spark, d), "/data", "parquet", frames.manifest_targets(spark, d))
    return _flat(manifest.merge_add(frames.known_manifest(spark, d), added))


@query
def manifest_incremental(spark: SparkSession, d: str) -> DataFrame:
    return _flat(manifest.incremental(frames.supplier_results(spark, d), "/data", "parquet", frames.manifest_targets(spark, d)))


@query
def manifest_fallback(spark: SparkSession, d: str) -> DataFrame:
    """A run without any target names falls back to the full manifest."""
    untargeted = manifest.incremental(frames.supplier_results(spark, d), "/data", "parquet")
    return _flat(manifest.choose(untargeted, frames.known_manifest(spark, d)))


@query
def manifest_flatten(spark: SparkSession, d: str) -> DataFrame:
    return _flat(manifest.flatten(frames.nested_manifest(spark, d)))


@query
def apply_plan(spark: SparkSession, d: str) -> DataFrame:
    added = manifest.entries(frames.supplier_results(spark, d), "/data", "parquet", frames.manifest_targets(spark, d))
    listed = manifest.merge_add(frames.known_manifest(spark, d), added)
    columns = F.explode(F.array(
        F.struct(F.lit(1).alias("ordinal"), F.lit("id").alias("name"), F.lit("int").alias("type")),
        F.struct(F.lit(2).alias("ordinal"), F.lit("total").alias("name"), F.lit("money").alias("type")),
    ))
    nation = F.col("s_nationkey")
    history = frames.table(spark, d, "supplier").where(nation != 7).select(
        F.concat(F.lit("db"), nation % 5).alias("database"), F.lit("sales").alias("schema_name"),
        F.col("s_name").alias("table_name"), columns.alias("c"),
    ).select(*manifest.KEYS, "c.*", F.lit(None).cast("int").alias("precision"), F.lit(None).cast("int").alias("scale"))
    plan = manifest.apply_plan(listed, history)
    described = F.array_join(F.transform("columns", lambda c: F.concat_ws(":", c["name"], c["type"])), ",")
    return _flat(plan).withColumn("columns", described)


# ---- runs and reports ------------------------------------------------------------------------------


@query
def sync_log_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = frames.sync_log_rows(spark, d)
    stamps = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("run_started_at", "run_completed_at")}
    return rows.withColumns(stamps | {"sync_date": F.col("sync_date").cast("string")})


@query
def run_status(spark: SparkSession, d: str) -> DataFrame:
    return runlog.run_status(frames.sync_results(spark, d))


@query
def run_totals(spark: SparkSession, d: str) -> DataFrame:
    return runlog.run_totals(frames.sync_results(spark, d))


@query
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return runlog.run_summary(frames.sync_results(spark, d))


@query
def gateway_parsed(spark: SparkSession, d: str) -> DataFrame:
    parsed = metrics.gateway_parsed(frames.gateway_log(spark, d))
    rows = F.get_json_object("stream_progress_raw", "$.rows")
    return parsed.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).withColumn("stream_progress_raw", rows)


@query
def pipeline_parsed(spark: SparkSession, d: str) -> DataFrame:
    parsed = metrics.pipeline_parsed(frames.sync_log_rows(spark, d))
    stamps = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("run_started_at", "run_completed_at")}
    return parsed.withColumns(stamps | {"sync_date": F.col("sync_date").cast("string")})


def _unified(spark: SparkSession, d: str) -> DataFrame:
    """The unified view over the gateway log and a sync log derived once, since the view reads it twice."""
    folder = shared_folder(spark, "sync_log")
    log = frames.sync_log_rows(spark, d)
    log.hint("rebalance").write.parquet(folder)
    return metrics.unified_metrics(frames.gateway_log(spark, d), metrics.pipeline_parsed(spark.read.schema(log.schema).parquet(folder)))


def _shown(unified: DataFrame) -> DataFrame:
    stamps = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("gateway_timestamp", "run_started_at", "run_completed_at")}
    return rounded(unified, "rows_per_second", "timing_variance_seconds").withColumns(stamps)


@query
def unified_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _shown(metrics.newest_first(_unified(spark, d)))


@query
def recent_window(spark: SparkSession, d: str) -> DataFrame:
    """The last week up to the newest event."""
    newest = frames.table(spark, d, "events").agg(F.max("ts").cast("timestamp"))
    return _shown(metrics.recent(_unified(spark, d), newest.scalar()))


@query
def q1_timing_variance(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.timing_variance(_unified(spark, d)), "timing_variance_seconds")


@query
def q2_cpu_outliers(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.cpu_outliers(_unified(spark, d)), "avg_cpu_ms", "avg_rows", "cpu_ms_per_row")


@query
def q3_incomplete_runs(spark: SparkSession, d: str) -> DataFrame:
    return metrics.incomplete_runs(_unified(spark, d))


@query
def q4_throughput(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.throughput(_unified(spark, d)), "avg_rows", "avg_duration", "avg_throughput_rps", "peak_throughput_rps")


@query
def q5_background_ops(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.background_operations(_unified(spark, d)), "avg_duration_ms")


@query
def metrics_summary(spark: SparkSession, d: str) -> DataFrame:
    return _shown_summary(metrics.metrics_summary(_unified(spark, d)))


@query
def metrics_summary_refreshed(spark: SparkSession, d: str) -> DataFrame:
    """The same summary, from a log that lands in three goes, each of which refreshes the days that are due."""
    folder, gateway = shared_folder(spark, "refreshed"), frames.gateway_log(spark, d)
    rows = frames.sync_log_rows(spark, d)
    summary = RefreshedSummary(spark, f"{folder}/summary")
    days = sorted(r[0] for r in rows.select("sync_date").distinct().collect())
    ends = [days[len(days) // 3], days[2 * len(days) // 3], days[-1]]
    for first, last in zip([None, *ends], ends):
        date = F.col("sync_date")
        write_sync_log(rows.where((date <= last) if first is None else (date > first) & (date <= last)), f"{folder}/log")
        summary.refresh(gateway, sync_log(spark, f"{folder}/log"))
    return _shown_summary(summary.read())


def _shown_summary(summary: DataFrame) -> DataFrame:
    doubles = [f.name for f in summary.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return rounded(summary, *doubles).withColumn("sync_date", F.date_format("sync_date", "yyyy-MM-dd"))


def registry() -> dict[str, Query]:
    """Queries by key; a trailing underscore only tells a query from the operator it shows."""
    return {name.rstrip("_"): run for name, run in REGISTRY.items()}
