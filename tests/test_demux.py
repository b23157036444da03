"""Many tables through one stream: folded like one by one, fenced by reloads, read through their own partition."""

from __future__ import annotations

import random

import brute_force
import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.identity import uoid_of
from tidemark.operators.apply import rules
from tidemark.operators.envelope import ENVELOPE_SCHEMA, from_envelope, reload_barrier, to_envelope
from tidemark.streaming.demux import DemuxedLake, DemuxTable, typed
from tidemark.streaming.silver import SilverTable

CODES = {"LOAD": "L", "INSERT": "I", "UPDATE": "U", "DELETE": "D"}
PAYLOAD = T.StructType().add("key", "integer").add("a", "string").add("b", "integer")


def envelopes(spark, events, table="t", at=1):
    changes = [(seq, CODES[op], key, a, b) for key, seq, op, a, b in events]
    fields = "SYS_CHANGE_VERSION bigint, SYS_CHANGE_OPERATION string, key int, a string, b int"
    return to_envelope(spark.createDataFrame(changes, fields), "db", "dbo", table, extracted_at_ms=at).withColumn("_uoid", F.col("table_id.uoid"))


def fenced(spark, table, version, at):
    return reload_barrier(spark, "db", "dbo", table, version, at).withColumn("_uoid", F.col("table_id.uoid"))


def test_tables_fold_like_one_by_one(spark, folder):
    rng = random.Random(6)
    tables = {name: brute_force.random_events(rng, n=40) for name in ("t1", "t2", "t3")}
    known = [DemuxTable(uoid_of("db", "dbo", name), ("key",), PAYLOAD, soft_delete=name == "t3") for name in tables]
    lake = DemuxedLake(spark, folder, known, parts=2)
    for batch in range(4):
        own = [envelopes(spark, rng.sample(events, 5) + events[batch::4], name) for name, events in tables.items()]
        own.append(envelopes(spark, [(1, 1, "INSERT", "x", 1)], "unknown"))
        together = own[0].unionByName(own[1]).unionByName(own[2]).unionByName(own[3])
        lake.apply_batch(together, batch)
        lake.apply_batch(together.limit(0), batch)  # repeated: passed over
    for name, events in tables.items():
        soft = name == "t3"
        names = ["key", "a", "b"] + ["_is_deleted"] * soft
        assert rows(lake.read(uoid_of("db", "dbo", name)).select(*names)) == brute_force.scd1(events, soft)
    plan = lake.read(uoid_of("db", "dbo", "t1"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_uoid" in plan
    assert len(lake.in_force()[1]) <= 2 and lake.rejected().count() == 0


def test_malformed_events_are_kept_apart(spark, folder):
    row = lambda data, seq: (data, ("db", "dbo", "t", uoid_of("db", "dbo", "t")), (None, str(seq), str(seq), None), 1, "INSERT", None)
    data = ['{"key":1,"a":"x","b":2}', '{"key":2,"a"', None, '{"key":null,"a":"y"}', '{"a":"z"}', "[1]", '{"key":3,"a":"","b":null}']
    bronze = spark.createDataFrame([row(x, i) for i, x in enumerate(data)], ENVELOPE_SCHEMA).withColumn("_uoid", F.col("table_id.uoid"))
    uoid = uoid_of("db", "dbo", "t")
    lake = DemuxedLake(spark, f"{folder}/lake", [DemuxTable(uoid, ("key",), PAYLOAD)])
    lake.apply_batch(bronze, 0)
    silver = SilverTable(spark, f"{folder}/silver", PAYLOAD, rules("key"), 1, buckets=2)
    silver.apply_batch(bronze, 0)
    for read, rejected in ((lake.read(uoid), lake.rejected()), (silver.read(), silver.rejected())):
        assert rows(read) == [(1, "x", 2), (3, "", None)]
        assert dict(rejected.select("seq_num", "reason").collect()) == {1: "malformed payload", 2: "no payload", 3: "no key", 4: "no key", 5: rejected.where("seq_num = 5").first().reason}


@pytest.mark.parametrize("scd_type,soft", [(1, False), (1, True), (2, False)])
def test_a_reload_fences_off_what_was_before(spark, folder, scd_type, soft):
    uoid = uoid_of("db", "dbo", "t")
    lake = DemuxedLake(spark, f"{folder}/lake", [DemuxTable(uoid, ("key",), PAYLOAD, soft)])
    silver = SilverTable(spark, f"{folder}/silver", PAYLOAD, rules("key", soft_delete=soft), scd_type, buckets=2)
    goes = [
        envelopes(spark, [(1, 1, "INSERT", "x", 1), (2, 2, "INSERT", "y", 2), (3, 3, "INSERT", "z", 3)]),
        envelopes(spark, [(1, 5, "LOAD", None, 9)], at=20).unionByName(fenced(spark, "t", 5, 20)),
        envelopes(spark, [(2, 4, "UPDATE", "late", 8), (4, 2, "INSERT", "late", 7), (3, 6, "INSERT", None, 6)], at=30),
        fenced(spark, "t", 9, 40),  # the table is empty now
    ]
    wanted = [{1: ("x", 1), 2: ("y", 2), 3: ("z", 3)}, {1: (None, 9)}, {1: (None, 9), 3: (None, 6)}, {}]
    if soft:  # deleted rows keep their values
        wanted[1:] = [{1: ("x", 9)}, {1: ("x", 9), 3: ("z", 6)}, {}]
    for batch, (bronze, live) in enumerate(zip(goes, wanted)):
        lake.apply_batch(bronze, batch)
        silver.apply_batch(bronze, batch)
        tables = [silver.read()] + ([lake.read(uoid)] if scd_type == 1 else [])
        for table in tables:
            current = table.where("__end_at IS NULL") if scd_type == 2 else table
            current = current.where("NOT _is_deleted") if soft else current
            assert {r.key: (r.a, r.b) for r in current.collect()} == live
    if scd_type == 2:
        closed = {(r.key, r["__start_at"], r["__end_at"]) for r in silver.read().collect()}
        assert {(2, 2, 4), (2, 4, 5), (1, 1, 5), (1, 5, 9), (3, 3, 5), (3, 6, 9)} <= closed
    assert from_envelope(goes[3], PAYLOAD).count() == 0


def test_text_of_payloads_becomes_values(spark):
    row = spark.range(1).select(
        typed(F.lit("7"), T.LongType()).alias("n"), typed(F.lit("1.50"), T.DecimalType(8, 2)).alias("d"), typed(F.lit("x7"), T.IntegerType()).alias("bad"),
        typed(F.lit("2024-01-02T03:04:05.000000Z"), T.TimestampType()).cast("string").alias("t"), typed(F.lit("AQI="), T.BinaryType()).alias("b"),
        typed(F.lit('{"x":[1,2]}'), T.StructType().add("x", T.ArrayType(T.IntegerType()))).alias("s"), typed(F.lit("true"), T.BooleanType()).alias("y"),
    ).first()
    assert (row.n, str(row.d), row.bad, row.t, bytes(row.b), row.s.x, row.y) == (7, "1.50", None, "2024-01-02 03:04:05", b"\1\2", [1, 2], True)
