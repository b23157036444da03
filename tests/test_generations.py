"""Tables folded again after a type change, and payloads read by the schema they were written under."""

from __future__ import annotations

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.identity import uoid_of
from tidemark.operators.apply import rules
from tidemark.operators.envelope import decode_generations, schema_registry, schema_version, to_envelope
from tidemark.operators.sinks import write_landing
from tidemark.operators.widening import UnsupportedTypeChange
from tidemark.streaming.bronze import start_bronze
from tidemark.streaming.generations import Generations
from tidemark.streaming.silver import SilverTable

UOID = uoid_of("db", "dbo", "t")


def payload(kind):
    return T.StructType().add("id", "integer").add("v", kind)


@pytest.mark.parametrize("scd_type", [1, 2])
def test_a_refused_type_folds_the_table_again(spark, folder, monkeypatch, scd_type):
    registry = {}

    def land(changes, kind):
        frame = spark.createDataFrame(changes, "SYS_CHANGE_VERSION bigint, SYS_CHANGE_OPERATION string, id int, v string").withColumn("v", F.col("v").cast(kind))
        registry[frame.select(schema_version(frame)).first()[0]] = payload(kind)
        write_landing(to_envelope(frame, "db", "dbo", "t", extracted_at_ms=1), f"{folder}/landing", "2024-01-01")
        start_bronze(spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/cp_bronze").awaitTermination()

    def table(kind):
        return Generations(spark, f"{folder}/silver", payload(kind), rules("id"), scd_type, buckets=2, registry=registry)

    def apply(kind):
        return table(kind).apply(f"{folder}/bronze", UOID, f"{folder}/cp")

    def shown(df):
        return [tuple(map(str, r)) for r in rows(df.select("id", "v"))]

    land([(1, "I", 1, "1.50"), (2, "I", 2, "2.25")], "decimal(8,2)")
    assert apply("decimal(8,2)") == 0
    land([(3, "U", 1, "n/a")], "string")
    with pytest.raises(UnsupportedTypeChange):
        table("string").current()
    before = shown(table("decimal(8,2)").read())
    # Cut short before it is put in force: readers stay with the old table.
    with monkeypatch.context() as patch:
        patch.setattr(Generations, "put_in_force", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            apply("string")
    assert shown(table("decimal(8,2)").read()) == before and table("string").in_force() == 0
    assert apply("string") == 1
    latest = [("1", "n/a"), ("2", "2.25")]
    assert shown(table("string").read()) == (latest if scd_type == 1 else [("1", "1.50"), *latest])
    land([(4, "D", 2, None)], "string")
    assert apply("string") == 1
    current = table("string").read()
    assert shown(current if scd_type == 1 else current.where("__end_at IS NULL")) == [("1", "n/a")]


def test_payloads_are_read_by_their_own_schema(spark):
    day = datetime.date(2024, 5, 6)
    old = spark.createDataFrame([(1, "I", 1, day, bytearray(b"\1\2"), "x")], "SYS_CHANGE_VERSION bigint, SYS_CHANGE_OPERATION string, id int, at date, b binary, gone string")
    new = spark.createDataFrame([(2, "U", 2, datetime.datetime(2024, 5, 6, 7), "AQI=", 1.5)], "SYS_CHANGE_VERSION bigint, SYS_CHANGE_OPERATION string, id bigint, at timestamp_ntz, b string, more double")
    bronze = to_envelope(old, "db", "dbo", "t", extracted_at_ms=1).unionByName(to_envelope(new, "db", "dbo", "t", extracted_at_ms=2))
    other = bronze.where("operation = 'UPDATE'").withColumn("schemaVersion", F.lit(-1).cast("bigint"))  # of no known version
    versions = [df.select(schema_version(df)).first()[0] for df in (old, new)]
    listed = [("id", "int"), ("at", "date"), ("b", "varbinary"), ("gone", "nvarchar")], [("id", "bigint"), ("at", "datetime2"), ("b", "nvarchar"), ("more", "float")]
    history = [(v, i, n, t, None, None) for v, columns in zip(versions, listed) for i, (n, t) in enumerate(columns)]
    registry = schema_registry(spark.createDataFrame(history, "schema_version bigint, ordinal int, name string, type string, precision int, scale int"))
    assert registry[versions[0]].names == ["id", "at", "b", "gone"] and len(registry) == 2
    target = T.StructType().add("id", "long").add("at", "timestamp_ntz").add("b", "string").add("more", "double")
    got = decode_generations(bronze.unionByName(other), registry, target, tie_break=True).orderBy("_seq_num", "_extracted_at").collect()
    first, second = got[0], got[1]
    assert (first.id, first.at, first.b, first.more, first["_extracted_at"]) == (1, datetime.datetime(2024, 5, 6), "\1\2", None, 1)
    assert (second.id, second.at, second.b, second.more) == (2, datetime.datetime(2024, 5, 6, 7), "AQI=", 1.5)
    assert tuple(got[2]) == tuple(second)
    assert decode_generations(bronze, {}, target).count() == 2


def test_a_table_of_the_first_generation_is_an_ordinary_one(spark, folder):
    SilverTable(spark, folder, payload("string"), rules("id"), 1, buckets=2).apply_batch(
        to_envelope(spark.createDataFrame([(1, "I", 1, "x")], "SYS_CHANGE_VERSION bigint, SYS_CHANGE_OPERATION string, id int, v string"), "db", "dbo", "t", extracted_at_ms=1), 0
    )
    assert rows(Generations(spark, folder, payload("string"), rules("id"), buckets=2).read()) == [(1, "x")]
