from __future__ import annotations

import base64
import json
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import partition_day
from tidemark.functions.identity import schema_part, table_part, table_uoid, uoid_of
from tidemark.functions.types import parse_schema, source_type, widens
from tidemark.operators.envelope import ENVELOPE_SCHEMA, from_envelope, schema_version, to_envelope
from tidemark.operators.widening import UnsupportedTypeChange, union_widened, widen
from tidemark.sources.catalog import describe_columns

CHANGES = "SYS_CHANGE_VERSION bigint, SYS_CHANGE_CREATION_VERSION bigint, SYS_CHANGE_OPERATION string"


def test_envelope_has_the_fixed_schema_and_codes(spark):
    changes = spark.createDataFrame(
        [(1, None, "L", 10), (2, None, "I", 20), (3, None, "U ", 30), (4, None, "D", 40), (5, None, "X", 50), (6, None, None, 60)],
        f"{CHANGES}, id int",
    )
    envelope = to_envelope(changes, "db1", "dbo", "t", "cat", 123)
    assert envelope.schema.simpleString() == ENVELOPE_SCHEMA.simpleString()
    got = envelope.orderBy("cursor.seqNum").collect()
    assert [r.operation for r in got] == ["LOAD", "INSERT", "UPDATE", "DELETE", "X", "UNKNOWN"]
    assert got[0].cursor.asDict() == {"lsn": None, "seqNum": "1", "sequence": "1", "timestamp": None}
    assert got[0].table_id.asDict() == {"catalog": "cat", "schema": "dbo", "name": "t", "uoid": uoid_of("db1", "dbo", "t")}
    assert json.loads(got[0].data) == {"id": 10}


def test_payload_keeps_nulls_and_encodes_binary(spark):
    changes = spark.createDataFrame([(1, None, "I", bytearray(b"\x00\x01\x02\xff"), None)], f"{CHANGES}, b binary, n string")
    row = to_envelope(changes, "d", "s", "t").first()
    assert json.loads(row.data) == {"b": base64.b64encode(b"\x00\x01\x02\xff").decode(), "n": None}
    back = from_envelope(to_envelope(changes, "d", "s", "t"), parse_schema([{"name": "b", "type": "varbinary"}, {"name": "n", "type": "int"}]))
    assert bytes(back.first().b) == b"\x00\x01\x02\xff" and back.first().n is None


def test_catalog_defaults_to_the_database_and_untyped_columns_become_bigint(spark):
    changes = spark.createDataFrame([(1, None, "I")], CHANGES).withColumn("n", F.lit(None))
    envelope = to_envelope(changes, "db", "s", "t")
    assert envelope.first().table_id.catalog == "db"
    assert envelope.first().schemaVersion == to_envelope(changes.withColumn("n", F.lit(None).cast("bigint")), "db", "s", "t").first().schemaVersion


@pytest.mark.parametrize("name", [("db", "dbo", "t"), ("a.b", "c", "d"), ("a", "b.c", "d"), ("ü", "ß", "表")])
def test_uoid_is_a_version_5_uuid(spark, name):
    got = spark.range(1).select(table_uoid(*[F.lit(n) for n in name])).first()[0]
    assert got == str(uuid.uuid5(uuid.NAMESPACE_DNS, "\x00".join(name))) == uoid_of(*name)


def test_fingerprint_depends_on_order_and_type_but_not_on_change_columns(spark):
    base = spark.createDataFrame([], "a int, b string")

    def version(df):
        return spark.range(1).select(schema_version(df)).first()[0]

    with_changes = spark.createDataFrame([], f"{CHANGES}, a int, b string")
    assert version(base) == version(with_changes) >= 0
    assert version(base) != version(base.select("b", "a")) != version(spark.createDataFrame([], "a bigint, b string"))


def test_decode_filters_by_table_and_survives_bad_payloads(spark):
    bronze = spark.createDataFrame(
        [
            ('{"id":1,"amount":"1.50","flag":true}', "u1", "7", "INSERT"),
            ('{"id":"x","amount":2.25}', "u1", "8", "DELETE"),
            ("not json", "u1", None, "UPDATE"),
            ('{"id":9}', "u2", "9", "INSERT"),
        ],
        "data string, _uoid string, seq string, operation string",
    ).select("data", "_uoid", F.struct(F.col("seq").alias("seqNum")).alias("cursor"), "operation")
    columns = [{"name": "id", "type": "int"}, {"name": "amount", "type": "decimal", "precision": 9, "scale": 2}, {"name": "flag", "type": "bit"}]
    got = from_envelope(bronze, parse_schema(columns), "u1", soft_delete=True)
    assert [(r._seq_num, r.operation, r._is_deleted, r.id, str(r.amount), r.flag) for r in got.orderBy(F.col("_seq_num").asc_nulls_last()).collect()] == [
        (7, "INSERT", False, 1, "1.50", True), (8, "DELETE", True, None, "2.25", None), (None, "UPDATE", False, None, "None", None),
    ]


@pytest.mark.parametrize(
    "source,expected",
    [
        ("int", T.IntegerType()), ("tinyint", T.ShortType()), ("bit", T.BooleanType()), ("float", T.DoubleType()),
        ("real", T.FloatType()), ("decimal", T.DecimalType(38, 10)), ("money", T.DecimalType(19, 4)),
        ("datetimeoffset", T.TimestampType()), ("date", T.DateType()), ("time", T.StringType()),
        ("rowversion", T.BinaryType()), ("uniqueidentifier", T.StringType()), ("geometry", T.BinaryType()), ("made_up", T.StringType()),
    ],
)
def test_type_map(source, expected):
    assert parse_schema([{"name": "c", "type": source}])["c"].dataType == expected


def test_precision_counts_for_decimals_only():
    schema = parse_schema([{"name": "a", "type": "numeric", "precision": 12}, {"name": "b", "type": "int", "precision": 10, "scale": 0}])
    assert [f.dataType for f in schema] == [T.DecimalType(12, 0), T.IntegerType()]


def test_columns_of_a_frame_are_described_in_source_types(spark):
    df = spark.createDataFrame([], f"{CHANGES}, id bigint, price decimal(9,2), name string, at timestamp")
    assert describe_columns(df.schema) == [
        {"ordinal": 1, "name": "id", "type": "bigint"},
        {"ordinal": 2, "name": "price", "type": "decimal", "precision": 9, "scale": 2},
        {"ordinal": 3, "name": "name", "type": "nvarchar"},
        {"ordinal": 4, "name": "at", "type": "datetime2"},
    ]
    assert source_type(T.ArrayType(T.IntegerType())) == "array<int>"


@pytest.mark.parametrize(
    "text,expected",
    [
        (None, "_unknown"), ("", "_unknown"), ("2025-02-25", "2025-02-25"), ("2025-02-25T10:00:00Z", "2025-02-25"),
        ("2025-02-25 23:30:00-05:00", "2025-02-25"), ("2025-02-25T23:30", "2025-02-25"), ("2025-02-25T23:30:00.123456", "2025-02-25"),
        ("2025-02-30T10:00:00", "_unknown"), ("2025-02-25T25:00", "_unknown"), ("not a date", "_unknown"), ("short", "_unknown"),
        ("unvalidated", "unvalidate"), ("20250225T101500", "2025-02-25"), ("20250225T101500+0100", "2025-02-25"),
    ],
)
def test_partition_day_of_text(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(partition_day(F.col("v"), T.StringType())).first()[0] == expected


def test_partition_day_of_dates(spark):
    df = spark.sql("SELECT timestamp'2025-02-25 23:59:59' AS t, date'2025-02-26' AS d, 5 AS n, cast(null AS date) AS x")
    days = [partition_day(F.col(f.name), f.dataType) for f in df.schema.fields]
    assert tuple(df.select(*days).first()) == ("2025-02-25", "2025-02-26", "_unknown", "_unknown")


@pytest.mark.parametrize("name,parts", [("dbo.t", ("dbo", "t")), ("t", ("dbo", "t")), ("a.b.c", ("a", "b.c")), (".x", ("", "x"))])
def test_table_names_split_on_the_first_dot(spark, name, parts):
    df = spark.createDataFrame([(name,)], "n string")
    assert tuple(df.select(schema_part(F.col("n")), table_part(F.col("n"))).first()) == parts


def test_widening(spark):
    stored = spark.createDataFrame([(1, 1.5, "x")], "id int, f float, gone string")
    target = T.StructType().add("id", "long").add("f", "double").add("fresh", "string")
    assert rows(widen(stored, target)) == [(1, 1.5, "x", None)]
    incoming = spark.createDataFrame([(2**40, 2.5, "new")], "id bigint, f double, fresh string")
    assert rows(union_widened(stored, incoming)) == [(1, 1.5, "x", None), (2**40, 2.5, None, "new")]
    with pytest.raises(UnsupportedTypeChange):
        widen(stored, T.StructType().add("id", "string"))
    assert widens(T.DecimalType(10, 2), T.DecimalType(12, 4)) and not widens(T.DecimalType(10, 2), T.DecimalType(10, 4))
    assert not widens(T.LongType(), T.IntegerType()) and widens(T.IntegerType(), T.DecimalType(10, 0))
