"""Change rows to uniform JSON envelopes and back."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.identity import fingerprint, table_uoid, uoid_of
from tidemark.functions.operations import RELOAD, decode_operation
from tidemark.functions.types import parse_schema
from tidemark.session import column
from tidemark.sources.feed import CHANGE_COLUMNS, OPERATION, VERSION

TABLE_ID = T.StructType().add("catalog", "string").add("schema", "string").add("name", "string").add("uoid", "string")
CURSOR = T.StructType().add("lsn", "string").add("seqNum", "string").add("sequence", "string").add("timestamp", "long")
ENVELOPE_SCHEMA = (
    T.StructType()
    .add("data", "string")
    .add("table_id", TABLE_ID)
    .add("cursor", CURSOR)
    .add("extractionTimestamp", "long")
    .add("operation", "string")
    .add("schemaVersion", "long")
)


# How timestamps stand in payloads, to the microsecond.
TIMESTAMP_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def type_null_columns(df: DataFrame) -> DataFrame:
    """Columns without a type, NULL in every row, become bigint."""
    untyped = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]
    columns = [column(c).cast("bigint").alias(c) if c in untyped else column(c) for c in df.columns]
    return df.select(*columns) if untyped else df


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in CHANGE_COLUMNS]


def schema_version(df: DataFrame) -> Column:
    """Fingerprint of the data columns of a DataFrame, from their names and Spark types."""
    parts = [f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields if f.name not in CHANGE_COLUMNS]
    return fingerprint(F.lit("|".join(parts)))


def to_envelope(
    changes: DataFrame,
    database: str | Column,
    schema: str | Column,
    table: str | Column,
    catalog: str | Column | None = None,
    extracted_at_ms: int | Column | None = None,
) -> DataFrame:
    """Change rows as envelopes: data columns as JSON text with NULLs kept, the rest in fixed fields."""
    changes = type_null_columns(changes)
    database, schema, table = (p if isinstance(p, Column) else F.lit(p) for p in (database, schema, table))
    catalog = database if catalog is None else catalog if isinstance(catalog, Column) else F.lit(catalog)
    if extracted_at_ms is None:
        extracted_at_ms = int(time.time() * 1000)
    extracted = extracted_at_ms if isinstance(extracted_at_ms, Column) else F.lit(extracted_at_ms)
    null_text = F.lit(None).cast("string")
    version = F.col(VERSION).cast("string") if VERSION in changes.columns else null_text
    operation = decode_operation(F.col(OPERATION)) if OPERATION in changes.columns else F.lit("UNKNOWN")
    payload = F.to_json(F.struct(*[column(c) for c in data_columns(changes)]), {"ignoreNullFields": "false", **TIMESTAMP_FORMATS})
    return changes.select(
        payload.alias("data"),
        F.struct(
            catalog.alias("catalog"),
            schema.alias("schema"),
            table.alias("name"),
            table_uoid(database, schema, table).alias("uoid"),
        ).alias("table_id"),
        F.struct(
            null_text.alias("lsn"),
            version.alias("seqNum"),
            version.alias("sequence"),
            F.lit(None).cast("bigint").alias("timestamp"),
        ).alias("cursor"),
        extracted.cast("bigint").alias("extractionTimestamp"),
        operation.alias("operation"),
        schema_version(changes).alias("schemaVersion"),
    )


def reload_barrier(spark: SparkSession, database: str, schema: str, table: str, version: int, extracted_at_ms: int, catalog: str | None = None) -> DataFrame:
    """One envelope without a payload that goes ahead of a table's full reload, also of an empty one."""
    row = (None, (catalog or database, schema, table, uoid_of(database, schema, table)), (None, str(version), str(version), None), extracted_at_ms, RELOAD, None)
    return spark.createDataFrame([row], ENVELOPE_SCHEMA)


def from_envelope(
    bronze: DataFrame, payload: T.StructType, uoid: str | None = None, soft_delete: bool = False, tie_break: bool = False
) -> DataFrame:
    """Typed change events of one table; reload barriers are no events.

    ``uoid`` filters on the ``_uoid`` partition where the bronze table has one. ``tie_break`` adds the
    extraction time, which orders events that share a sequence number.
    """
    if uoid is not None:
        key = "_uoid" if "_uoid" in bronze.columns else "table_id.uoid"
        bronze = bronze.where(F.col(key) == uoid)
    bronze = bronze.where(~F.col("operation").eqNullSafe(RELOAD))
    lead = [F.expr("try_cast(cursor.seqNum as bigint)").alias("_seq_num"), F.col("operation")]
    if tie_break:
        lead.append(F.col("extractionTimestamp").alias("_extracted_at"))
    if soft_delete:
        lead.append(deleted_flag().alias("_is_deleted"))
    return bronze.select(*lead, F.from_json("data", payload).alias("parsed")).select(
        *[c for c in ("_seq_num", "operation") + ("_extracted_at",) * tie_break + ("_is_deleted",) * soft_delete],
        "parsed.*",
    )


def schema_registry(columns: DataFrame) -> dict[int, T.StructType]:
    """The columns of each schema version of a table, from rows as the schema history keeps them.

    ``columns`` has ``schema_version``, ``ordinal``, ``name``, ``type``, ``precision`` and ``scale``. A table has as many
    versions as it has had changes of its schema, and each as many columns as its source allows.
    """
    listed: dict[int, list] = {}
    for row in columns.select("schema_version", "ordinal", "name", "type", "precision", "scale").collect():
        listed.setdefault(row["schema_version"], []).append(row.asDict())
    return {version: parse_schema(sorted(own, key=lambda c: c["ordinal"])) for version, own in listed.items()}


def conformed(value: Column, schema: T.StructType, target: T.StructType) -> Column:
    """A parsed payload of one schema as one of another: columns by name, cast to the target's types, absent ones NULL."""
    known = {f.name.lower(): f.name for f in schema}

    def as_target(field: T.StructField) -> Column:
        name = known.get(field.name.lower())
        own = F.lit(None) if name is None else value.getField(name)
        return own.try_cast(field.dataType) if isinstance(field.dataType, T.AtomicType) else own.cast(field.dataType)

    return F.struct(*[as_target(f).alias(f.name) for f in target])


def decode_generations(bronze: DataFrame, registry: Mapping[int, T.StructType], target: T.StructType, tie_break: bool = False) -> DataFrame:
    """Typed events of one table whose schema has changed: each payload is parsed by the schema it was written under.

    ``registry`` has the schema of each ``schemaVersion``; what it does not list is parsed by ``target``. Every payload is
    parsed once, and its values are cast to the target's types. Reload barriers are no events.
    """
    version, choice = F.col("schemaVersion"), None
    for number, schema in registry.items():
        own = conformed(F.from_json("data", schema), schema, target)
        choice = F.when(version == number, own) if choice is None else choice.when(version == number, own)
    plain = conformed(F.from_json("data", target), target, target)
    parsed = plain if choice is None else choice.otherwise(plain)
    rows = bronze.where(~F.col("operation").eqNullSafe(RELOAD)).select(
        F.expr("try_cast(cursor.seqNum as bigint)").alias("_seq_num"), "operation", F.col("extractionTimestamp").alias("_extracted_at"), parsed.alias("parsed"),
    )
    return rows.select("_seq_num", "operation", *(["_extracted_at"] if tie_break else []), "parsed.*")


CORRUPT = "__corrupt"


def parse_envelope(bronze: DataFrame, payload: T.StructType, keys: Sequence[str], registry: Mapping[int, T.StructType] | None = None) -> DataFrame:
    """Envelopes of one table parsed once: typed columns, and why an envelope is no event, if so.

    Envelopes of a schema version in ``registry`` are parsed by that schema and cast to ``payload``.

    ``_reason`` is ``no payload``, ``malformed payload`` (no JSON, or a value that is not of its column's type) or
    ``no key``; ``_data`` has the payload of these. Reload barriers have neither.
    """
    target = T.StructType([*payload.fields, T.StructField(CORRUPT, T.StringType())])
    how = {"columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json("data", target, how)
    for version, schema in (registry or {}).items():
        own = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        parsed = F.when(F.col("schemaVersion") == version, conformed(F.from_json("data", own, how), own, target)).otherwise(parsed)
    rows = bronze.select(
        F.expr("try_cast(cursor.seqNum as bigint)").alias("_seq_num"), "operation", F.col("extractionTimestamp").alias("_extracted_at"),
        "data", parsed.alias("parsed"),
    )
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col("parsed").getField(key).isNull()
    broken = (
        F.when(F.col("data").isNull(), "no payload")
        .when(F.col("parsed").isNull() | F.col(f"parsed.{CORRUPT}").isNotNull(), "malformed payload")
        .when(no_key, "no key")
    )
    rows = rows.withColumn("_reason", F.when(~F.col("operation").eqNullSafe(RELOAD), broken))
    columns = [F.col("parsed").getField(f.name).alias(f.name) for f in payload]
    return rows.select("_seq_num", "operation", "_extracted_at", *columns, "_reason", F.when(F.col("_reason").isNotNull(), F.col("data")).alias("_data"))


def deleted_flag() -> Column:
    """True for delete events, false for all others."""
    return F.when(F.col("operation") == "DELETE", True).otherwise(False)


def with_table_partition(envelopes: DataFrame) -> DataFrame:
    """Adds the column bronze is partitioned by."""
    return envelopes.withColumn("_uoid", F.col("table_id.uoid"))
