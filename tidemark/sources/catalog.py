"""Source catalog: names, keys and columns of tables, kept as control tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.identity import fingerprint, qualified_name
from tidemark.functions.types import source_type
from tidemark.sources.feed import CHANGE_COLUMNS

COLUMN_FIELDS = "ordinal int, name string, type string, precision int, scale int"


def describe_columns(schema: T.StructType) -> list[dict]:
    """Columns of a DataFrame schema in order, without the change columns."""
    described = []
    for field in schema.fields:
        if field.name in CHANGE_COLUMNS:
            continue
        column = {"name": field.name, "type": source_type(field.dataType)}
        if isinstance(field.dataType, T.DecimalType):
            column |= {"precision": field.dataType.precision, "scale": field.dataType.scale}
        described.append({"ordinal": len(described) + 1, **column})
    return described


def column_metadata(information_schema: DataFrame) -> DataFrame:
    """Column rows of each table from ``INFORMATION_SCHEMA.COLUMNS``-shaped input.

    Scale counts only where a precision is given; change columns are left out.
    """
    return information_schema.where(~F.col("column_name").isin(*CHANGE_COLUMNS)).select(
        F.concat_ws(".", "table_schema", "table_name").alias("table_name"),
        F.col("ordinal_position").cast("int").alias("ordinal"),
        F.col("column_name").alias("name"),
        F.col("data_type").alias("type"),
        F.col("numeric_precision").cast("int").alias("precision"),
        F.when(F.col("numeric_precision").isNotNull(), F.col("numeric_scale")).cast("int").alias("scale"),
    )


def schema_fingerprint(columns: DataFrame, table: str = "table_name") -> DataFrame:
    """One fingerprint per table over its ``name:type`` list in column order.

    The collected list is as long as the table is wide, which the source limits.
    """
    data_columns = columns.where(~F.col("name").isin(*CHANGE_COLUMNS))
    listed = data_columns.groupBy(table).agg(F.sort_array(F.collect_list(F.struct("ordinal", "name", "type"))).alias("c"))
    signature = F.array_join(F.transform("c", lambda c: F.concat(c["name"], F.lit(":"), c["type"])), "|")
    return listed.select(table, fingerprint(signature).alias("schema_version"))


def primary_key_map(indexes: DataFrame, index_columns: DataFrame, columns: DataFrame) -> DataFrame:
    """Ordered key columns of every table: indexes, their columns and the column names joined.

    A key has as many columns as the source allows in one index, so the lists stay short.
    """
    joined = (
        indexes.where("is_primary_key")
        .join(index_columns, ["table_name", "index_id"])
        .join(columns.select("table_name", "column_id", "name"), ["table_name", "column_id"])
    )
    listed = joined.groupBy("table_name").agg(F.sort_array(F.collect_list(F.struct("key_ordinal", "name"))).alias("k"))
    return listed.select("table_name", F.transform("k", lambda k: k["name"]).alias("primary_key"))


def resolve_tables(configured: DataFrame, tracked: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Tracked name of each configured table, matched without regard to case.

    Tables that are not tracked come back with status ``error`` and no resolved name.
    """
    wanted = configured.withColumn("_name", qualified_name(F.col("table_name")))
    known = tracked.select(F.lower("table_name").alias("_name"), F.col("table_name").alias("resolved_name"))
    return wanted.join(known, "_name", "left").select(
        F.col("table_name").alias("configured_name"),
        "resolved_name",
        F.when(F.col("resolved_name").isNull(), "error").otherwise("ok").alias("status"),
        *carry,
    )
