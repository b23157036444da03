"""Schema history: one row per table and column, columns are added but never removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HISTORY_FIELDS = (
    "table_name string, ordinal int, name string, type string, precision int, scale int,"
    " previous_type string, last_seen timestamp, schema_version bigint"
)
KEYS = ("table_name", "name")


def _side_by_side(history: DataFrame, incoming: DataFrame) -> DataFrame:
    old = history.withColumn("_in_old", F.lit(True)).alias("o")
    new = incoming.withColumn("_in_new", F.lit(True)).alias("n")
    return old.join(new, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in KEYS], "full")


def _either(column: str) -> Column:
    return F.coalesce(F.col(f"n.{column}"), F.col(f"o.{column}"))


def schema_diff(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """Columns that were added, removed or changed their type, for tables that have a history."""
    known = history.select("table_name").distinct()
    joined = _side_by_side(history, incoming.join(known, "table_name", "left_semi"))
    kind = (
        F.when(F.col("_in_old").isNull(), "added")
        .when(F.col("_in_new").isNull(), "removed")
        .when(~F.col("o.type").eqNullSafe(F.col("n.type")), "type_changed")
    )
    return joined.select(
        _either("table_name").alias("table_name"),
        _either("name").alias("name"),
        kind.alias("change"),
        F.col("o.type").alias("old_type"),
        F.col("n.type").alias("new_type"),
    ).where(F.col("change").isNotNull())


def schema_status(history: DataFrame, incoming: DataFrame, versions: DataFrame) -> DataFrame:
    """Per incoming table: whether its columns changed, and whether only the fingerprint drifted.

    ``versions`` has ``table_name`` and the incoming ``schema_version``.
    """
    changes = schema_diff(history, incoming).groupBy("table_name").agg(F.count("*").alias("changed_columns"))
    stored = history.groupBy("table_name").agg(F.max("schema_version").alias("_stored"))
    joined = versions.join(stored, "table_name", "left").join(changes, "table_name", "left")
    changed = F.coalesce("changed_columns", F.lit(0)) > 0
    return joined.select(
        "table_name",
        F.coalesce("changed_columns", F.lit(0)).alias("changed_columns"),
        changed.alias("schema_changed"),
        (~changed & F.col("_stored").isNotNull() & (F.col("_stored") != F.col("schema_version"))).alias("drifted"),
    )


def merge_schema(history: DataFrame, incoming: DataFrame, versions: DataFrame, seen_at: Column) -> DataFrame:
    """History after an incoming column set.

    New columns are appended, missing ones kept. A changed type replaces the old one, which is remembered,
    and takes the new precision and scale; an unchanged one takes new values that are not NULL. Nothing of a
    table moves, ``last_seen`` included, while neither its columns nor its version differ.
    """
    joined = _side_by_side(history, incoming)
    added, absent = F.col("_in_old").isNull(), F.col("_in_new").isNull()
    retyped = ~added & ~absent & F.col("o.type").isNotNull() & F.col("n.type").isNotNull() & (F.col("o.type") != F.col("n.type"))
    resized = F.lit(False)
    for size in ("precision", "scale"):
        resized = resized | (F.col(f"n.{size}").isNotNull() & ~F.col(f"n.{size}").eqNullSafe(F.col(f"o.{size}")))
    moved = ~absent & (added | retyped | resized | (F.col("o.type").isNull() & F.col("n.type").isNotNull()))

    def size(column: str) -> Column:
        new, old = F.col(f"n.{column}"), F.col(f"o.{column}")
        return F.when(retyped | added, new).otherwise(F.coalesce(new, old)).alias(column)

    merged = joined.select(
        _either("table_name").alias("table_name"),
        F.col("o.ordinal").alias("_kept_ordinal"),
        F.col("n.ordinal").alias("_new_ordinal"),
        _either("name").alias("name"),
        _either("type").alias("type"),
        size("precision"),
        size("scale"),
        F.when(retyped, F.col("o.type")).otherwise(F.col("o.previous_type")).alias("previous_type"),
        F.col("o.last_seen").alias("_last_seen"),
        F.col("o.schema_version").alias("_stored"),
        (~absent).alias("_present"),
        moved.alias("_moved"),
    )
    # One short list of columns per table; the tables, not their columns, are what there are many of.
    per_table = merged.groupBy("table_name").agg(
        F.bool_or("_moved").alias("_any_moved"),
        F.max("_stored").alias("_stored_version"),
        F.max("_kept_ordinal").alias("_last_ordinal"),
        F.array_sort(F.collect_list(F.when(F.col("_kept_ordinal").isNull(), F.col("_new_ordinal")))).alias("_appended"),
    )
    joined = merged.join(per_table, "table_name").join(versions, "table_name", "left")
    arrived = F.col("schema_version").isNotNull()
    touched = arrived & (F.col("_any_moved") | ~F.col("_stored_version").eqNullSafe(F.col("schema_version")))
    appended_at = F.coalesce("_last_ordinal", F.lit(0)) + F.array_position("_appended", F.col("_new_ordinal"))
    return joined.select(
        "table_name",
        F.coalesce("_kept_ordinal", appended_at.cast("int")).alias("ordinal"),
        "name", "type", "precision", "scale", "previous_type",
        F.when(touched & F.col("_present"), seen_at).otherwise(F.col("_last_seen")).alias("last_seen"),
        F.when(touched, F.col("schema_version")).otherwise(F.col("_stored_version")).alias("schema_version"),
    )
