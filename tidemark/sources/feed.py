"""Reading full snapshots and changes since a version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import column, if_small, shared_folder

VERSION = "SYS_CHANGE_VERSION"
CREATION_VERSION = "SYS_CHANGE_CREATION_VERSION"
OPERATION = "SYS_CHANGE_OPERATION"
CHANGE_COLUMNS = (VERSION, CREATION_VERSION, OPERATION)


def full_load(table: DataFrame, version: int | Column) -> DataFrame:
    """Every row of a table as an ``L`` change at the current version."""
    version = version if isinstance(version, Column) else F.lit(version)
    return table.select(
        version.cast("bigint").alias(VERSION),
        F.lit(None).cast("bigint").alias(CREATION_VERSION),
        F.lit("L").alias(OPERATION),
        "*",
    )


def incremental_changes(
    feed: DataFrame, table: DataFrame, keys: Sequence[str], since: int, count_first: bool = True
) -> DataFrame:
    """Changes after ``since`` with the current row of each key.

    ``feed`` has the change columns and the keys, at most one row per key (see ``net_changes``).
    Keys of deleted rows come from the feed; their other columns are NULL. The changes are written to the
    shared folder and counted there first, unless told otherwise, so the feed is read once: with few of
    them, only the table rows they touch are shuffled.
    """
    if not keys:
        raise ValueError("an incremental read needs a primary key")
    lowered = {k.lower() for k in keys}
    on = [column(k, "ct") == column(k, "t") for k in keys]
    recent = feed.where(F.col(VERSION) > since).select(*CHANGE_COLUMNS, *[column(k) for k in keys])
    touched = None
    if count_first:
        path = shared_folder(feed.sparkSession, "recent-changes")
        recent.write.parquet(path)
        recent = feed.sparkSession.read.schema(recent.schema).parquet(path)
        touched = if_small(recent.select(*[column(k) for k in keys]))
    if touched is not None:
        table = table.alias("t").join(F.broadcast(touched).alias("ct"), on, "left_semi")
    columns = [
        F.coalesce(column(c, "t"), column(c, "ct")).alias(c) if c.lower() in lowered else column(c, "t").alias(c)
        for c in table.columns
    ]
    joined = recent.alias("ct").join(table.alias("t"), on, "left")
    return joined.select(*[F.col(f"ct.{c}") for c in CHANGE_COLUMNS], *columns)


def net_changes(log: DataFrame, keys: Sequence[str], since: int | None = None, creation: str = "last") -> DataFrame:
    """One row per key from a raw change log: the last change wins.

    A row inserted and then updated counts as inserted; one deleted last counts as deleted.
    The creation version is that of the ``last`` or ``first`` insert in range. One aggregation with
    partial results on the map side, so a key with many changes is no bottleneck.
    """
    if since is not None:
        log = log.where(F.col(VERSION) > since)
    operation, version = F.col(OPERATION), F.col(VERSION)
    pick = {"last": F.max, "first": F.min}[creation]
    folded = log.groupBy(*[column(k) for k in keys]).agg(
        F.max(version).alias("_last"),
        F.max(F.when(operation == "D", version)).alias("_deleted"),
        F.max(F.when(operation == "I", version)).alias("_inserted"),
        pick(F.when(operation == "I", version)).alias("_created"),
        F.max(F.when(operation == "L", version)).alias("_loaded"),
    )
    gone = F.col("_deleted") == F.col("_last")
    fresh = F.col("_inserted").isNotNull() & (F.col("_deleted").isNull() | (F.col("_inserted") > F.col("_deleted")))
    net = F.when(gone, "D").when(fresh, "I").when(F.col("_loaded") == F.col("_last"), "L").otherwise("U")
    return folded.select(
        F.col("_last").alias(VERSION), F.col("_created").alias(CREATION_VERSION), net.alias(OPERATION), *[column(k) for k in keys]
    )


def feed_bounds(feed: DataFrame, table: str = "table_name") -> DataFrame:
    """Lowest and highest version of every table, with the version of the whole feed."""
    per_table = feed.groupBy(table).agg(
        F.min(VERSION).alias("min_version"), F.max(VERSION).alias("max_version"), F.count("*").alias("change_count")
    )
    whole = per_table.agg(F.coalesce(F.max("max_version"), F.lit(0)).alias("db_version"))
    return per_table.withColumn("db_version", whole.scalar())


def current_version(feed: DataFrame) -> int:
    """Highest version of a feed; 0 for an empty one."""
    return feed.agg(F.coalesce(F.max(VERSION), F.lit(0))).first()[0]
