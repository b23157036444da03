"""Reading tables and queries of a relational database in parallel ranges."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = 10_000


def read_jdbc(
    spark: SparkSession,
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    fetch_rows: int = FETCH_ROWS,
    snapshot_isolation: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table or query; with ``partition_column`` and its ``bounds`` it is read by ``partitions`` tasks."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_rows).options(**(options or {}))
    if snapshot_isolation:
        reader = reader.option("sessionInitStatement", "SET TRANSACTION ISOLATION LEVEL SNAPSHOT")
    if partition_column is None:
        return reader.option("dbtable" if table else "query", table or query).load()
    lower, upper = bounds or (None, None)
    if lower is None or upper is None:
        raise ValueError("a partitioned read needs the bounds of its partition column")
    ranged = {"partitionColumn": partition_column, "lowerBound": lower, "upperBound": upper, "numPartitions": partitions}
    return reader.option("dbtable", table or f"({query}) ranged").options(**ranged).load()


def column_bounds(spark: SparkSession, url: str, table: str, column: str, options: Mapping[str, str] | None = None):
    """Smallest and largest value of a column, asked of the database."""
    probe = f"SELECT MIN({column}) AS LOW, MAX({column}) AS HIGH FROM {table}"
    return tuple(read_jdbc(spark, url, query=probe, options=options).first())
