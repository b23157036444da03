"""Connected components of links, by large and small stars, and links inside cells of a partitioned space."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import shared_folder


# Lets Spark delete the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """The frame written to the folder all executors share, with ``options`` of the writer, and read again.

    Nothing reads the shuffle files of that write any more, so they go with it.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    before = spark.conf.get(FILE_CLEANUP, "false")
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(FILE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def smaller_first(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours of a node (larger ones, or smaller ones and itself) are linked with its least neighbour.

    ``edges`` has pairs ``a`` > ``b``. A node's least neighbour comes from an aggregation that combines on the map
    side, and the join that brings it to the links can be split where a node has many.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    linked = both.join(least, "a").where("b > a" if large else "b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return smaller_first(linked if large else linked.unionByName(least.select("a", F.col("least").alias("b"))))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node with a link.

    ``edges`` has two columns of one type, ``a`` and ``b``, in any order and with repeats. Ends when a round of both
    steps changes nothing; the number of rounds grows with the logarithm of the longest chain. Each round is written
    to the shared folder.
    """

    def state(links: DataFrame) -> tuple:
        return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    links = stored(smaller_first(edges.select("a", "b")), "links")
    last, now = None, state(links)
    while now != last:
        links = stored(star(star(links, large=True), large=False), "links")
        last, now = now, state(links)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def forest(left: np.ndarray, right: np.ndarray, size: int) -> list[int]:
    """Positions of links between 0..size-1 that join what was apart so far."""
    parent = list(range(size))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append(i)
    return kept


def spanning(matches: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Few links that connect as much as all of a visitor-by-home table of matches.

    First visitors with one home each, then homes that are linked through a visitor; at most as many as rows and
    columns of the table.
    """
    visitors = np.flatnonzero(matches.any(axis=1))
    first = matches[visitors].argmax(axis=1)
    row, home = np.nonzero(matches[visitors])
    pairs = np.unique(first[row] * matches.shape[1] + home)
    left, right = pairs // matches.shape[1], pairs % matches.shape[1]
    kept = forest(left, right, matches.shape[1])
    return (visitors, first), (left[kept], right[kept])
