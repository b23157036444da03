"""A keyed table kept as Parquet folders, one per key bucket and batch.

A commit is a small Parquet folder that lists the folders in force; it is written last, so readers see
whole batches and a repeated batch replaces what it wrote before.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import column, read_parquet

SETTINGS = "buckets int, keys array<string>"
Parts = dict[int, list[int]]


class BucketedTable:
    """Rows by bucket; each bucket consists of the parts of one or more batches."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.buckets = tuple(keys), buckets

    def check_settings(self) -> None:
        """Remembers bucket count and keys with the first commit, and refuses to go on with others."""
        own = (self.buckets, list(self.keys))
        held = read_parquet(self.spark, SETTINGS, f"{self.path}/settings")
        first = None if held is None else held.first()
        if first is None:
            self.spark.createDataFrame([own], SETTINGS).write.mode("overwrite").parquet(f"{self.path}/settings")
        elif (first["buckets"], list(first["keys"])) != own:
            raise ValueError(f"{self.path} is kept in {first['buckets']} buckets by {list(first['keys'])}, not in {own[0]} by {own[1]}")

    def bucket(self) -> Column:
        """Bucket of a row, from its key."""
        return F.pmod(F.xxhash64(*[column(k) for k in self.keys]), F.lit(self.buckets)).cast("int").alias("bucket")

    def last_batch(self, before: int | None = None) -> int | None:
        """Number of the latest committed batch, or of the latest one earlier than ``before``."""
        commits = self._commits(before)
        return None if commits is None else commits.agg(F.max("batch")).first()[0]

    def parts(self, before: int | None = None) -> Parts:
        """Parts in force after the latest commit, or after the latest one earlier than ``before``."""
        latest = self.last_batch(before)
        found: Parts = {}
        if latest is not None:
            for row in self._commits(None).where((F.col("batch") == latest) & (F.col("bucket") >= 0)).collect():
                found.setdefault(row["bucket"], []).append(row["part"])
        return found

    def _commits(self, before: int | None) -> DataFrame | None:
        commits = read_parquet(self.spark, "bucket int, part bigint, batch bigint", f"{self.path}/commits")
        return commits if commits is None or before is None else commits.where(F.col("batch") < before)

    def read(self, parts: Parts, buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of the given parts, optionally of some buckets only."""
        wanted = parts if buckets is None else {b: parts[b] for b in buckets if b in parts}
        folders = [f"{self.path}/rows/batch={p}/bucket={b}" for b, ps in wanted.items() for p in ps]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def write(self, rows: DataFrame, batch: int) -> list[int]:
        """Writes the rows of a batch and tells which buckets they went to."""
        target = f"{self.path}/rows/batch={batch}"
        even = rows.withColumn("bucket", self.bucket()).hint("rebalance", F.col("bucket"))
        even.write.mode("overwrite").partitionBy("bucket").parquet(target)
        written = self.spark.read.schema(T.StructType([*self.schema.fields]).add("bucket", "integer")).parquet(target)
        return [r["bucket"] for r in written.select("bucket").distinct().collect()]

    def commit(self, parts: Parts, batch: int) -> None:
        """Makes ``parts`` the table; an empty table is one row of bucket -1."""
        listed = [(b, p) for b, ps in parts.items() for p in ps] or [(-1, -1)]
        pointers = self.spark.createDataFrame(listed, "bucket int, part bigint")
        pointers.write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")


def appended(parts: Parts, buckets: Iterable[int], batch: int) -> Parts:
    """Parts after ``batch`` added rows to some buckets."""
    after = {b: list(ps) for b, ps in parts.items()}
    for bucket in buckets:
        after.setdefault(bucket, []).append(batch)
    return after


def crowded(parts: Parts, limit: int) -> list[int]:
    """Buckets made of more than ``limit`` parts."""
    return [b for b, ps in parts.items() if len(ps) > limit]
