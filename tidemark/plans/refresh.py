"""The daily summary kept up to date by refreshing only the days of the sync log that are new.

What is kept for a day are the partial sums from which the summary is finished, one row for each group and duration, so
that the exact median of a group can still be told. A refresh reads the log partitions of its days, and of those before
on which a run may have started that still goes on; what it finds for a day takes the place of what was kept for it.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.metrics import finish_summary, pipeline_parsed, summary_parts, unified_metrics
from tidemark.session import read_parquet

DAY = "sync_day"


def rows_by_day(log: DataFrame) -> dict[date, int]:
    """Rows of each day, of which there is one in many; only partition values and counts are read."""
    days = log.groupBy(F.col("sync_date").cast("date").alias("day")).count().where("day IS NOT NULL")
    return {r["day"]: r["count"] for r in days.collect()}


class RefreshedSummary:
    """Parts of the daily summary below one folder, by day."""

    def __init__(self, spark: SparkSession, path: str, run_days: int = 1) -> None:
        """``run_days`` is how many days beyond the first one a run may take."""
        self.spark, self.path, self.run_days = spark, path.rstrip("/"), run_days

    def _parts(self) -> DataFrame | None:
        stored = read_parquet(self.spark, f"{DAY} date", f"{self.path}/parts")
        return None if stored is None else self.spark.read.parquet(f"{self.path}/parts")

    def covered(self) -> dict[date, int]:
        """Days that have been summed up, with the rows their log had then."""
        noted = read_parquet(self.spark, "day date, rows bigint, refresh bigint", f"{self.path}/days")
        if noted is None:
            return {}
        latest = noted.groupBy("day").agg(F.max_by("rows", "refresh").alias("rows"))
        return {r.day: r.rows for r in latest.collect()}

    def due(self, log: DataFrame) -> list[date]:
        """Days whose log has grown since they were summed up, and covered ones on which their runs may go on."""
        covered, counts = self.covered(), rows_by_day(log)
        grown = {day for day, n in counts.items() if covered.get(day) != n}
        after = {day + timedelta(days=n) for day in grown for n in range(1, self.run_days + 1)}
        return sorted(grown | (after & covered.keys()))

    def refresh(self, gateway: DataFrame, log: DataFrame, days: Iterable[date] | None = None) -> list[date]:
        """Sums up the given days, or those due, anew; returns them.

        ``log`` is the sync log, partitioned by ``sync_date``; of ``gateway`` only events of these days are read, and of
        as many after them as a run may take.
        """
        chosen = self.due(log) if days is None else sorted(set(days))
        if not chosen:
            return []
        own = [d - timedelta(days=n) for d in chosen for n in range(self.run_days + 1)]
        results = log.where(F.col("sync_date").cast("date").isin(*own))
        first, last = F.lit(chosen[0]).cast("timestamp"), F.lit(chosen[-1] + timedelta(days=self.run_days + 1)).cast("timestamp")
        events = gateway.where((F.col("timestamp") >= first) & (F.col("timestamp") < last))
        parts = summary_parts(unified_metrics(events, pipeline_parsed(results))).withColumn(DAY, F.col("sync_date").cast("date"))
        parts = parts.where(F.col(DAY).isin(*chosen)).hint("rebalance", F.col(DAY))
        counts = rows_by_day(results)
        parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(f"{self.path}/parts")
        noted = [(day, counts.get(day, 0), time.time_ns()) for day in chosen]
        self.spark.createDataFrame(noted, "day date, rows bigint, refresh bigint").write.mode("append").parquet(f"{self.path}/days")
        return chosen

    def read(self) -> DataFrame:
        """The summary of all covered days."""
        parts = self._parts()
        if parts is None:
            raise ValueError(f"{self.path} has not been refreshed yet")
        return finish_summary(parts.drop(DAY))
