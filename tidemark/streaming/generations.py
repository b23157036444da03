"""Silver tables that are folded again from bronze after a type change that stored rows cannot follow.

A generation is a silver table in a folder of its own, with a checkpoint of its own. The first one lies in the table's
folder itself. If a payload is refused, the next generation is folded from all of bronze beside the one in force and
then put in force by one small commit: readers see the old table until then and the new one after, never both. A fold
that is cut short goes on in the same folder from its own checkpoint.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.apply import ApplyRules
from tidemark.operators.widening import UnsupportedTypeChange
from tidemark.session import read_parquet
from tidemark.streaming.silver import BUCKETS, SilverTable, apply_stream

COMMITS = "generation int"


@dataclass(frozen=True)
class Generations:
    """A silver table through all its generations; ``payload`` may differ from one use to the next."""

    spark: SparkSession
    path: str
    payload: T.StructType
    how: ApplyRules
    scd_type: int = 1
    buckets: int = BUCKETS
    registry: Mapping[int, T.StructType] | None = None

    def in_force(self) -> int:
        """The generation readers see; 0 until another one has been committed."""
        commits = read_parquet(self.spark, COMMITS, f"{self.path}/generations")
        latest = None if commits is None else commits.agg(F.max("generation")).first()[0]
        return latest or 0

    def folder(self, generation: int) -> str:
        return f"{self.path}/generation-{generation}" if generation else self.path

    def table(self, generation: int) -> SilverTable:
        return SilverTable(self.spark, self.folder(generation), self.payload, self.how, self.scd_type, self.buckets, registry=self.registry)

    def current(self) -> SilverTable:
        """The table in force; refused if its rows cannot be read under the payload."""
        return self.table(self.in_force())

    def read(self) -> DataFrame:
        return self.current().read()

    def prepare(self) -> tuple[int, SilverTable]:
        """The generation to go on with: the one in force, or the next one if that refuses the payload."""
        generation = self.in_force()
        try:
            return generation, self.table(generation)
        except UnsupportedTypeChange:
            return generation + 1, self.table(generation + 1)

    def put_in_force(self, generation: int) -> None:
        """Makes a generation that has caught up the one readers see."""
        if generation != self.in_force():
            commit = self.spark.createDataFrame([(generation,)], COMMITS)
            commit.write.mode("overwrite").parquet(f"{self.path}/generations/commit={generation}")

    def apply(self, bronze: str, uoid: str, checkpoint: str) -> int:
        """Applies what is new in bronze; returns the generation in force afterwards.

        Under a payload that the table in force refuses, the next generation is folded from the whole of bronze first.
        """
        generation, table = self.prepare()
        apply_stream(self.spark, bronze, uoid, table, checkpoint + checkpoint_suffix(generation)).awaitTermination()
        self.put_in_force(generation)
        return generation


def checkpoint_suffix(generation: int) -> str:
    """What tells the checkpoint of a generation from that of the first one."""
    return f"-generation-{generation}" if generation else ""
