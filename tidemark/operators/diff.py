"""Row changes between two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import column


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inserts, deletes and updates (before and after image) that lead from ``old`` to ``new``.

    Keys are unique on both sides, so the full outer join has no heavy groups.
    """
    columns = new.columns
    before, after = old.select(*[column(c) for c in columns]), new
    on = [column(k, "o") == column(k, "n") for k in keys]
    joined = before.withColumn("_in_old", F.lit(True)).alias("o").join(
        after.withColumn("_in_new", F.lit(True)).alias("n"), on, "full"
    )
    image = {side: F.struct(*[column(c, side).alias(c) for c in columns]) for side in "on"}

    def change(kind: str, side: str):
        return F.struct(F.lit(kind).alias("_change_type"), image[side].alias("row"))

    payload = [c for c in columns if c not in keys]
    differs = F.lit(False)
    for name in payload:
        differs = differs | ~column(name, "o").eqNullSafe(column(name, "n"))
    changes = (
        F.when(F.col("_in_old").isNull(), F.array(change("insert", "n")))
        .when(F.col("_in_new").isNull(), F.array(change("delete", "o")))
        .when(differs, F.array(change("update_preimage", "o"), change("update_postimage", "n")))
    )
    return joined.select(F.explode(changes).alias("c")).select("c._change_type", "c.row.*")
