"""Bringing a stored table to a wider schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import widens


class UnsupportedTypeChange(ValueError):
    """A stored column cannot become the new type; the table has to be folded again from its feed."""


def widen(stored: DataFrame, target: T.StructType) -> DataFrame:
    """Casts stored columns to wider types and adds new ones as NULL; columns the target lacks are kept."""
    wanted = {f.name: f.dataType for f in target.fields}
    held = {f.name: f.dataType for f in stored.schema.fields}
    refused = [f"{c}: {held[c].simpleString()} -> {t.simpleString()}" for c, t in wanted.items() if c in held and not widens(held[c], t)]
    if refused:
        raise UnsupportedTypeChange("; ".join(refused))
    columns = [F.col(c).cast(wanted[c]).alias(c) if c in wanted else F.col(c) for c in stored.columns]
    added = [F.lit(None).cast(t).alias(c) for c, t in wanted.items() if c not in held]
    return stored.select(*columns, *added)


def union_widened(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored rows at the incoming schema together with the incoming ones."""
    return widen(stored, incoming.schema).unionByName(incoming, allowMissingColumns=True)
