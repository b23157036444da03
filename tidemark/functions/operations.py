"""Change operation codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation codes of a change feed and their names in the envelope.
OPERATION_NAMES = {"L": "LOAD", "I": "INSERT", "U": "UPDATE", "D": "DELETE"}

# Operation of a reload barrier: what its table held before is gone, whether or not the reload has rows.
RELOAD = "RELOAD"

WHITESPACE = " \t\n\r\x0b\x0c"


def decode_operation(code: Column) -> Column:
    """Name of an operation code; unknown codes stay as they are, missing ones are ``UNKNOWN``."""
    bare = F.trim(code, F.lit(WHITESPACE))
    named = F.lit(None).cast("string")
    for short, name in OPERATION_NAMES.items():
        named = F.when(bare == short, F.lit(name)).otherwise(named)
    return F.when(code.isNull() | (code == ""), F.lit("UNKNOWN")).otherwise(F.coalesce(named, code))


def operation_rank(operation: Column) -> Column:
    """Order of operations that share a sequence number: load, insert, update, delete."""
    rank = F.lit(-1)
    for position, name in enumerate(OPERATION_NAMES.values()):
        rank = F.when(operation == name, F.lit(position)).otherwise(rank)
    return rank
