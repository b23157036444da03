"""Day of a value, for day-partitioned output."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN_DAY = "_unknown"

# ISO 8601 date and time, in the extended and the basic spelling, with an optional offset.
_OFFSET = r"(Z|[+-]\d{2}(:?\d{2}(:?\d{2}(\.\d+)?)?)?)?"
_TIME = r"([01]\d|2[0-3])(:?[0-5]\d(:?[0-5]\d([.,]\d+)?)?)?"
ISO_EXTENDED = rf"^\d{{4}}-\d{{2}}-\d{{2}}[T ]{_TIME}{_OFFSET}$"
ISO_BASIC = rf"^\d{{8}}[T ]{_TIME}{_OFFSET}$"


def partition_day(value: Column, data_type: T.DataType) -> Column:
    """``YYYY-MM-DD`` of a date, timestamp or text; ``_unknown`` where there is none.

    A text with a time part keeps the date it spells, whatever its offset; without one the first
    ten characters are taken unchecked.
    """
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        day = F.date_format(value, "yyyy-MM-dd")
    elif isinstance(data_type, T.StringType):
        head = F.substring(value, 1, 10)
        compact = F.concat_ws("-", F.substring(value, 1, 4), F.substring(value, 5, 2), F.substring(value, 7, 2))
        spelled = F.when(value.rlike(ISO_EXTENDED), head).when(value.rlike(ISO_BASIC), compact)
        valid = F.date_format(F.try_to_date(spelled, "yyyy-MM-dd"), "yyyy-MM-dd")
        day = F.when(value.rlike("[T ]"), valid).when(F.length(value) >= 10, head)
    else:
        day = F.lit(None).cast("string")
    return F.coalesce(day, F.lit(UNKNOWN_DAY))
