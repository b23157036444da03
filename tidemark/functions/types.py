"""Source column types and the Spark types they are read as."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import types as T

# Source type name -> Spark type. Names not listed are read as text.
SPARK_TYPES: dict[str, T.DataType] = {
    "int": T.IntegerType(), "bigint": T.LongType(), "smallint": T.ShortType(), "tinyint": T.ShortType(),
    "bit": T.BooleanType(), "float": T.DoubleType(), "real": T.FloatType(),
    "decimal": T.DecimalType(38, 10), "numeric": T.DecimalType(38, 10),
    "money": T.DecimalType(19, 4), "smallmoney": T.DecimalType(10, 4),
    "date": T.DateType(), "datetime": T.TimestampType(), "datetime2": T.TimestampType(),
    "smalldatetime": T.TimestampType(), "datetimeoffset": T.TimestampType(),
    "binary": T.BinaryType(), "varbinary": T.BinaryType(), "image": T.BinaryType(), "geography": T.BinaryType(),
    "geometry": T.BinaryType(), "rowversion": T.BinaryType(),
}
SIZED_TYPES = ("decimal", "numeric", "money", "smallmoney")

# Spark type -> source type name, used when only a DataFrame schema is known.
SOURCE_NAMES: dict[str, str] = {
    "tinyint": "smallint", "smallint": "smallint", "int": "int", "bigint": "bigint", "boolean": "bit",
    "float": "real", "double": "float", "string": "nvarchar", "binary": "varbinary", "date": "date",
    "timestamp": "datetime2", "timestamp_ntz": "datetime2", "void": "unknown",
}


def spark_type(name: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """Spark type of a source type; precision and scale count for decimals only."""
    if name in SIZED_TYPES and precision is not None:
        return T.DecimalType(precision, scale or 0)
    return SPARK_TYPES.get(name, T.StringType())


def source_type(data_type: T.DataType) -> str:
    """Source type name of a Spark type; a type without a counterpart keeps its own name."""
    if isinstance(data_type, T.DecimalType):
        return "decimal"
    simple = data_type.simpleString()
    return SOURCE_NAMES.get(simple, simple)


def parse_schema(columns: Iterable[Mapping]) -> T.StructType:
    """Schema to parse payloads with, from ``{name, type, precision?, scale?}`` rows in order."""
    return T.StructType(
        [T.StructField(c["name"], spark_type(c["type"], c.get("precision"), c.get("scale")), True) for c in columns]
    )


_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` can be kept as ``new`` without rewriting history from the feed."""
    if old == new:
        return True
    before, after = old.simpleString(), new.simpleString()
    if before in _INTEGERS and after in _INTEGERS:
        return _INTEGERS.index(before) < _INTEGERS.index(after)
    if before == "float" and after == "double":
        return True
    if before in ("tinyint", "smallint", "int") and after == "double":
        return True
    if before == "date" and after == "timestamp_ntz":
        return True
    if isinstance(new, T.DecimalType):
        whole = new.precision - new.scale
        if isinstance(old, T.DecimalType):
            return whole >= old.precision - old.scale and new.scale >= old.scale
        digits = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}.get(before)
        return digits is not None and whole >= digits
    return False
