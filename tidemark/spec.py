"""Per-table settings and their validation."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

MODES = ("incremental", "full_incremental")
DEFAULT_MODE = "full_incremental"
SCD_TYPES = (1, 2)


@dataclass(frozen=True)
class TableSpec:
    """What to do with one source table: where it comes from, its key, and how to apply changes."""

    database: str
    schema: str
    table: str
    keys: tuple[str, ...] = ()
    mode: str = DEFAULT_MODE
    scd_type: int = 1
    soft_delete: bool = False
    catalog: str | None = None
    columns: tuple[dict, ...] = field(default=(), compare=False)

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"mode {self.mode!r} is not one of {list(MODES)}")
        if self.scd_type not in SCD_TYPES:
            raise ValueError(f"scd_type {self.scd_type!r} is not one of {list(SCD_TYPES)}")
        if not isinstance(self.soft_delete, bool):
            raise ValueError("soft_delete must be true or false")
        if not isinstance(self.keys, tuple):
            single = isinstance(self.keys, str)
            object.__setattr__(self, "keys", (self.keys,) if single else tuple(self.keys))


def tables_frame(spark: SparkSession, specs: Iterable[TableSpec]) -> DataFrame:
    """Settings of all tables as the control table a sync run reads."""
    listed = [(s.database, f"{s.schema}.{s.table}", s.mode, s.scd_type, s.soft_delete, list(s.keys)) for s in specs]
    fields = "database string, table_name string, mode string, scd_type int, soft_delete boolean, primary_key array<string>"
    return spark.createDataFrame(listed, fields)
