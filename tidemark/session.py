"""Session settings the library is designed for, and the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Broadcasts are only asked for up to this many rows; larger sides are joined by a shuffle.
BROADCAST_ROWS = 100_000


def build_session(app_name: str = "tidemark", **conf: str) -> SparkSession:
    """A session with the settings this library assumes; callers may override any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Only a local session may run without that setting; it then works in a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def column(name: str, of: str | None = None) -> Column:
    """A column by its exact name, dots and spaces included; ``of`` is the alias of its frame."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(quoted if of is None else f"{of}.{quoted}")


def read_parquet(spark: SparkSession, schema: T.StructType | str, path: str) -> DataFrame | None:
    """A Parquet folder, or None while it does not exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame | None:
    """The frame if it has at most ``max_rows`` rows; counting stops soon after that."""
    return df if df.limit(max_rows + 1).count() <= max_rows else None


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a control table for broadcast if it is small; a larger one is joined by a shuffle."""
    small = if_small(df, max_rows)
    return df if small is None else F.broadcast(small)
