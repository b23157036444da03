"""Table manifest: one row per synced table with where its files are and how it is applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.identity import schema_part, table_part, table_uoid

KEYS = ["database", "schema_name", "table_name"]
FIELDS = (
    "database string, schema_name string, table_name string, catalog_target string, schema_target string,"
    " table_target string, file_path string, file_type string, scd_type int, soft_delete boolean,"
    " primary_key array<string>"
)


def has_output() -> Column:
    """Whether a result produced data: by its files, else by its rows; without either it did."""
    return (
        F.when(F.col("files").isNotNull(), F.size("files") > 0)
        .when(F.col("rows_written").isNotNull(), F.col("rows_written") > 0)
        .otherwise(True)
    )


def _succeeded() -> Column:
    return (F.coalesce(F.col("status"), F.lit("")) != "error") & F.col("database").isNotNull() & F.col("table").isNotNull()


def entries(results: DataFrame, output_dir: str, file_type: str, targets: DataFrame | None = None) -> DataFrame:
    """Manifest rows of the tables a run wrote: ``results`` has one row per table of the run.

    ``targets`` (database, schema_name, catalog_target, schema_target) names where tables go.
    """
    named = results.where(_succeeded() & has_output() & F.col("table").contains(".")).select(
        "database",
        schema_part(F.col("table")).alias("schema_name"),
        table_part(F.col("table")).alias("table_name"),
        "scd_type", "soft_delete", "primary_key",
    ).dropDuplicates(KEYS)
    if targets is None:
        named = named.withColumns({c: F.lit(None).cast("string") for c in ("catalog_target", "schema_target")})
    else:
        named = named.join(targets, ["database", "schema_name"], "left")
    return named.select(
        *KEYS, "catalog_target", "schema_target",
        F.col("table_name").alias("table_target"),
        F.concat_ws("/", F.lit(output_dir), *KEYS).alias("file_path"),
        F.lit(file_type).alias("file_type"),
        "scd_type",
        F.when(F.col("soft_delete"), True).alias("soft_delete"),
        "primary_key",
    )


def merge_add(manifest: DataFrame, added: DataFrame) -> DataFrame:
    """Adds tables the manifest lacks; rows it has stay as they are."""
    new = added.join(manifest.select(*KEYS), KEYS, "left_anti")
    return manifest.unionByName(new.select(*manifest.columns))


def incremental(results: DataFrame, output_dir: str, file_type: str, targets: DataFrame | None = None) -> DataFrame:
    """A new manifest with only the tables that had rows in this run."""
    return entries(results.where(F.coalesce("rows_written", F.lit(0)) > 0), output_dir, file_type, targets)


def with_targets(manifest: DataFrame) -> DataFrame:
    """Entries for which all three target names are known; only these can be applied."""
    named = F.lit(True)
    for column in ("catalog_target", "schema_target", "table_target"):
        named = named & (F.coalesce(F.col(column), F.lit("")) != "")
    return manifest.where(named)


def choose(incremental_manifest: DataFrame | None, full_manifest: DataFrame | None) -> DataFrame:
    """The incremental manifest if it names a table to apply, else the full one."""
    if incremental_manifest is not None and not with_targets(incremental_manifest).isEmpty():
        return incremental_manifest
    if full_manifest is None:
        raise FileNotFoundError("there is no manifest")
    return full_manifest


def apply_plan(manifest: DataFrame, schema_history: DataFrame) -> DataFrame:
    """What the apply job needs per table: target, id, key, rules and the columns to parse.

    ``schema_history`` names tables by database, schema and table. The column list of a table is as long as
    the table is wide.
    """
    columns = schema_history.groupBy(*KEYS).agg(
        F.sort_array(F.collect_list(F.struct("ordinal", "name", "type", "precision", "scale"))).alias("columns")
    )
    no_columns = F.array().cast("array<struct<ordinal:int,name:string,type:string,precision:int,scale:int>>")
    return with_targets(manifest).join(columns, KEYS, "left").select(
        F.concat_ws(".", "catalog_target", "schema_target", "table_target").alias("target"),
        *KEYS,
        table_uoid(*[F.col(k) for k in KEYS]).alias("uoid"),
        F.coalesce("primary_key", F.array().cast("array<string>")).alias("primary_key"),
        F.coalesce("scd_type", F.lit(1)).alias("scd_type"),
        F.coalesce("soft_delete", F.lit(False)).alias("soft_delete"),
        "file_path",
        F.coalesce("columns", no_columns).alias("columns"),
    )


# Key names of stored manifests.
_TABLE = "uc_table_name string, file_path string, file_type string, scd_type int, soft_delete boolean, primary_key array<string>"
CATALOG_KEY, SCHEMA_KEY = "uc_catalog_name", "uc_schema_name"


def flatten(nested: DataFrame, document: str = "manifest") -> DataFrame:
    """Rows from nested manifest documents (database, schema, table) kept as JSON text.

    A database node also holds its catalog name and a schema node its target name, as plain text.
    """
    node = "map<string,string>"
    databases = nested.select(F.explode(F.from_json(document, f"struct<databases:{node}>")["databases"]))
    databases = databases.select(F.col("key").alias("database"), F.from_json("value", node).alias("d"))
    schemas = databases.select("database", F.col("d")[CATALOG_KEY].alias("catalog_target"), F.explode("d")).where(
        F.col("key") != CATALOG_KEY
    )
    schemas = schemas.select("database", "catalog_target", F.col("key").alias("source_schema"), F.from_json("value", node).alias("s"))
    tables = schemas.select(
        "database", "catalog_target", "source_schema", F.col("s")[SCHEMA_KEY].alias("schema_target"), F.explode("s")
    ).where((F.col("key") != SCHEMA_KEY) & F.col("value").startswith("{"))
    return tables.select(
        "database",
        F.col("source_schema").alias("schema_name"),
        F.col("key").alias("table_name"),
        "catalog_target",
        "schema_target",
        F.from_json("value", _TABLE).alias("t"),
    ).select(*KEYS, "catalog_target", "schema_target", "t.*").withColumnRenamed("uc_table_name", "table_target")
