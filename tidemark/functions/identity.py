"""Identifiers and fingerprints computed from names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the DNS namespace of RFC 4122, in hex.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def table_uoid(database: Column, schema: Column, table: Column) -> Column:
    """Version-5 UUID of a table, from its three name parts joined by NUL."""
    name = F.encode(F.concat_ws("\x00", database, schema, table), "UTF-8")
    digest = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE)), name))
    variant = F.element_at(
        F.array(*[F.lit(c) for c in "89ab"]),
        (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4) + 1,
    )
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def uoid_of(database: str, schema: str, table: str) -> str:
    """The same id on the driver, to filter by one table."""
    return str(uuid.uuid5(uuid.NAMESPACE_DNS, "\x00".join((database, schema, table))))


def fingerprint(signature: Column) -> Column:
    """Leading 60 bits of SHA-256 as a bigint."""
    return F.conv(F.substring(F.sha2(signature, 256), 1, 15), 16, 10).cast("bigint")


def qualified_name(name: Column) -> Column:
    """Comparable form of a table name: trimmed, lower case, ``dbo`` unless a schema is given."""
    clean = F.lower(F.trim(name))
    return F.when(clean.contains("."), clean).otherwise(F.concat(F.lit("dbo."), clean))


def schema_part(full_name: Column) -> Column:
    """Text before the first dot, ``dbo`` where there is none."""
    return F.when(full_name.contains("."), F.substring_index(full_name, ".", 1)).otherwise(F.lit("dbo"))


def table_part(full_name: Column) -> Column:
    """Text after the first dot, the whole name where there is none."""
    return F.regexp_replace(full_name, r"(?s)^[^.]*\.", "")
