"""Tidemark: change-data capture landing, SCD apply and sync metrics on Spark DataFrames."""

from tidemark.spec import TableSpec

__all__ = ["TableSpec"]
