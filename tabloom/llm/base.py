"""Declaring the queries of this package, and small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that must give the same rows."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is declared twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores appended until no column is called so (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_id(df: DataFrame, name: str, label: str) -> DataFrame:
    """Number the rows and write them down, so that every later read sees the same numbers.

    The numbers have gaps. Repeated rows get different ones.
    """
    return stage(df.withColumn(name, F.monotonically_increasing_id()), label)


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; none for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def partitions_for(rows: int, per_partition: int, least: int = 1) -> int:
    return max(least, -(-rows // per_partition))
