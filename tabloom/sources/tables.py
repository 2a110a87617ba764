"""Catalog tables, and stored rows published behind a view."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> str:
    """Create a schema when absent; optionally place it at ``location``."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")
    return schema


def use_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"USE SCHEMA {schema}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def overwrite_table(
    df: DataFrame,
    name: str,
    bucket_by: tuple[str, ...] = (),
    buckets: int | None = None,
) -> None:
    """Save ``df`` as a table, replacing rows and schema of an earlier one.

    With ``buckets`` the rows are hashed on ``bucket_by`` once, at write time, so
    that later joins on those columns need no shuffle of this side.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if buckets:
        # One task per bucket; otherwise every task opens a file in every bucket.
        writer = (
            df.repartition(buckets, *bucket_by)
            .write.mode("overwrite").format("parquet")
            .bucketBy(buckets, *bucket_by)
            .sortBy(*bucket_by)
        )
    writer.saveAsTable(name)


def quoted(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def version_name(name: str) -> str:
    """Unused table name for another stored version of ``name``."""
    return f"{name}__v{uuid.uuid4().hex[:12]}"


def publish_view(
    spark: SparkSession, name: str, select: str, comment: str, properties: dict[str, str]
) -> None:
    """Point the view ``name`` at stored rows.

    One catalog statement moves readers over.  Queries already running keep the
    rows they started with, and bucketing of the stored rows shows through.
    """
    props = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} COMMENT {quoted(comment)} TBLPROPERTIES ({props}) AS {select}"
    )


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def table_comment(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Comment'").collect()
    return rows[-1]["data_type"] if rows else ""
