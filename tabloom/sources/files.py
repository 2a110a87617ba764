"""Delimited text and path-addressed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    schema: T.StructType | str | None = None,
    sampling_ratio: float | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Scan delimited text with a header line; quotes inside values are doubled.

    Types are inferred unless ``schema`` is given.  Inference reads the whole
    input once more; for large inputs pass the schema, or a sampling ratio.
    ``multi_line`` allows line breaks inside values, at the price that a file is
    no longer read in parallel pieces.
    """
    reader = spark.read.options(header=True, sep=sep, escape='"', multiLine=multi_line)
    if schema is not None:
        return reader.schema(schema).csv(path)
    if sampling_ratio is not None:
        reader = reader.option("samplingRatio", sampling_ratio)
    return reader.option("inferSchema", True).csv(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").options(header=True, sep=sep, escape='"').csv(path)


def read_path(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Table stored at a path."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def overwrite_path(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace what is stored at ``path``; overwrite mode needs no separate delete."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
