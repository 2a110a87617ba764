"""Projections: drop, select, rename, label, pack, preview, schema, union."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.names import column_safe


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns; a name the frame does not have is an error, not a no-op."""
    columns = list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*columns)


def feature_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """All columns but the label and keys, in frame order."""
    exclude = set(exclude)
    return [c for c in df.columns if c not in exclude]


def normalize_names(df: DataFrame) -> DataFrame:
    """Replace spaces in every column name by underscores."""
    renamed = [column_safe(c) for c in df.columns]
    clashes = [c for c, n in Counter(renamed).items() if n > 1]
    if clashes:
        raise ValueError(f"columns would collide after renaming: {clashes}")
    return df.toDF(*renamed)


def union_flagged(first: DataFrame, second: DataFrame, flag: str) -> DataFrame:
    """Rows of both frames, matched by name, with ``flag`` = 1 for the first one."""
    return first.withColumn(flag, F.lit(1)).unionByName(second.withColumn(flag, F.lit(0)))


def binarize(column: Column | str, threshold: float) -> Column:
    """1 where the value is at least ``threshold``, else 0; null stays null."""
    column = F.col(column) if isinstance(column, str) else column
    return (column >= F.lit(threshold)).cast("int")


def with_residual(
    df: DataFrame, label: str, prediction: str = "prediction", output: str = "residual"
) -> DataFrame:
    return df.withColumn(output, F.col(label) - F.col(prediction))


def pack(columns: Iterable[str]) -> Column:
    """All features as one struct, the input of a scoring function."""
    return F.struct(*columns)


def preview(df: DataFrame, order_by: Iterable[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order, so that two previews agree."""
    return df.orderBy(*order_by).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and whether nulls are allowed."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, type string, nullable boolean"
    )
