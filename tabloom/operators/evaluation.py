"""Evaluating scored rows: one-pass metrics, AUC, residuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.ordering import SMALL_GROUP_ROWS, running_sums, stage_in_order


def evaluate(df: DataFrame, metrics: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Metric expressions as columns, one row per group, in a single pass."""
    return df.groupBy(*by).agg(*(m.alias(name) for name, m in metrics.items()))


def auc(
    df: DataFrame,
    label: str,
    score: str,
    by: Sequence[str] = (),
    output: str = "auc",
    small_rows: int = SMALL_GROUP_ROWS,
) -> DataFrame:
    """Area under the ROC curve; tied scores share half.  Null if a class is absent.

    Rows without a score (null or NaN) and rows with a label other than 0 and 1
    take no part.

    Rows are first reduced to distinct scores with their class counts, which
    combines on the map side, and only those are put in order.
    """
    positive = F.col(label).cast("double") == 1.0
    value = F.col(score).cast("double")
    known = df.where(
        F.col(label).cast("double").isin(0.0, 1.0) & value.isNotNull() & ~F.isnan(value)
    )
    tied = known.groupBy(*by, F.col(score).cast("double").alias("__score")).agg(
        F.count_if(positive).alias("__pos"), F.count_if(~positive).alias("__neg")
    )
    staged = stage_in_order(tied, ["__score"], by)
    ranked = running_sums(staged, ["__score"], {"__neg_upto": "__neg"}, by, small_rows)
    # Pairs won by the positives at this score: negatives below, plus half of those level.
    won = F.col("__pos").cast("double") * (
        F.col("__neg_upto").cast("double") - F.col("__neg").cast("double") / 2
    )
    pairs = F.sum("__pos").cast("double") * F.sum("__neg").cast("double")
    return ranked.groupBy(*by).agg(F.try_divide(F.sum(won), pairs).alias(output))


def residual_profile(df: DataFrame, by: str, residual: str = "residual") -> DataFrame:
    """Mean and spread of residuals per group, to look for patterns left over."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(residual).alias("mean_residual"),
        F.stddev_samp(residual).alias("sd_residual"),
    )
