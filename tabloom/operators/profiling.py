"""Column statistics for exploring a table before training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.ordering import BROADCAST_ROWS
from tabloom.operators.selection import keys_at_ranks, value_from_bits, with_ordered_bits
from tabloom.session import stage

QUARTILES = (0.25, 0.5, 0.75)


def _floating(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.FloatType, T.DoubleType))


def group_mean(df: DataFrame, by: str, value: str, output: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(value).alias(output))


def null_report(df: DataFrame) -> DataFrame:
    """Per column: how many nulls (NaN included) and whether there are any."""

    def missing(field: T.StructField) -> Column:
        test = F.col(field.name).isNull()
        if _floating(field):
            test = test | F.isnan(field.name)
        return F.count_if(test).alias(field.name)

    counts = df.agg(*(missing(f) for f in df.schema.fields))
    return counts.unpivot([], df.columns, "column_name", "n_missing").withColumn(
        "has_missing", F.col("n_missing") > 0
    )


def value_histogram(df: DataFrame, column: str) -> DataFrame:
    """Rows per distinct value, for integer or category columns."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def numeric_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the least and greatest finite value; the last bin is closed.

    Infinite values are counted apart, below as bin -1 and above as bin ``bins``,
    with infinite edges.  Empty bins are left out; nulls and NaN are not counted.
    """
    value = F.col(column).cast("double")
    known = df.select(value.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    above, below = F.lit(float("inf")), F.lit(float("-inf"))
    finite = F.when((F.col("v") < above) & (F.col("v") > below), F.col("v"))
    low, high = known.agg(F.min(finite), F.max(finite)).first()
    if low is None:
        low = high = 0.0
    width = (high - low) / bins or 1.0
    inside = F.least(F.lit(bins - 1), F.floor((finite - F.lit(low)) / F.lit(width)))
    bin_no = (
        F.when(F.col("v") == below, -1).when(F.col("v") == above, bins).otherwise(inside)
    )

    def edge(at: Column) -> Column:
        outside = F.when(F.col("bin") < 0, below).when(F.col("bin") >= bins, above)
        return outside.otherwise(F.lit(low) + at * F.lit(width))

    return (
        known.groupBy(bin_no.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            "bin",
            edge(F.col("bin")).alias("lower_edge"),
            edge(F.col("bin") + 1).alias("upper_edge"),
            "n_rows",
        )
    )


def _long(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, label, value) of every known value: one scan, whatever the number of features."""
    return (
        df.select(
            F.col(label).alias("label"), *(F.col(c).cast("double").alias(c) for c in features)
        )
        .unpivot(["label"], list(features), "feature", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def _quartiles_by_rank(long: DataFrame) -> DataFrame:
    """Quartiles between order statistics, which are selected without moving a row."""

    def position(q: float, n_rows: Column) -> Column:
        return F.lit(q) * (n_rows - 1)

    def neighbours(n_rows: Column) -> list[Column]:
        at = [position(q, n_rows) for q in QUARTILES]
        return [side(p).cast("bigint") for p in at for side in (F.floor, F.ceil)]

    groups = ["feature", "label"]
    # No value is null here; saying so keeps a test for nulls, and the bits in it, out of the scan.
    keyed = with_ordered_bits(long, "value", "bits").withColumn("bits", F.coalesce("bits", F.lit(0)))
    found = keys_at_ranks(keyed, "bits", groups, neighbours)
    at_rank = F.map_from_entries(F.collect_list(F.struct("rank", value_from_bits(F.col("key")))))
    ranked = found.groupBy(*groups, "n_rows").agg(at_rank.alias("at"))
    points = []
    for q in QUARTILES:
        at = position(q, F.col("n_rows"))
        low, high = (F.col("at")[side(at).cast("bigint")] for side in (F.floor, F.ceil))
        # Equal neighbours may be infinite, and their difference no number.
        between = low + (high - low) * (at - F.floor(at))
        points.append(F.when(low == high, low).otherwise(between))
    return ranked.select(*groups, F.array(*points).alias("q"), "n_rows")


def _join_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Attach per-(feature, label) values; broadcast them when there are few groups."""
    groups = groups.withColumnsRenamed({"feature": "g_feature", "label": "g_label"})
    groups = stage(groups, "feature-label-groups")
    if groups.count() <= BROADCAST_ROWS:
        groups = F.broadcast(groups)
    same = (F.col("feature") == F.col("g_feature")) & F.col("label").eqNullSafe(F.col("g_label"))
    return rows.join(groups, same).drop("g_feature", "g_label")


def boxplot_stats(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Box-plot numbers of every feature for every label value.

    Quartiles interpolate between order statistics; whiskers are the extreme
    values within 1.5 interquartile ranges of the box; the rest are outliers.
    Quartiles are selected by histograms over the bits of the values, by one formula
    at every size; no row of the table is shuffled.
    """
    long = _long(df, features, label)
    boxed = _join_groups(long, _quartiles_by_rank(long))
    q1, median, q3 = (F.col("q")[i] for i in range(3))
    reach = F.lit(1.5) * (q3 - q1)
    inside = F.col("value").between(q1 - reach, q3 + reach)
    return boxed.groupBy("feature", "label").agg(
        F.max("n_rows").alias("n_rows"),
        F.max(q1).alias("q1"),
        F.max(median).alias("median"),
        F.max(q3).alias("q3"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def boxplot_stats_approx(
    df: DataFrame, features: Sequence[str], label: str, accuracy: int = 10_000
) -> DataFrame:
    """Quartiles by mergeable summaries in one pass, for a quick look at huge tables."""
    return (
        _long(df, features, label)
        .groupBy("feature", "label")
        .agg(
            F.percentile_approx("value", list(QUARTILES), accuracy).alias("q"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .select(
            "feature",
            "label",
            "n_rows",
            F.col("q")[0].alias("q1"),
            F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"),
        )
    )


def median_separation(stats: DataFrame) -> DataFrame:
    """Which features separate a 0/1 label: the median of one group lies outside
    the box of the other.  Works on the rows of ``boxplot_stats``."""

    def pick(value: str, label: int) -> Column:
        return F.max(F.when(F.col("label") == label, F.col(value))).alias(f"{value}_{label}")

    sides = stats.groupBy("feature").agg(
        *(pick(v, side) for v in ("q1", "median", "q3") for side in (0, 1))
    )
    return sides.select(
        "feature",
        F.col("median_0").alias("median_low"),
        F.col("median_1").alias("median_high"),
        (F.col("median_1") > F.col("q3_0")).alias("high_above_low_box"),
        (F.col("median_1") < F.col("q1_0")).alias("high_below_low_box"),
    )


def categorical_features(
    df: DataFrame, features: Sequence[str], max_categories: int
) -> DataFrame:
    """Per feature the number of distinct values, and whether it makes categories:
    at most ``max_categories`` of them.  Nulls are no value; 0.0 and -0.0 are one.

    One pass over the rows; values repeated within a task are combined before the
    shuffle, which so carries distinct values only.
    """

    def as_text(c: str) -> Column:
        value = F.col(c)
        if _floating(df.schema[c]):
            value = value + F.lit(0.0)
        return value.cast("string").alias(c)

    counts = (
        df.select(*(as_text(c) for c in features))
        .unpivot([], list(features), "feature", "value")
        .groupBy("feature", "value")
        .agg(F.lit(1).alias("seen"))
        .groupBy("feature")
        .agg(F.count("value").alias("n_distinct"))
    )
    few = F.col("n_distinct") <= max_categories
    return counts.select(
        "feature",
        few.alias("is_categorical"),
        F.when(few, F.col("n_distinct")).alias("n_categories"),
        "n_distinct",
    )
