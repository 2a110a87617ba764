from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import profiling

NAN = float("nan")


def test_null_report_counts_nan(spark):
    rows = spark.createDataFrame(
        [(1, 1.0, "a"), (2, NAN, None), (None, None, "c")], "i int, d double, s string"
    )
    got = {r["column_name"]: (r["n_missing"], r["has_missing"]) for r in profiling.null_report(rows).collect()}
    assert got == {"i": (1, True), "d": (2, True), "s": (1, True)}
    clean = profiling.null_report(spark.range(3)).first()
    assert (clean["n_missing"], clean["has_missing"]) == (0, False)


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(1).normal(size=2000).round(3)
    rows = spark.createDataFrame([(float(v),) for v in values], "x double")
    counts, edges = np.histogram(values, bins=10)
    got = {r["bin"]: r for r in profiling.numeric_histogram(rows, "x", 10).collect()}
    assert [got[i]["n_rows"] if i in got else 0 for i in range(10)] == counts.tolist()
    assert all(abs(got[i]["lower_edge"] - edges[i]) < 1e-9 for i in got)


def test_histogram_of_constant_missing_and_empty(spark):
    rows = spark.createDataFrame([(2.0,), (2.0,), (None,), (NAN,)], "x double")
    assert [(r["bin"], r["n_rows"]) for r in profiling.numeric_histogram(rows, "x", 4).collect()] == [(0, 2)]
    assert profiling.numeric_histogram(rows.limit(0), "x", 4).count() == 0


def test_histogram_counts_infinities_apart(spark):
    inf = float("inf")
    rows = spark.createDataFrame([(0.0,), (4.0,), (inf,), (inf,), (-inf,)], "x double")
    got = {r["bin"]: (r["lower_edge"], r["upper_edge"], r["n_rows"])
           for r in profiling.numeric_histogram(rows, "x", 4).collect()}
    assert got == {-1: (-inf, -inf, 1), 0: (0.0, 1.0, 1), 3: (3.0, 4.0, 1), 4: (inf, inf, 2)}
    only = profiling.numeric_histogram(rows.where("x > 9"), "x", 4).collect()
    assert [(r["bin"], r["n_rows"]) for r in only] == [(4, 2)]


def _reference_box(values):
    q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
    return [len(values), q1, median, q3, inside.min(), inside.max(), len(values) - len(inside)]


def test_boxes_match_numpy(spark):
    rng = np.random.default_rng(2)
    # One value makes up a third of the rows, as a hot value would.
    a = np.where(rng.random(900) < 0.33, 5.0, rng.standard_t(2, 900).round(2))
    y = rng.integers(0, 2, 900)
    data = [(float(v), int(c)) for v, c in zip(a, y)] + [(None, 0), (NAN, 1)]
    rows = spark.createDataFrame(data, "a double, y int").withColumn("b", F.col("a") * 2)
    stats = profiling.boxplot_stats(rows, ["a", "b"], "y")
    names = ["n_rows", "q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers"]
    got = {(r["feature"], r["label"]): [r[n] for n in names] for r in stats.collect()}
    assert len(got) == 4
    for label in (0, 1):
        np.testing.assert_allclose(got["a", label], _reference_box(a[y == label]), atol=1e-9)
        np.testing.assert_allclose(got["b", label], _reference_box(2 * a[y == label]), atol=1e-9)


def test_approximate_boxes_are_close(spark):
    rows = spark.range(10_001).select(F.col("id").alias("v"), F.lit(1).alias("y"))
    box = profiling.boxplot_stats_approx(rows, ["v"], "y").first()
    assert abs(box["median"] - 5000) <= 5 and abs(box["q1"] - 2500) <= 5


def test_separation(spark):
    rows = spark.range(200).select(
        (F.col("id") % 2).cast("int").alias("y"),
        (F.col("id") % 2 * 100 + F.col("id") % 7).alias("up"),
        (-F.col("id") % 2 * 100 + F.col("id") % 7).alias("down"),
        (F.col("id") % 7).alias("noise"),
    )
    stats = profiling.boxplot_stats(rows, ["up", "down", "noise"], "y")
    got = {r["feature"]: (r["high_above_low_box"], r["high_below_low_box"])
           for r in profiling.median_separation(stats).collect()}
    assert got["up"] == (True, False) and got["noise"] == (False, False)


def test_categorical_at_the_limit(spark):
    rows = spark.range(400).select(
        *((F.col("id") % k).alias(f"k{k}") for k in (1, 4, 5, 200)),
        F.when(F.col("id") % 2 == 0, F.lit("x")).alias("half_null"),
    )
    got = {r["feature"]: (r["is_categorical"], r["n_categories"])
           for r in profiling.categorical_features(rows, rows.columns, 4).collect()}
    assert got == {
        "k1": (True, 1), "k4": (True, 4), "k5": (False, None), "k200": (False, None),
        "half_null": (True, 1),
    }
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (None,)], "z double")
    assert tuple(profiling.categorical_features(zeros, ["z"], 2).first()) == ("z", True, 2, 2)
    counts = profiling.categorical_features(rows, ["k200"], 4).first()
    assert (counts["is_categorical"], counts["n_distinct"]) == (False, 200)
