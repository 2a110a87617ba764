from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabloom.operators.ordering import dense_row_id, running_sums, stage_in_order


def _letters(spark, n=1000):
    return spark.range(n).select(
        F.col("id").alias("k"), (F.col("id") % 37).alias("g"), F.md5(F.col("id").cast("string")).alias("s")
    )


@pytest.mark.parametrize("partitions", [1, 7])
def test_ids_are_dense_and_layout_free(spark, partitions):
    rows = _letters(spark)
    want = sorted((r["g"], r["s"]) for r in rows.collect())
    got = dense_row_id(rows.repartition(partitions), "rid", ["g", "s"]).collect()
    assert {r["rid"]: (r["g"], r["s"]) for r in got} == dict(enumerate(want))


def test_ids_when_one_key_holds_most_rows(spark):
    rows = _letters(spark).withColumn("g", F.when(F.col("k") % 3 > 0, 5).otherwise(F.col("g")))
    got = dense_row_id(rows, "rid", ["g"]).collect()
    assert sorted(r["rid"] for r in got) == list(range(1000))
    by_id = [r["g"] for r in sorted(got, key=lambda r: r["rid"])]
    assert by_id == sorted(by_id)
    # Ties go by the other columns: another layout gives every row the same id.
    again = dense_row_id(rows.repartition(5), "rid", ["g"]).collect()
    assert {r["k"]: r["rid"] for r in got} == {r["k"]: r["rid"] for r in again}


@pytest.mark.parametrize("rows_per_task", [10, 10_000])
def test_ids_of_identical_rows(spark, rows_per_task):
    rows = spark.range(500).select((F.col("id") % 2).alias("a"), F.lit("x").alias("b"))
    got = dense_row_id(rows, "rid", ["a"], rows_per_task).collect()
    assert sorted(r["rid"] for r in got) == list(range(500))
    assert all((r["rid"] < 250) == (r["a"] == 0) for r in got)


def test_ids_of_nothing(spark):
    assert dense_row_id(_letters(spark).limit(0), "rid", ["k"]).count() == 0


@pytest.mark.parametrize("small_rows", [0, 10_000])
@pytest.mark.parametrize("groups", [[], ["g"]])
def test_running_sums_match_a_window(spark, groups, small_rows):
    rng = random.Random(3)
    data = [
        (None if i % 11 == 0 else i % 3, i, rng.randrange(100), rng.randrange(100))
        for i in range(600)
    ]
    rows = spark.createDataFrame(data, "g int, k int, a int, b int").repartition(5)
    window = Window.partitionBy(*groups).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.select("*", *(F.sum(c).over(window).alias(f"run_{c}") for c in "ab"))
    staged = stage_in_order(rows, ["k"], groups)
    got = running_sums(staged, ["k"], {"run_a": "a", "run_b": "b"}, groups, small_rows)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
