from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.functions.hashing import hash01, real_time_measurement
from tabloom.operators import splits

WEIGHTS = {"train": 0.6, "validation": 0.2, "test": 0.2}


def _keyed(df, column):
    return {r["id"]: r[column] for r in df.collect()}


def test_split_ignores_layout(spark):
    ids = spark.range(3000)
    one = _keyed(splits.hash_split(ids.repartition(1), ["id"], WEIGHTS, 123), "split")
    seven = _keyed(splits.hash_split(ids.repartition(7), ["id"], WEIGHTS, 123), "split")
    assert one == seven
    assert set(one) == set(range(3000))
    shares = {s: sum(v == s for v in one.values()) / 3000 for s in WEIGHTS}
    assert all(abs(shares[s] - w) < 0.04 for s, w in WEIGHTS.items())


def test_another_seed_gives_another_split(spark):
    ids = spark.range(200)
    assert _keyed(splits.hash_split(ids, ["id"], WEIGHTS, 1), "split") != _keyed(
        splits.hash_split(ids, ["id"], WEIGHTS, 2), "split"
    )


def test_exact_sizes(spark):
    got = _keyed(splits.exact_split(spark.range(101).repartition(4), ["id"], WEIGHTS, 5), "split")
    counts = [list(got.values()).count(s) for s in WEIGHTS]
    assert counts == [60, 20, 21]
    halves = _keyed(splits.exact_split(spark.range(10), ["id"], {"a": 1, "b": 1}, 5), "split")
    assert sorted(halves.values()) == ["a"] * 5 + ["b"] * 5


def test_split_of_nothing(spark):
    empty = spark.range(0)
    assert splits.split_counts(splits.hash_split(empty, ["id"], WEIGHTS, 1)).count() == 0
    assert splits.exact_split(empty, ["id"], WEIGHTS, 1).count() == 0


def test_folds_cover_all_rows(spark):
    folds = _keyed(splits.kfold(spark.range(900), ["id"], 3, seed=0), "fold")
    assert set(folds.values()) == {0, 1, 2}
    assert all(200 < list(folds.values()).count(f) < 400 for f in range(3))


def test_random_column_is_uniform_and_repeatable(spark):
    rows = spark.range(5000).select("id", real_time_measurement(7, "id").alias("m"))
    first, second = _keyed(rows, "m"), _keyed(rows.repartition(3), "m")
    assert first == second
    assert 0 <= min(first.values()) and max(first.values()) < 10
    assert abs(sum(first.values()) / 5000 - 5) < 0.2


def test_hash_of_several_keys(spark):
    row = spark.range(1).select(
        hash01(1, F.lit("a"), F.lit("b")).alias("ab"), hash01(1, F.lit("b"), F.lit("a")).alias("ba")
    ).first()
    assert row["ab"] != row["ba"]
