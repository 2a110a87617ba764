"""Order statistics by radix against sorting, and what their plans move."""

from __future__ import annotations

import math
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabloom.operators import splits
from tabloom.operators.selection import keys_at_ranks, value_from_bits, with_ordered_bits

EDGES = [0.0, -0.0, 1.0, -1.0, 2.0, 0.5, 1e300, -1e300, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308,
         1.7976931348623157e308, float("inf"), float("-inf"), 0.1, 1 / 3, 4503599627370496.5, 1e-310, 2**0.5]


def test_bits_are_those_stored_and_come_back(spark):
    values = EDGES + [math.ldexp(m, e) for e in range(-1074, 1024, 7) for m in (1.0, 1.5, 1 + 2**-52, 2 - 2**-52) if e < 1023]
    rows = with_ordered_bits(spark.createDataFrame([(v,) for v in values], "v double"), "v", "b")
    for r in rows.withColumn("back", value_from_bits(F.col("b"))).collect():
        stored = struct.unpack("<q", struct.pack("<d", abs(r["v"])))[0]
        assert r["b"] == (-stored if r["v"] < 0 else stored), r["v"]
        assert r["back"] == r["v"]
    none = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert [r[0] for r in with_ordered_bits(none, "v", "b").select("b").collect()] == [None, None]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.floats(allow_nan=True), st.integers(-5, 5).map(float))), min_size=1, max_size=60))
def test_ranks_are_those_of_a_sort(spark, rows):
    df = with_ordered_bits(spark.createDataFrame(rows, "g string, v double"), "v", "b")
    found = keys_at_ranks(df, "b", ["g"], lambda n: [F.lit(0).cast("long"), F.floor(n / 2), n - 1, n], digit=22)
    got = {(r["g"], r["rank"]): r for r in found.withColumn("v", value_from_bits(F.col("key"))).collect()}
    for g in {r[0] for r in rows}:
        own = sorted(v for h, v in rows if h == g and v is not None and v == v)
        n = len(own)
        assert {k[1] for k in got if k[0] == g} == ({0, n // 2, n - 1} if n else set())
        for rank in {0, n // 2, n - 1} if n else ():
            r = got[g, rank]
            assert (r["n_rows"], r["v"], r["before"], r["n"]) == (n, own[rank], sum(v < own[rank] for v in own), own.count(own[rank]))


def test_crowded_values_and_close_ones(spark):
    keys = [7 if i % 3 == 0 else i + (1 << 40) for i in range(20_000)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    found = keys_at_ranks(df, "k", [], lambda n: [F.lit(r).cast("long") for r in (10, 6667, 6668)] + [n - 1])
    assert sorted((r["rank"], r["key"], r["before"], r["n"]) for r in found.collect()) == [
        (r, sorted(keys)[r], sorted(keys).index(sorted(keys)[r]), keys.count(sorted(keys)[r])) for r in (10, 6667, 6668, 19_999)
    ]


def moved(df) -> list[str]:
    """The shuffles in a frame's plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]


def test_exact_split_moves_no_row(spark, tmp_path):
    spark.range(5000).write.parquet(f"{tmp_path}/ids")
    ids = spark.read.parquet(f"{tmp_path}/ids")
    found = splits.exact_split(ids, ["id"], {"train": 0.6, "validation": 0.2, "test": 0.2}, 5)
    assert moved(found) == []
    assert sorted(r["n_rows"] for r in splits.split_counts(found).collect()) == [1000, 1000, 3000]


@pytest.mark.parametrize("weights", [{"a": 1.0}, {"a": 1, "b": 1}, {"a": 1, "b": 0}, {"a": 0, "b": 1}, {"a": 2, "b": 1, "c": 0, "d": 1}])
def test_exact_split_equals_cutting_a_sort(spark, weights):
    from tabloom.functions.hashing import key_digest

    rows = spark.range(403).select((F.col("id") % 97).alias("k"), "id").withColumn("d", key_digest(5, "k"))
    order = [r["d"] for r in rows.orderBy("d").collect()]
    want, start, total, share = [], 0, sum(weights.values()), 0.0
    for name, w in weights.items():
        share += w
        end = math.floor(403 * round(share / total, 12) + 1e-9)
        want += [(name, d) for d in order[start:end]]
        start = end
    found = splits.exact_split(rows, ["k"], weights, 5)
    assert sorted((r["split"], r["d"]) for r in found.collect()) == sorted(want)
