"""Operators against brute force on random small inputs."""

from __future__ import annotations

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabloom.operators import profiling
from tabloom.operators.evaluation import auc
from tabloom.operators.ordering import dense_row_id

FEW = settings(
    max_examples=8,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
SCORES = st.integers(0, 6).map(lambda i: i / 6)


def _pairs_won(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    if not pos or not neg:
        return None
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return won / (len(pos) * len(neg))


@FEW
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 1), SCORES), min_size=1, max_size=40))
def test_auc_counts_pairs(spark, rows):
    df = spark.createDataFrame(rows, "g int, y int, p double")
    got = {r["g"]: r["auc"] for r in auc(df, "y", "p", ["g"], small_rows=0).collect()}
    for g in {r[0] for r in rows}:
        want = _pairs_won([(y, p) for h, y, p in rows if h == g])
        assert (got[g] is None) if want is None else abs(got[g] - want) < 1e-12


@FEW
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(-5, 5)), min_size=1, max_size=40))
def test_quartiles_by_rank(spark, rows):
    df = spark.createDataFrame(rows, "y int, v int")
    stats = {r["label"]: r for r in profiling.boxplot_stats(df, ["v"], "y").collect()}
    for y in {r[0] for r in rows}:
        values = [v for h, v in rows if h == y]
        want = np.quantile(values, [0.25, 0.5, 0.75])
        assert np.allclose([stats[y][c] for c in ("q1", "median", "q3")], want)
        assert stats[y]["n_rows"] == len(values)


@FEW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=30))
def test_ids_follow_the_order(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int").repartition(3)
    got = sorted(dense_row_id(df, "rid", ["a"]).collect(), key=lambda r: r["rid"])
    assert [r["rid"] for r in got] == list(range(len(rows)))
    assert [r["a"] for r in got] == sorted(a for a, _ in rows)
    assert sorted((r["a"], r["b"]) for r in got) == sorted(rows)
