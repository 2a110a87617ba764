"""Every registered query against its SQL twin, and invariants where there is none."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tabloom.queries import all_queries, all_sql
from tests.compare import difference

QUERIES, SQL = all_queries(), all_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_entry(spark):
    flagship = entry.entry(spark)
    assert flagship.columns == ["instant", "hr", "workingday", "cnt", "prediction"]
    assert flagship.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) - set(SQL) == {"rf_binary_proba"}


def test_forest_probabilities(spark, sf_dir):
    rows = QUERIES["rf_binary_proba"](spark, sf_dir).collect()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert len(rows) == labels.count()
    assert all(0.0 <= r["prediction"] <= 1.0 for r in rows)
    mean = {y: [r["prediction"] for r in rows if r["quality"] == y] for y in (0, 1)}
    assert sum(mean[1]) / len(mean[1]) > sum(mean[0]) / len(mean[0]) + 0.3


def test_early_stopping_stops(spark, sf_dir):
    rows = {r["split"]: r for r in QUERIES["gbt_early_stop"](spark, sf_dir).collect()}
    assert set(rows) == {"train", "validation", "test"}
    assert all(2 <= r["n_trees"] < 20 for r in rows.values())
    assert rows["train"]["logloss"] < 0.3


def test_points_of_a_search_differ(spark, sf_dir):
    grid = QUERIES["cv_grid_search_rounds"](spark, sf_dir).collect()
    assert len({r["avg_logloss"] for r in grid}) == 4 and sum(r["chosen"] for r in grid) == 1
    trials = QUERIES["hyperparameter_sweep_rounds"](spark, sf_dir).collect()
    assert len({r["logloss"] for r in trials}) == 6 and sum(r["chosen"] for r in trials) == 1
    assert len({r["max_depth"] for r in trials}) > 1
