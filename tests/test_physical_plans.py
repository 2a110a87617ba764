"""The plans that make the operators hold at scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tabloom.operators import registry
from tabloom.queries.base import load
from tabloom.queries.registry import _runs

QUERIES = entry.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _read_columns(plan: str) -> list[set[str]]:
    return [
        {field.split(":")[0] for field in schema.split(",") if field}
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    ]


NO_SHUFFLE = [
    "split_60_20_20", "split_50_50", "kfold_assign", "realtime_feature", "binarize_label",
    "union_with_source_flag", "normalize_column_names", "signature_check",
    "score_table_native", "training_set_multi_lookup", "score_batch_lookup", "assemble_vector",
]


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_row_operators_do_not_shuffle(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    assert not re.search(r"Exchange (hash|range|round|Single)", plan)


@pytest.mark.parametrize(
    "name",
    ["boxplot_stats_ranked", "metric_auc_ranked", "training_set_lookup_skewed",
     "feature_table_upsert_layered", "null_report", "resolve_model_uri", "registry_after_delete",
     "add_row_id", "param_grid", "numeric_histogram"],
)
def test_nothing_is_joined_all_to_all(spark, sf_dir, name):
    assert not re.search("NestedLoop|Cartesian", _plan(QUERIES[name](spark, sf_dir)))


def test_only_python_models_use_python(spark, sf_dir):
    assert "Arrow" in _plan(QUERIES["score_table_pandas_udf"](spark, sf_dir))
    for name in ("score_table_native", "pipeline_predict", "predict_probability", "classify"):
        assert not re.search("Python|Arrow", _plan(QUERIES[name](spark, sf_dir)))


def test_filter_reaches_the_scan(spark, sf_dir):
    plan = _plan(registry.search_runs(_runs(spark, sf_dir), run_name="click").select("run_id"))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan
    assert _read_columns(plan) == [{"event_id", "event_type"}]


def test_metrics_read_only_their_columns(spark, sf_dir):
    plan = _plan(QUERIES["metric_rmse"](spark, sf_dir))
    assert _read_columns(plan) == [{"l_quantity", "l_extendedprice", "l_returnflag"}]
    assert plan.count("Exchange") == 1


def test_lookup_reads_only_requested_features(spark, sf_dir):
    plan = _plan(QUERIES["training_set_multi_lookup"](spark, sf_dir))
    assert {"p_partkey", "p_size", "p_retailprice"} in _read_columns(plan)


def test_profile_scans_once(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem")
    from tabloom.operators.profiling import null_report

    assert _plan(null_report(rows)).count("FileScan") == 1


def test_window_partitions_are_bounded(spark, sf_dir):
    # A window over everything in one task is allowed on per-partition totals only.
    assert "Exchange" not in _plan(QUERIES["split_exact"](spark, sf_dir))
    for name in ("add_row_id", "runs_ranked"):
        plan = _plan(QUERIES[name](spark, sf_dir))
        single = plan[plan.index("Exchange SinglePartition"):]
        assert "__part" in single.splitlines()[1] and "HashAggregate" in single.splitlines()[1]
