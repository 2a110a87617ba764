from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import functions as F

from tabloom.functions import metrics
from tabloom.operators.evaluation import auc, evaluate


def _scored(spark, rows):
    return spark.createDataFrame(rows, "y double, p double")


def _auc(df, **kwargs):
    return auc(df, "y", "p", **kwargs).first()["auc"]


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(3000):
        y = float(rng.random() < 0.3)
        rows.append((y, round(min(0.99, max(0.01, 0.3 * y + rng.random() * 0.7)), 2)))
    return _scored(spark, rows)


@pytest.mark.parametrize("small_rows", [0, 1_000_000])
def test_auc_matches_the_built_in(spark, noisy, small_rows):
    built_in = BinaryClassificationEvaluator(
        rawPredictionCol="p", labelCol="y", numBins=0
    ).evaluate(noisy)
    assert abs(_auc(noisy, small_rows=small_rows) - built_in) < 1e-12


@pytest.mark.parametrize("small_rows", [0, 1_000_000])
def test_auc_edges(spark, small_rows):
    def area(rows):
        return _auc(_scored(spark, rows), small_rows=small_rows)

    assert area([(1.0, 0.3), (1.0, 0.4)]) is None
    assert area([(0.0, 0.3)]) is None
    assert area([(0.0, 0.5), (1.0, 0.5), (1.0, 0.5)]) == 0.5
    assert area([(0.0, 0.1), (1.0, 0.9)]) == 1.0
    assert area([(0.0, 0.9), (1.0, 0.1)]) == 0.0
    assert area([(0.0, 0.1), (1.0, 0.9), (None, 0.5), (1.0, None)]) == 1.0
    assert area([(0.0, 0.2), (1.0, 0.1), (1.0, float("nan")), (2.0, 0.05)]) == 0.0


def test_auc_of_nothing(spark):
    assert _auc(_scored(spark, [])) is None
    assert auc(_scored(spark, []), "y", "p", ["y"]).count() == 0


def test_regression_metrics_match_the_built_in(spark, noisy):
    got = evaluate(noisy, {"rmse": metrics.rmse("y", "p"), "mse": metrics.mse("y", "p"),
                           "r2": metrics.r2("y", "p")}).first()
    for name in ("rmse", "mse", "r2"):
        want = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(noisy)
        assert abs(got[name] - want) < 1e-9


def test_r2_edges(spark):
    assert evaluate(_scored(spark, [(2.0, 1.0), (2.0, 3.0)]), {"r2": metrics.r2("y", "p")}).first()[0] is None
    known = [(1.0, 1.0), (2.0, 2.5)]
    with_gap = [*known, (9.0, None), (None, 4.0)]
    a, b = (evaluate(_scored(spark, r), {"r2": metrics.r2("y", "p")}).first()[0] for r in (known, with_gap))
    assert abs(a - b) < 1e-12


def test_metrics_of_nothing_are_null(spark):
    all_ = {"rmse": metrics.rmse("y", "p"), "mse": metrics.mse("y", "p"), "r2": metrics.r2("y", "p"),
            "accuracy": metrics.accuracy("y", "p"), "logloss": metrics.logloss("y", "p")}
    assert list(evaluate(_scored(spark, []), all_).first()) == [None] * 5


def test_accuracy_matches_the_built_in(spark, noisy):
    hard = noisy.withColumn("c", (F.col("p") >= 0.5).cast("double"))
    want = MulticlassClassificationEvaluator(
        labelCol="y", predictionCol="c", metricName="accuracy").evaluate(hard)
    assert abs(evaluate(hard, {"a": metrics.accuracy("y", "c")}).first()[0] - want) < 1e-12


def test_logloss_clips(spark):
    sure_and_wrong = evaluate(_scored(spark, [(1.0, 0.0)]), {"l": metrics.logloss("y", "p")}).first()[0]
    assert math.isfinite(sure_and_wrong) and sure_and_wrong > 30
    half = evaluate(_scored(spark, [(1.0, 0.5), (0.0, 0.5)]), {"l": metrics.logloss("y", "p")}).first()[0]
    assert abs(half - math.log(2)) < 1e-12
