"""Forecast a count from calendar columns with cross-validated boosted trees."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame

from tabloom.functions import metrics
from tabloom.operators import columns, evaluation, models, scoring, splits, stages, tuning


@dataclass(frozen=True)
class DemandForecast:
    model: PipelineModel
    trials: DataFrame
    predictions: DataFrame
    metrics: dict[str, float]
    residuals: DataFrame


def forecast_demand(
    df: DataFrame,
    key: str,
    label: str,
    drop: Sequence[str] = (),
    hour: str = "hr",
    grid: dict[str, Sequence] | None = None,
    folds: int = 3,
    seed: int = 0,
    parallelism: int = 4,
) -> DemandForecast:
    """Drop leakage, split 70/30, tune over folds of the training part, evaluate.

    ``key`` decides splits and folds and is not trained on; ``drop`` names
    columns that give the label away or say nothing.
    """
    grid = grid or tuning.BOOSTING_GRID
    rows = columns.drop_columns(df, drop)
    features = columns.feature_columns(rows, [label, key])
    split = splits.hash_split(rows, [key], {"train": 0.7, "test": 0.3}, seed)
    train = splits.kfold(split.where("split = 'train'"), [key], folds, seed)

    # Assembling and category detection do not look at the label: done once, not per fold.
    preparing = models.fit(train, _prepare(features))
    fitted, trials = tuning.cross_validate(
        preparing.transform(train).select(label, "features", "fold"),
        models.boosted_regressor(label, seed=seed),
        grid,
        RegressionEvaluator(labelCol=label, metricName="rmse"),
        "fold",
        folds,
        parallelism,
    )
    model = PipelineModel([*preparing.stages, fitted.bestModel])
    predictions = columns.with_residual(
        scoring.predict(split.where("split = 'test'"), model), label
    )
    summary = evaluation.evaluate(
        predictions,
        {
            "rmse": metrics.rmse(label, "prediction"),
            "r2": metrics.r2(label, "prediction"),
            "mean_residual": metrics.mean_of("residual"),
            "mean_label": metrics.mean_of(label),
        },
    ).first()
    return DemandForecast(
        model,
        trials,
        predictions,
        summary.asDict(),
        evaluation.residual_profile(predictions, hour),
    )


def _prepare(features: Sequence[str]) -> Pipeline:
    return Pipeline(stages=[stages.assembler(features), stages.category_indexer(4)])
