"""Train on looked-up features and score rows that carry only keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator
from pyspark.sql import DataFrame

from tabloom.functions import metrics
from tabloom.operators import evaluation, features, models, scoring, splits
from tabloom.operators.features import FeatureLookup
from tabloom.operators.registry import ModelRegistry


@dataclass(frozen=True)
class FeatureModel:
    run_id: str
    version: int
    metrics: dict[str, float]


def train_on_lookups(
    registry: ModelRegistry,
    labelled: DataFrame,
    lookups: Sequence[FeatureLookup],
    label: str,
    key: Sequence[str],
    model_name: str,
    estimator: Estimator | None = None,
    seed: int = 42,
) -> FeatureModel:
    """Build the training set by key, fit on 80 %, log errors on the rest, register.

    The keys are looked up by but not trained on.  The lookups are saved beside
    the model.
    """
    training = features.create_training_set(labelled, lookups, label, exclude_columns=())
    used = [c for c in training.feature_names if c not in key]
    rows = splits.hash_split(
        training.load_df(), key, {"train": 0.8, "test": 0.2}, seed, output="split"
    )
    estimator = estimator or models.forest_regressor(label, seed=seed)
    train = rows.where("split = 'train'")
    model = models.fit(train, models.pipeline(used, estimator, None))
    scored = scoring.predict(rows.where("split = 'test'"), model)
    measured = evaluation.evaluate(
        scored,
        {
            "test_mse": metrics.mse(label, "prediction"),
            "test_r2_score": metrics.r2(label, "prediction"),
        },
    ).first()
    path = registry.store_model(model, scoring.infer_signature(rows, used), training.recipe)
    found = {k: v for k, v in measured.asDict().items() if v is not None}
    run_id = registry.log_run("train_on_lookups", {}, found, {"model": path})
    version = registry.register_model(f"runs:/{run_id}/model", model_name)
    return FeatureModel(run_id, version, found)


def score_latest(registry: ModelRegistry, model_name: str, batch: DataFrame) -> DataFrame:
    """Score with the greatest registered version, fetching its features by key."""
    version = registry.latest_version(model_name)
    return scoring.score_saved(batch, registry.load(f"models:/{model_name}/{version}"))
