"""Two classifiers for a text label, the better one promoted by alias."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame

from tabloom.functions import metrics
from tabloom.operators import models, scoring, splits, stages
from tabloom.operators.registry import ModelRegistry


@dataclass(frozen=True)
class Candidate:
    run_name: str
    artifact: str
    estimator: Estimator
    params: dict


def standard_candidates(label_index: str = "label_index") -> list[Candidate]:
    tree, forest = models.TREE_CLASSIFIER, models.FOREST_CLASSIFIER
    return [
        Candidate(
            "shallow_tree",
            "tree",
            models.tree_classifier(label_index),
            {"max_depth": tree["maxDepth"], "model_type": "tree", "random_state": tree["seed"]},
        ),
        Candidate(
            "shallow_forest",
            "forest",
            models.forest_classifier(label_index),
            {
                "max_depth": forest["maxDepth"],
                "model_type": "ensemble",
                "random_state": forest["seed"],
                "n_estimators": forest["numTrees"],
            },
        ),
    ]


def accuracy_of(model: PipelineModel, df: DataFrame, label: str) -> float:
    scored = model.transform(df)
    return scored.agg(metrics.accuracy(label, "predicted_label")).first()[0]


def train_candidates(
    registry: ModelRegistry,
    df: DataFrame,
    key: Sequence[str],
    features: Sequence[str],
    label: str,
    model_name: str,
    candidates: Sequence[Candidate] | None = None,
    seed: int = 42,
) -> dict[int, float]:
    """Fit each candidate on half the rows, log and register it, move the alias on.

    Labels are indexed over all rows, so that a class seen only in the test half
    is known; a saved model decodes its predictions back to class names.
    Returns accuracy on the other half per registered version.
    """
    split = splits.hash_split(df, key, {"train": 0.5, "test": 0.5}, seed)
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    indexer = stages.label_indexer(label).fit(df)
    decoder = stages.label_decoder(indexer)
    indexed = indexer.transform(train)
    results: dict[int, float] = {}
    for candidate in candidates or standard_candidates():
        fitted = models.fit(indexed, models.pipeline(features, candidate.estimator, None))
        model = PipelineModel([*fitted.stages, decoder])
        accuracy = accuracy_of(model, test, label)
        path = registry.store_model(model, scoring.infer_signature(df, features))
        registry.log_run(
            candidate.run_name,
            candidate.params,
            {"accuracy": accuracy},
            {candidate.artifact: path},
        )
        run_id = registry.latest_run(candidate.run_name)
        version = registry.register_model(f"runs:/{run_id}/{candidate.artifact}", model_name)
        registry.set_tag(model_name, "validation_status", "approved", version)
        registry.set_alias(model_name, "champion", version)
        if results:
            registry.set_alias(model_name, "archived", max(results))
        results[version] = accuracy
    registry.set_tag(model_name, "task", "classification")
    return results


def champion_accuracy(
    registry: ModelRegistry, model_name: str, test: DataFrame, label: str
) -> float:
    saved = registry.load(f"models:/{model_name}@champion")
    rows = scoring.check_signature(test, saved.signature)
    return accuracy_of(saved.pipeline, rows, label)
