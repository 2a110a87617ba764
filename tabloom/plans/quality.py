"""From two raw tables to a promoted binary classifier and bulk predictions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import boosting, columns, evaluation, models, profiling, scoring, splits, stages, tuning
from tabloom.operators.registry import ModelRegistry, best_run, search_runs
from tabloom.session import cached

SPLITS = {"train": 0.6, "validation": 0.2, "test": 0.2}


@dataclass(frozen=True)
class Profile:
    histogram: DataFrame
    boxes: DataFrame
    separation: DataFrame
    missing: DataFrame


def prepare(
    first: DataFrame, second: DataFrame, flag: str, label: str, threshold: float
) -> DataFrame:
    """Both tables as one, names made safe, label turned into 0/1."""
    both = columns.normalize_names(columns.union_flagged(first, second, flag))
    return both.withColumn(label, columns.binarize(label, threshold))


def profile(df: DataFrame, features: Sequence[str], label: str) -> Profile:
    boxes = profiling.boxplot_stats(df, features, label)
    return Profile(
        profiling.value_histogram(df, label),
        boxes,
        profiling.median_separation(boxes),
        profiling.null_report(df),
    )


def _auc(df: DataFrame, model: PipelineModel, label: str) -> float:
    scored = scoring.predict_probability(df, model, "score")
    return evaluation.auc(scored, label, "score").first()["auc"]


def train_baseline(
    registry: ModelRegistry,
    split: DataFrame,
    features: Sequence[str],
    label: str,
    model_name: str,
    max_depth: int = models.MAX_DEPTH,
) -> tuple[int, float]:
    """Untuned forest judged by AUC on the test part; registered as the champion."""
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    forest = models.baseline_forest(label, maxDepth=max_depth)
    model = models.fit(train, models.pipeline(features, forest, None))
    area = _auc(test, model, label)
    path = registry.store_model(model, scoring.infer_signature(split, features))
    run_id = registry.log_run(
        "baseline_forest",
        {"n_estimators": forest.getNumTrees()},
        {"auc": area},
        {"model": path},
    )
    version = registry.register_model(f"runs:/{run_id}/model", model_name)
    registry.set_tag(model_name, "task", "classification")
    registry.set_tag(model_name, "validation_status", "approved", version)
    registry.set_alias(model_name, "champion", version)
    registry.set_stage(model_name, version, "Production")
    return version, area


def tune(
    registry: ModelRegistry,
    split: DataFrame,
    features: Sequence[str],
    label: str,
    max_evals: int = 30,
    rounds: int = models.BOOSTED_ROUNDS,
    max_depth: int = 100,
    space: dict | None = None,
    seed: int = 123,
    patience: int = models.PATIENCE,
) -> str:
    """Sweep regularised boosted trees over sampled trials; returns the id of the parent run.

    All trials grow side by side and share every scan of the rows.  Each ends once
    ``patience`` rounds brought no gain on the validation part, keeps its trees up to the
    best round, and is judged by AUC there.
    """
    space = space or tuning.BOOSTING_SPACE
    spark = split.sparkSession
    prepare_features = models.fit(split, _features_only(features))
    prepared = prepare_features.transform(split.where("split <> 'test'")).select(
        label, "features", (F.col("split") == "validation").cast("int").alias("held_out")
    )
    drawn = tuning.draw_trials(spark.range(max_evals), "id", space, seed).orderBy("id").collect()
    trials = [{k: v for k, v in r.asDict().items() if k != "id"} for r in drawn]
    settings = [tuning.regularized_params(t, rounds, max_depth) for t in trials]
    fitted = boosting.fit_boosted(
        prepared, "features", label, settings, "held_out", [1] * len(settings), patience
    )

    parent = registry.log_run("boosted_models", {"max_evals": max_evals})
    signature = scoring.infer_signature(split, features)
    runs = []
    with cached(prepared.where("held_out = 1")) as validation:
        for trial, used, found in zip(trials, settings, fitted, strict=True):
            model = boosting.RegularizedBoosterModel(found)
            scored = model.transform(validation).select(
                label, scoring.positive_probability().alias("score")
            )
            params = {**trial, "max_depth": used.max_depth}
            if used.max_depth != trial["max_depth"]:
                params["drawn_max_depth"] = trial["max_depth"]
            whole = PipelineModel([*prepare_features.stages, model])
            runs.append(
                {
                    "run_name": "boosted_model",
                    "params": params,
                    "metrics": {
                        "auc": evaluation.auc(scored, label, "score").first()["auc"],
                        "n_trees": float(model.getNumTrees),
                    },
                    "artifacts": {"model": registry.store_model(whole, signature)},
                    "parent_run_id": parent,
                }
            )
    registry.log_runs(runs)
    return parent


def _features_only(features: Sequence[str]) -> Pipeline:
    return Pipeline(stages=[stages.assembler(features, "features")])


def promote_best(
    registry: ModelRegistry, parent_run_id: str, model_name: str, replaces: int
) -> int:
    """Register the best child of a sweep and move alias and stage over to it."""
    best = best_run(registry.table("runs"), "auc", parent_run_id).first()
    version = registry.register_model(f"runs:/{best['run_id']}/model", model_name)
    registry.set_alias(model_name, "champion", version)
    registry.set_alias(model_name, "archived", replaces)
    registry.set_stage(model_name, replaces, "Archived")
    registry.set_stage(model_name, version, "Production")
    return version


def champion_auc(registry: ModelRegistry, model_name: str, test: DataFrame, label: str) -> float:
    """AUC of whatever the alias points at now; callers need not change after a promotion."""
    return _auc(test, registry.load(f"models:/{model_name}@champion").pipeline, label)


def score_table(registry: ModelRegistry, model_name: str, batch: DataFrame) -> DataFrame:
    """Every row of a batch with its probability, by the champion."""
    saved = registry.load(f"models:/{model_name}@champion")
    return scoring.predict_probability(
        scoring.check_signature(batch, saved.signature), saved.pipeline
    )


def trial_correlations(registry: ModelRegistry, parent_run_id: str) -> DataFrame:
    children = search_runs(registry.table("runs"), parent_run_id=parent_run_id)
    return tuning.param_metric_corr(children, "auc")


def split_rows(df: DataFrame, key: Sequence[str], seed: int = 123) -> DataFrame:
    return splits.hash_split(df, key, SPLITS, seed)
