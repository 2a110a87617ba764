"""Tree models in a pipeline, with every seed and depth stated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    RandomForestClassifier,
)
from pyspark.ml.param import Params
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.stages import assembler, category_indexer
from tabloom.session import iterated, merged, shared_dir

# Spark's trees stop at this depth.
MAX_DEPTH = 30

# The model settings this toolkit has to reproduce.
FOREST_REGRESSOR = {
    "maxDepth": 3, "numTrees": 20, "seed": 42, "featureSubsetStrategy": "all"
}
TREE_CLASSIFIER = {"maxDepth": 4, "seed": 42}
FOREST_CLASSIFIER = {"maxDepth": 4, "numTrees": 100, "seed": 42}
FOREST_CLASSIFIER_EXERCISE = {"maxDepth": 10, "numTrees": 50, "seed": 42}
BASELINE_FOREST = {"maxDepth": MAX_DEPTH, "numTrees": 10, "seed": 123}
BOOSTED_ROUNDS = 1000
PATIENCE = 50


def boosted_regressor(label: str, **params) -> GBTRegressor:
    return GBTRegressor(labelCol=label, **{"seed": 0, **params})


def tree_regressor(label: str, **params) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(labelCol=label, **{"seed": 0, **params})


def forest_regressor(label: str, **params) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, **{**FOREST_REGRESSOR, **params})


def tree_classifier(label: str, **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, **{**TREE_CLASSIFIER, **params})


def forest_classifier(label: str, **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, **{**FOREST_CLASSIFIER, **params})


def baseline_forest(label: str, **params) -> RandomForestClassifier:
    """Binary forest whose depth is bounded only by what Spark's trees allow."""
    return RandomForestClassifier(labelCol=label, **{**BASELINE_FOREST, **params})


def boosted_classifier(
    label: str, validation_flag: str | None = None, **params
) -> GBTClassifier:
    """Binary boosted trees.  With a boolean ``validation_flag`` column, rounds end
    once the loss on the flagged rows gains less than ``validationTol`` of itself.

    The tolerance here is 0, so that only a loss that grows ends the rounds: at a
    low learning rate no single round gains much.
    """
    settings = {"seed": 123, **params}
    if validation_flag is not None:
        settings = {"maxIter": BOOSTED_ROUNDS, "validationTol": 0.0, **settings}
        settings["validationIndicatorCol"] = validation_flag
    return GBTClassifier(labelCol=label, **settings)


def pipeline(
    features: Sequence[str],
    estimator: Estimator,
    max_categories: int | None = 4,
    handle_invalid: str = "keep",
) -> Pipeline:
    """Assemble, index small categories, fit; ``None`` leaves all slots numeric."""
    if max_categories is None:
        stages = [assembler(features, "features", handle_invalid)]
    else:
        stages = [
            assembler(features, handle_invalid=handle_invalid),
            category_indexer(max_categories),
        ]
    return Pipeline(stages=[*stages, estimator])


def merge_repeats(
    df: DataFrame, columns: Sequence[str], weight: str = "n_rows"
) -> DataFrame:
    """Rows equal in features and label as one row with its count, for ``weightCol``.

    Trees fitted without row sampling come out the same, and with coarse features
    and labels they read a small table instead of all rows.  The count combines
    before the shuffle, so repeated rows cost next to nothing.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(weight))


# The column of counts that fits over merged rows are given.
WEIGHT = "__n_equal"


def takes_merged_rows(estimator: Estimator, varied: Sequence[str] = ()) -> bool:
    """Whether a fit over different rows, weighted by their counts, is the fit over all rows.

    True of boosted trees that sample no rows, have no weights of their own and do not ask how
    many rows a node holds; ``varied`` names the parameters that a search sets.
    """
    if not isinstance(estimator, (GBTClassifier, GBTRegressor)) or {"subsamplingRate", "minInstancesPerNode", "weightCol"} & set(varied):
        return False
    own = {n: estimator.getOrDefault(n) for n in ("subsamplingRate", "minInstancesPerNode")}
    return own == {"subsamplingRate": 1.0, "minInstancesPerNode": 1} and not estimator.isDefined("weightCol")


def fit(df: DataFrame, stages: Pipeline) -> PipelineModel:
    """Fit with a checkpoint folder in place: boosting cuts its lineage there.

    Only the columns that the stages name are kept for the fit.
    """
    shared_dir(df.sparkSession)
    used = input_columns(stages.getStages())
    with iterated(df.select(*(c for c in df.columns if c in used))) as rows:
        return stages.fit(rows)


def patient_best(losses: Sequence[float], patience: int, least_gain: float) -> tuple[int, bool]:
    """The best round (from 1), and whether ``patience`` rounds went by without a gain.

    A gain is a loss lower than the best so far by more than ``least_gain``.
    Rounds after the patience ran out do not count.
    """
    best, lowest = 1, losses[0]
    for k, loss in enumerate(losses, start=1):
        if loss < lowest - least_gain:
            best, lowest = k, loss
        elif k - best >= patience:
            return best, True
    return best, False


def fit_with_patience(
    df: DataFrame,
    stages: Pipeline,
    held_out: str,
    patience: int = PATIENCE,
    max_rounds: int = BOOSTED_ROUNDS,
    least_gain: float = 1e-9,
) -> PipelineModel:
    """Boost until the loss on held-out rows has not gained for ``patience`` rounds.

    The last stage is a boosted classifier or regressor; the model returned has
    the rounds up to the best one, ``max_rounds`` at most.  Rows whose boolean
    ``held_out`` is null are trained on.  Rounds are fitted in attempts of
    doubling length, each judged in one pass over the held-out rows, so that all
    attempts together cost less than five times the rounds needed.  The seed
    being fixed, a shorter fit has the first trees of a longer one.  Without
    held-out rows there is nothing to wait for: an error.  Rows equal in what the fit
    reads are one row with a weight, if that is the same fit.
    """
    shared_dir(df.sparkSession)
    *before, booster = stages.getStages()
    used = input_columns(stages.getStages()) | {held_out}
    narrow = df.select(*(c for c in df.columns if c in used))
    if not takes_merged_rows(booster):
        with iterated(narrow) as rows:
            prepared = Pipeline(stages=before).fit(rows)
            return _patient(rows, prepared, booster, held_out, patience, max_rounds, least_gain)
    if any(isinstance(s, Estimator) for s in before):
        with iterated(narrow) as rows:
            prepared = Pipeline(stages=before).fit(rows)
    else:
        prepared = Pipeline(stages=before).fit(narrow)
    weighted = booster.copy({booster.weightCol: WEIGHT})
    with merged(narrow, WEIGHT) as rows:
        return _patient(rows, prepared, weighted, held_out, patience, max_rounds, least_gain)


def _patient(
    rows: DataFrame, prepared: PipelineModel, booster: Estimator, held_out: str, patience: int, max_rounds: int, least_gain: float
) -> PipelineModel:
    flag = F.coalesce(F.col(held_out), F.lit(False))
    train, validation = (prepared.transform(rows.where(f)) for f in (~flag, flag))
    if validation.isEmpty():
        raise ValueError(f"no row is marked in {held_out}")

    def boosted(rounds: int):
        return booster.copy({booster.maxIter: rounds}).fit(train)

    rounds = min(max_rounds, patience + patience // 4 + 1)
    while True:
        model = boosted(rounds)
        loss = [booster.getLossType()] if isinstance(booster, GBTRegressor) else []
        losses = model.evaluateEachIteration(validation, *loss)
        best, ended = patient_best(losses, patience, least_gain)
        if ended or rounds == max_rounds:
            break
        rounds = min(max_rounds, 2 * rounds)
    if best < rounds:
        model = boosted(best)
    return PipelineModel([*prepared.stages, model])


def input_columns(stages: Sequence[Params]) -> set[str]:
    used: set[str] = set()
    for s in stages:
        for name in ("inputCol", "labelCol", "featuresCol", "weightCol", "validationIndicatorCol"):
            if s.hasParam(name) and s.isDefined(name):
                used.add(s.getOrDefault(name))
        if s.hasParam("inputCols") and s.isDefined("inputCols"):
            used.update(s.getOrDefault("inputCols"))
    return used


def feature_importance(df: DataFrame, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Importance per feature name, greatest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(features, values, strict=True)]
    frame = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature")
