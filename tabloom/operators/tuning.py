"""Parameter grids, sampled trials, cross-validation and parallel sweeps."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from itertools import product
from math import inf, isnan, sqrt

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.hashing import hash01
from tabloom.operators import models
from tabloom.operators.boosting import BoostParams
from tabloom.session import cached, merged, shared_dir

# The grid and the search space this toolkit has to reproduce.
BOOSTING_GRID = {"maxDepth": [2, 5], "maxIter": [10, 100]}


@dataclass(frozen=True)
class QUniform:
    """Uniform on [low, high], rounded to a multiple of ``step``."""

    low: float
    high: float
    step: float = 1.0

    def draw(self, u: Column) -> Column:
        value = F.lit(float(self.low)) + F.lit(float(self.high - self.low)) * u
        return F.rint(value / F.lit(float(self.step))) * F.lit(float(self.step))


@dataclass(frozen=True)
class LogUniform:
    """exp of a uniform number on [low, high]."""

    low: float
    high: float

    def draw(self, u: Column) -> Column:
        return F.exp(F.lit(float(self.low)) + F.lit(float(self.high - self.low)) * u)


@dataclass(frozen=True)
class Constant:
    value: object

    def draw(self, u: Column) -> Column:
        return F.lit(self.value)


# The search space this toolkit has to reproduce.
BOOSTING_SPACE = {
    "max_depth": QUniform(4, 100, 1),
    "learning_rate": LogUniform(-3, 0),
    "reg_alpha": LogUniform(-5, -1),
    "reg_lambda": LogUniform(-6, -1),
    "min_child_weight": LogUniform(-1, 3),
    "objective": Constant("binary:logistic"),
    "seed": Constant(123),
}


def boosting_params(trial: dict, max_depth: int = 30) -> dict:
    """Nearest Spark ML settings of a sampled trial.

    The two regularisation strengths have no counterpart there; ``regularized_params`` has.
    """
    return {
        "maxDepth": int(min(max_depth, trial["max_depth"])),
        "stepSize": float(min(1.0, trial["learning_rate"])),
        "minInstancesPerNode": max(1, round(trial["min_child_weight"])),
        "seed": int(trial["seed"]),
    }


def fitted_params(trial: dict, max_depth: int = 30) -> dict:
    """What to log of a trial: the values that were fitted, under the drawn names.

    A draw that Spark ML cannot take as it is stays beside it as ``drawn_...``.
    """
    used = boosting_params(trial, max_depth)
    fitted = {
        "max_depth": used["maxDepth"],
        "learning_rate": used["stepSize"],
        "min_child_weight": used["minInstancesPerNode"],
        "seed": used["seed"],
    }
    drawn = {f"drawn_{k}": trial[k] for k, v in fitted.items() if trial[k] != v}
    return {**trial, **fitted, **drawn}


def regularized_params(trial: dict, rounds: int, max_depth: int = 100) -> BoostParams:
    """A sampled trial as settings of the second-order booster, which takes every draw as it is."""
    return BoostParams(
        rounds=rounds,
        max_depth=int(min(max_depth, trial["max_depth"])),
        learning_rate=float(trial["learning_rate"]),
        reg_alpha=float(trial.get("reg_alpha", 0.0)),
        reg_lambda=float(trial.get("reg_lambda", 1.0)),
        min_child_weight=float(trial["min_child_weight"]),
    )


def default_parallelism(trials: int) -> int:
    """Square root of the number of trials, the usual balance for a sweep."""
    return max(1, round(sqrt(trials)))


def grid_points(grid: dict[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]


def param_maps(estimator: Estimator, grid: dict[str, Sequence]) -> list[dict]:
    """The grid as Spark ML parameter maps."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def with_grid(df: DataFrame, grid: dict[str, Sequence], trial: str = "trial") -> DataFrame:
    """Each row once per grid point, with the trial number and its parameters."""
    points = [
        F.struct(F.lit(i).alias(trial), *(F.lit(v).alias(k) for k, v in point.items()))
        for i, point in enumerate(grid_points(grid))
    ]
    return df.select("*", F.inline(F.array(*points)))


def draw_trials(df: DataFrame, id_col: str, space: dict, seed: int) -> DataFrame:
    """One draw from the search space for each row; the row's id fixes the draw."""
    return df.select(
        "*",
        *(dist.draw(hash01(seed, id_col, F.lit(name))).alias(name) for name, dist in space.items()),
    )


def cross_validate(
    df: DataFrame,
    estimator: Estimator,
    grid: dict[str, Sequence],
    evaluator: Evaluator,
    fold_col: str,
    folds: int = 3,
    parallelism: int = 4,
) -> tuple[CrossValidatorModel, DataFrame]:
    """Grid search over given folds, refit on all rows.

    Returns the fitted model and one row per grid point with its mean metric.
    Fits run side by side; each one is itself distributed.  Rows equal in what fits and
    evaluator read are one row with a weight, if that gives the same fits.
    """
    spark = df.sparkSession
    shared_dir(spark)
    rows = cached(df)
    weighs = isinstance(evaluator, (MulticlassClassificationEvaluator, RegressionEvaluator)) and not evaluator.isDefined("weightCol")
    if weighs and models.takes_merged_rows(estimator, list(grid)):
        used = models.input_columns([estimator, evaluator]) | {fold_col, evaluator.getPredictionCol()}
        if isinstance(evaluator, MulticlassClassificationEvaluator):
            used.add(evaluator.getProbabilityCol())
        rows = merged(df.select(*(c for c in df.columns if c in used)), models.WEIGHT)
        estimator, evaluator = (x.copy({x.getParam("weightCol"): models.WEIGHT}) for x in (estimator, evaluator))
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=param_maps(estimator, grid),
        evaluator=evaluator,
        numFolds=folds,
        foldCol=fold_col,
        parallelism=parallelism,
        seed=0,
    )
    with rows as kept:
        fitted = validator.fit(kept)
    rows = [
        (i, {k: str(v) for k, v in point.items()}, float(metric))
        for i, (point, metric) in enumerate(
            zip(grid_points(grid), fitted.avgMetrics, strict=True)
        )
    ]
    trials = spark.createDataFrame(
        rows, "trial int, params map<string,string>, avg_metric double"
    )
    return fitted, trials


@dataclass(frozen=True)
class Trial:
    """One fitted candidate of a sweep."""

    number: int
    params: dict
    model: Model | None
    metrics: dict[str, float]
    path: str | None = None

    def loss(self, metric: str) -> float:
        """What a minimiser would see for a metric that should be large.

        A metric that could not be measured (null or NaN) is the worst there is.
        """
        value = self.metrics[metric]
        return inf if value is None or isnan(value) else -1.0 * value


def sweep(
    train: DataFrame,
    trials: Sequence[dict],
    build: Callable[[dict], Estimator],
    measure: Callable[[Model], dict[str, float]],
    parallelism: int | None = None,
    store: Callable[[Model], str] | None = None,
) -> list[Trial]:
    """Fit every trial over one cached frame, a bounded number at a time.

    The threads only submit jobs; each fit is a distributed Spark ML fit.  With ``store``
    a model is saved as soon as it is measured, and only what ``store`` returns (its path)
    is kept of it.  What trials stage belongs to the caller's scope.
    """
    shared_dir(train.sparkSession)
    with cached(train) as rows:

        def run(numbered: tuple[int, dict]) -> Trial:
            number, params = numbered
            model = build(params).fit(rows)
            metrics = measure(model)
            if store is None:
                return Trial(number, params, model, metrics)
            return Trial(number, params, None, metrics, store(model))

        with ThreadPoolExecutor(parallelism or default_parallelism(len(trials))) as pool:
            task = inheritable_thread_target(train.sparkSession)(run)
            # A context can be entered once at a time, so each trial has its own copy.
            scopes = [copy_context() for _ in trials]
            return list(pool.map(lambda scope, t: scope.run(task, t), scopes, enumerate(trials)))


def best_trial(trials: Sequence[Trial], metric: str) -> Trial:
    """The trial with the greatest metric; an error only if no trial has one."""
    best = min(trials, key=lambda t: (t.loss(metric), t.number))
    if best.loss(metric) == inf:
        raise ValueError(f"no trial has a value of {metric}")
    return best


def param_metric_rows(runs: DataFrame, metric: str) -> DataFrame:
    """One row per run and parameter, with the metric beside it."""
    return runs.select(
        "run_id", F.explode("params").alias("param", "value"), F.col("metrics")[metric].alias(metric)
    )


def param_metric_corr(runs: DataFrame, metric: str) -> DataFrame:
    """Correlation of each numeric parameter with a metric across runs."""
    rows = param_metric_rows(runs, metric)
    value = F.expr("try_cast(value AS double)")
    return rows.groupBy("param").agg(
        F.count(value).alias("n_runs"), F.corr(value, F.col(metric)).alias("correlation")
    )
