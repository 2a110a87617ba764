"""Boosting over several rounds, whose rounds, parameters and ends SQL follows.

The label says whether a value exceeds a bar that rises with the hour, so hours
differ and none is pure.  Trees separate all groups; each round then adds the
groups' mean gradients, and rounds, learning rates and held-out losses have an
exact twin.  Bootstrapped forests are random: their queries state what must hold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import metrics
from tabloom.operators import boosting, evaluation, models, scoring, splits, stages, tuning
from tabloom.operators.boosting import BoostParams, RegularizedBoosterModel
from tabloom.operators.tuning import Constant, QUniform
from tabloom.queries.base import (
    HOURLY,
    TEXT_FEATURES,
    hash01_sql,
    hourly,
    load,
    query,
    text_shape,
)
from tabloom.queries.tuning import draw_sql
from tabloom.session import stage

DEEP = {"maxDepth": models.MAX_DEPTH}
SPLITS = {"train": 0.6, "validation": 0.2, "test": 0.2}

_BAR = f"""
barred AS (
  SELECT event_id, CAST(hour(ts) AS INTEGER) AS hr, CAST(hour(ts) // 3 AS INTEGER) AS part,
         CAST(value >= 10 + 2 * hour(ts) AS INTEGER) AS high,
         CASE WHEN {hash01_sql(123, "event_id")} < 0.6 THEN 'train'
              WHEN {hash01_sql(123, "event_id")} < 0.8 THEN 'validation' ELSE 'test' END AS split,
         CAST(floor({hash01_sql(0, "event_id")} * 3) AS INTEGER) AS fold
  FROM events
)
"""


def _barred(spark, sf_dir):
    hr = F.hour("ts")
    rows = load(spark, sf_dir, "events").select(
        "event_id",
        hr.alias("hr"),
        F.floor(hr / 3).cast("int").alias("part"),
        (F.col("value") >= 10 + 2 * hr).cast("int").alias("high"),
    )
    return splits.hash_split(rows, ["event_id"], SPLITS, seed=123)


def _next(step: str) -> str:
    """One round of logistic boosting of a group with ``pos`` and ``neg`` training rows."""
    return f"f + {step} * 4 * (pos / (1 + exp(2 * f)) - neg / (1 + exp(-2 * f))) / (pos + neg)"


# --- rounds until patience runs out -------------------------------------------

_RATE, _GAIN = 0.5, 1e-9

_PATIENT = f"""
{_BAR},
counts AS (
  SELECT part,
         CAST(count(*) FILTER (split = 'train' AND high = 1) AS DOUBLE) AS pos,
         CAST(count(*) FILTER (split = 'train' AND high = 0) AS DOUBLE) AS neg,
         count(*) FILTER (split = 'validation' AND high = 1) AS val_pos,
         count(*) FILTER (split = 'validation' AND high = 0) AS val_neg
  FROM barred GROUP BY part
),
rounds AS (
  SELECT 1 AS k, *, (pos - neg) / (pos + neg) AS f FROM counts
  UNION ALL
  SELECT k + 1, part, pos, neg, val_pos, val_neg, {_next(f"{_RATE}::DOUBLE")}
  FROM rounds WHERE k < {models.BOOSTED_ROUNDS}
),
losses AS (
  SELECT k, 2 * sum(val_pos * ln(1 + exp(-2 * f)) + val_neg * ln(1 + exp(2 * f)))
            / sum(val_pos + val_neg) AS loss
  FROM rounds GROUP BY k
),
waiting AS (
  SELECT 1 AS k, 1 AS best, loss AS lowest FROM losses WHERE k = 1
  UNION ALL
  SELECT l.k, CASE WHEN l.loss < lowest - {_GAIN}::DOUBLE THEN l.k ELSE best END,
         CASE WHEN l.loss < lowest - {_GAIN}::DOUBLE THEN l.loss ELSE lowest END
  FROM waiting w JOIN losses l ON l.k = w.k + 1 WHERE w.k - w.best < {models.PATIENCE}
),
ended AS (SELECT best AS n_trees FROM waiting ORDER BY k DESC LIMIT 1),
rated AS (
  SELECT split, high AS y, 1 / (1 + exp(-2 * f)) AS p, n_trees
  FROM barred JOIN rounds USING (part) JOIN ended ON k = n_trees
)
"""


@query(
    "gbt_early_stop_patience",
    f"""
    WITH RECURSIVE {_PATIENT}
    SELECT split, round(-avg(y * ln(p) + (1 - y) * ln(1 - p)), 6) AS logloss,
           count(*) AS n_rows, CAST(n_trees AS INTEGER) AS n_trees
    FROM rated GROUP BY split, n_trees
    """,
)
def gbt_early_stop_patience(spark, sf_dir):
    """1,000 rounds allowed, ended by 50 without gain on held-out rows; the best is kept."""
    rows = _barred(spark, sf_dir)
    fitting = rows.where("split <> 'test'").withColumn("held_out", F.col("split") == "validation")
    booster = models.boosted_classifier("high", stepSize=_RATE, maxDepth=7)
    model = models.fit_with_patience(
        fitting, models.pipeline(["part"], booster, None), "held_out", least_gain=_GAIN
    )
    scored = scoring.predict_probability(rows, model)
    return scored.groupBy("split").agg(
        F.round(metrics.logloss("high", "prediction"), 6).alias("logloss"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(model.stages[-1].getNumTrees).alias("n_trees"),
    )


# --- regression over several rounds -------------------------------------------

_ABSOLUTE_ROUNDS = 6


def _absolute_sql() -> str:
    """Round 1 fits group means; each later one half the mean sign of what is left."""
    ctes = ["r1 AS (SELECT hr, cnt, avg(cnt) OVER (PARTITION BY hr) AS f FROM hourly)"]
    for k in range(2, _ABSOLUTE_ROUNDS + 1):
        sign = "avg(CASE WHEN cnt >= f THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END)"
        ctes.append(
            f"r{k} AS (SELECT hr, cnt, f + {_RATE}::DOUBLE * {sign} OVER (PARTITION BY hr) AS f"
            f" FROM r{k - 1})"
        )
    return ", ".join(ctes)


@query(
    "gbt_regression_rounds",
    f"""
    WITH {HOURLY}, {_absolute_sql()}
    SELECT hr, count(*) AS n_rows, round(min(f), 6) AS prediction,
           round(avg(abs(cnt - f)), 6) AS mean_error
    FROM r{_ABSOLUTE_ROUNDS} GROUP BY hr
    """,
)
def gbt_regression_rounds(spark, sf_dir):
    """Six rounds on the absolute error, each of which moves the predictions."""
    hours = stage(hourly(spark, sf_dir).select("hr", "cnt"), "hourly")
    booster = models.boosted_regressor(
        "cnt", maxIter=_ABSOLUTE_ROUNDS, stepSize=_RATE, lossType="absolute", **DEEP
    )
    scored = scoring.predict(hours, models.fit(hours, models.pipeline(["hr"], booster, None)))
    return scored.groupBy("hr").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.min("prediction"), 6).alias("prediction"),
        F.round(F.avg(F.abs(F.col("cnt") - F.col("prediction"))), 6).alias("mean_error"),
    )


# --- searches whose points differ ----------------------------------------------

_GRID = {"maxIter": [2, 5], "stepSize": [0.1, 0.5]}
_POINTS = ", ".join(
    f"({i}, {p['maxIter']}, {p['stepSize']}::DOUBLE)"
    for i, p in enumerate(tuning.grid_points(_GRID))
)


@query(
    "cv_grid_search_rounds",
    f"""
    WITH RECURSIVE {_BAR},
    points AS (SELECT * FROM (VALUES {_POINTS}) AS g(trial, max_iter, step)),
    per_fold AS (SELECT fold, hr, CAST(sum(high) AS DOUBLE) AS y, count(*) AS n
                 FROM barred GROUP BY fold, hr),
    counts AS (
      SELECT fold, hr, sum(y) OVER (PARTITION BY hr) - y AS pos,
             sum(n - y) OVER (PARTITION BY hr) - (n - y) AS neg, y AS val_pos, n - y AS val_neg
      FROM per_fold
    ),
    rounds AS (
      SELECT trial, max_iter, step, 1 AS k, counts.*, (pos - neg) / (pos + neg) AS f
      FROM counts CROSS JOIN points
      UNION ALL
      SELECT trial, max_iter, step, k + 1, fold, hr, pos, neg, val_pos, val_neg, {_next("step")}
      FROM rounds WHERE k < max_iter
    ),
    losses AS (
      SELECT trial, max_iter, step, fold,
             sum(val_pos * ln(1 + exp(-2 * f)) + val_neg * ln(1 + exp(2 * f)))
               / sum(val_pos + val_neg) AS loss
      FROM rounds WHERE k = max_iter GROUP BY ALL
    ),
    judged AS (SELECT trial, max_iter, step, avg(loss) AS loss FROM losses GROUP BY ALL)
    SELECT CAST(trial AS INTEGER) AS trial, CAST(max_iter AS VARCHAR) AS max_iter,
           CAST(step AS VARCHAR) AS step_size, round(loss, 6) AS avg_logloss,
           loss = min(loss) OVER () AS chosen
    FROM judged
    """,
)
def cv_grid_search_rounds(spark, sf_dir):
    """Rounds and learning rates by three folds; every point of the grid has another loss."""
    rows = splits.kfold(_barred(spark, sf_dir), ["event_id"], 3, seed=0)
    prepared = stages.assembler(["hr"], "features").transform(rows.select("hr", "high", "fold"))
    fitted, trials = tuning.cross_validate(
        prepared,
        models.boosted_classifier("high", **DEEP),
        _GRID,
        MulticlassClassificationEvaluator(labelCol="high", metricName="logLoss"),
        "fold",
    )
    best = {name: str(fitted.bestModel.getOrDefault(name)) for name in _GRID}
    return trials.select(
        "trial",
        F.col("params")["maxIter"].alias("max_iter"),
        F.col("params")["stepSize"].alias("step_size"),
        F.round("avg_metric", 6).alias("avg_logloss"),
        (
            (F.col("params")["maxIter"] == best["maxIter"])
            & (F.col("params")["stepSize"] == best["stepSize"])
        ).alias("chosen"),
    )


_TRIALS, _SWEEP_ROUNDS = 6, 5
# All parameters; depths that Spark's trees can take and that separate eight groups.
_SPACE = {**tuning.BOOSTING_SPACE, "max_depth": QUniform(8, models.MAX_DEPTH)}
_DRAWN = ", ".join(
    draw_sql(name, dist, "id")
    for name, dist in _SPACE.items()
    if not isinstance(dist, Constant)
)
_LOGGED = ["max_depth", "learning_rate", "min_child_weight", "reg_alpha", "reg_lambda"]


@query(
    "hyperparameter_sweep_rounds",
    f"""
    WITH RECURSIVE {_BAR},
    trials AS (
      SELECT CAST(id AS INTEGER) AS trial, least({models.MAX_DEPTH}, max_depth) AS max_depth,
             least(1.0, learning_rate) AS learning_rate,
             greatest(1.0, round_even(min_child_weight, 0)) AS min_child_weight,
             reg_alpha, reg_lambda
      FROM (SELECT id, {_DRAWN} FROM range({_TRIALS}) AS r(id))
    ),
    counts AS (
      SELECT part,
             CAST(count(*) FILTER (split = 'train' AND high = 1) AS DOUBLE) AS pos,
             CAST(count(*) FILTER (split = 'train' AND high = 0) AS DOUBLE) AS neg,
             count(*) FILTER (split = 'validation' AND high = 1) AS val_pos,
             count(*) FILTER (split = 'validation' AND high = 0) AS val_neg
      FROM barred GROUP BY part
    ),
    rounds AS (
      SELECT trial, learning_rate, 1 AS k, counts.*, (pos - neg) / (pos + neg) AS f
      FROM counts CROSS JOIN trials
      UNION ALL
      SELECT trial, learning_rate, k + 1, part, pos, neg, val_pos, val_neg,
             {_next("learning_rate")}
      FROM rounds WHERE k < {_SWEEP_ROUNDS}
    ),
    last AS (
      SELECT trial, f, val_pos, val_neg,
             sum(val_neg) OVER (PARTITION BY trial ORDER BY f) - val_neg / 2 AS below
      FROM rounds WHERE k = {_SWEEP_ROUNDS}
    ),
    judged AS (
      SELECT trial, sum(val_pos * below) / (sum(val_pos) * sum(val_neg)) AS auc,
             sum(val_pos * ln(1 + exp(-2 * f)) + val_neg * ln(1 + exp(2 * f)))
               / sum(val_pos + val_neg) AS logloss
      FROM last GROUP BY trial
    )
    SELECT trial, {", ".join(f"round({c}, 6) AS {c}" for c in _LOGGED)},
           round(auc, 6) AS auc, round(logloss, 6) AS logloss,
           logloss = min(logloss) OVER () AS chosen
    FROM judged JOIN trials USING (trial)
    """,
)
def hyperparameter_sweep_rounds(spark, sf_dir):
    """Trials over the whole search space, fitted side by side, with what was fitted of each.

    Their trees separate the eight parts of the day, so the learning rate alone
    decides the loss on the validation split; the least one is chosen.
    """
    rows = _barred(spark, sf_dir)
    prepared = stages.assembler(["part"], "features").transform(rows)
    train = prepared.where("split = 'train'").select("high", "features")
    validation = prepared.where("split = 'validation'")
    ids = spark.range(_TRIALS)
    drawn = tuning.draw_trials(ids, "id", _SPACE, seed=123).orderBy("id").collect()

    def build(trial):
        return models.boosted_classifier(
            "high", maxIter=_SWEEP_ROUNDS, **tuning.boosting_params(trial)
        )

    def measure(model):
        scored = stage(
            model.transform(validation).select("high", scoring.positive_probability().alias("p")),
            "sweep-scores",
        )
        loss = scored.agg(metrics.logloss("high", "p").alias("loss")).first()["loss"]
        area = evaluation.auc(scored, "high", "p").first()["auc"]
        return {"auc": area, "logloss": loss, "gain": -loss}

    done = tuning.sweep(train, [r.asDict() for r in drawn], build, measure)
    chosen = tuning.best_trial(done, "gain").number
    results = []
    for t in done:
        fitted = tuning.fitted_params(t.params)
        measured = (t.metrics["auc"], t.metrics["logloss"], t.number == chosen)
        results.append((t.number, *(float(fitted[c]) for c in _LOGGED), *measured))
    numbers = ", ".join(f"{c} double" for c in [*_LOGGED, "auc", "logloss"])
    frame = spark.createDataFrame(results, f"trial int, {numbers}, chosen boolean")
    return frame.withColumns({c: F.round(c, 6) for c in [*_LOGGED, "auc", "logloss"]})


# --- bootstrapped forests -------------------------------------------------------


@query(
    "rf_regression_bootstrap",
    f"""
    WITH {HOURLY}
    SELECT workingday, count(*) AS n_rows, round(avg(cnt), 6) AS mean_cnt, true AS near_mean
    FROM hourly GROUP BY workingday
    """,
)
def rf_regression_bootstrap(spark, sf_dir):
    """A forest of bootstrapped trees stays within five standard errors of the group means."""
    hours = stage(hourly(spark, sf_dir).select("workingday", "cnt"), "hourly")
    forest = models.forest_regressor("cnt", **DEEP)
    model = models.fit(hours, models.pipeline(["workingday"], forest, None))
    scored = scoring.predict(hours, model)
    error = F.stddev_samp("cnt") / F.sqrt(F.count(F.lit(1)))
    return scored.groupBy("workingday").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg("cnt"), 6).alias("mean_cnt"),
        (
            F.greatest(F.max("prediction") - F.avg("cnt"), F.avg("cnt") - F.min("prediction"))
            <= 5 * error
        ).alias("near_mean"),
    )


# What a forest on these text features must reach on held-out rows.
_AUC_FLOOR = 0.6


@query(
    "rf_binary_proba_held_out",
    f"""
    SELECT CAST(quality AS INTEGER) AS quality, count(*) AS n_rows,
           CAST(0 AS BIGINT) AS n_outside, true AS above_floor
    FROM labels JOIN documents USING (doc_id)
    WHERE {hash01_sql(123, "doc_id")} >= 0.8 GROUP BY quality
    """,
)
def rf_binary_proba_held_out(spark, sf_dir):
    """The baseline forest at full depth, judged on rows it has not seen.

    Probabilities outside [0, 1] or null are counted, and the AUC is held
    against a floor; a bootstrapped forest allows no closer comparison.
    """
    labels = load(spark, sf_dir, "labels").select("doc_id", "quality")
    shape = text_shape(load(spark, sf_dir, "documents")).join(labels, "doc_id")
    rows = stage(splits.hash_split(shape, ["doc_id"], SPLITS, seed=123), "text-shape")
    forest = models.baseline_forest("quality")
    stages_ = models.pipeline(TEXT_FEATURES, forest, None)
    model = models.fit(rows.where("split <> 'test'"), stages_)
    scored = scoring.predict_probability(rows.where("split = 'test'"), model)
    area = evaluation.auc(scored, "quality", "prediction").first()["auc"]
    inside = F.coalesce(F.col("prediction").between(0.0, 1.0), F.lit(False))
    return scored.groupBy(F.col("quality").cast("int").alias("quality")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~inside).alias("n_outside"),
        F.lit(area is not None and area >= _AUC_FLOOR).alias("above_floor"),
    )


# --- second-order boosting with both regularisation strengths --------------------

_STUMPS = [
    {"reg_alpha": 0.0, "reg_lambda": 1.0}, {"reg_alpha": 40.0, "reg_lambda": 1.0},
    {"reg_alpha": 0.0, "reg_lambda": 300.0}, {"reg_alpha": 15.0, "reg_lambda": 80.0},
]
_STUMP_RATE, _STUMP_LEAST = 0.5, 2.0


def _soft_sql(g: str) -> str:
    return f"(sign({g}) * greatest(abs({g}) - l1, 0))"


def _stump_rounds_sql(rounds: int) -> str:
    """``r0`` .. ``r{rounds}``: margins of stumps over ``part``, for each ``fit``.

    ``r0`` has (fit, part, l1, l2, pos, neg, f) and other columns, which are kept.
    """
    ctes = []
    for k in range(1, rounds + 1):
        ctes.append(f"""
s{k} AS MATERIALIZED (
  SELECT *, {_soft_sql("gl")} AS sl, {_soft_sql("ga - gl")} AS sr, {_soft_sql("ga")} AS sa
  FROM (SELECT *, sum(g) OVER upto AS gl, sum(h) OVER upto AS hl,
               sum(g) OVER (PARTITION BY fit) AS ga, sum(h) OVER (PARTITION BY fit) AS ha
        FROM (SELECT *, (pos + neg) / (1 + exp(-f)) - pos AS g,
                     (pos + neg) * exp(-f) / (1 + exp(-f)) / (1 + exp(-f)) AS h FROM r{k - 1}) d
        WINDOW upto AS (PARTITION BY fit ORDER BY part)) c
),
b{k} AS MATERIALIZED (
  SELECT fit, part AS cut, sl / (hl + l2) AS wl, sr / (ha - hl + l2) AS wr,
         sl * sl / (hl + l2) + sr * sr / (ha - hl + l2) - sa * sa / (ha + l2) AS gain
  FROM s{k} WHERE part < 7 AND hl >= {_STUMP_LEAST} AND ha - hl >= {_STUMP_LEAST}
  QUALIFY row_number() OVER (PARTITION BY fit ORDER BY gain DESC, part) = 1
),
r{k} AS MATERIALIZED (
  SELECT s{k}.* EXCLUDE (f, g, h, gl, hl, ga, ha, sl, sr, sa),
         f - {_STUMP_RATE} * CASE WHEN gain > 0 AND part <= cut THEN wl WHEN gain > 0 THEN wr
                                  ELSE sa / (ha + l2) END AS f
  FROM s{k} LEFT JOIN b{k} USING (fit)
)""")
    return ",".join(ctes)


_STUMP_POINTS = ", ".join(
    f"({i}, {p['reg_alpha']}::DOUBLE, {p['reg_lambda']}::DOUBLE)" for i, p in enumerate(_STUMPS)
)
_STUMP_ROUNDS, _SEARCH_ROUNDS, _WAIT = 5, 4, 2


def _stump_params(rounds: int) -> list[BoostParams]:
    return [
        BoostParams(rounds, 1, _STUMP_RATE, min_child_weight=_STUMP_LEAST, **point) for point in _STUMPS
    ]


@query(
    "boosted_regularized_rounds",
    f"""
    WITH {_BAR},
    points AS (SELECT * FROM (VALUES {_STUMP_POINTS}) AS g(fit, l1, l2)),
    r0 AS (
      SELECT fit, part, l1, l2, CAST(sum(high) AS DOUBLE) AS pos,
             CAST(count(*) - sum(high) AS DOUBLE) AS neg, 0.0::DOUBLE AS f
      FROM barred CROSS JOIN points WHERE split = 'train' GROUP BY fit, part, l1, l2
    ), {_stump_rounds_sql(_STUMP_ROUNDS)}
    SELECT CAST(fit AS INTEGER) AS trial, part, round(1 / (1 + exp(-f)), 6) AS prediction
    FROM r{_STUMP_ROUNDS}
    """,
)
def boosted_regularized_rounds(spark, sf_dir):
    """Five rounds of stumps under four pairs of strengths, each of which moves the predictions."""
    rows = _barred(spark, sf_dir).where("split = 'train'")
    fitted = boosting.fit_boosted(
        rows.select(F.array(F.col("part").cast("double")).alias("features"), "high"),
        "features", "high", _stump_params(_STUMP_ROUNDS),
    )
    # Vectors hold no nulls; the booster takes NaN as missing too.
    value = F.coalesce(F.col("part").cast("double"), F.lit(float("nan")))
    groups = rows.select("part").distinct().select("part", array_to_vector(F.array(value)).alias("features"))
    trials = [
        RegularizedBoosterModel(model).transform(groups).select(
            F.lit(i).alias("trial"), "part", F.round(scoring.positive_probability(), 6).alias("prediction")
        )
        for i, model in enumerate(fitted)
    ]
    return reduce(DataFrame.unionByName, trials)


@query(
    "boosted_search_one_scan",
    f"""
    WITH {_BAR},
    points AS (SELECT * FROM (VALUES {_STUMP_POINTS}) AS g(trial, l1, l2)),
    per_fold AS (SELECT fold, part, CAST(sum(high) AS DOUBLE) AS y, count(*) AS n
                 FROM barred GROUP BY fold, part),
    r0 AS (
      SELECT trial * 3 + fold AS fit, trial, part, l1, l2,
             sum(y) OVER (PARTITION BY trial, part) - y AS pos,
             sum(n - y) OVER (PARTITION BY trial, part) - (n - y) AS neg,
             y AS val_pos, n - y AS val_neg, 0.0::DOUBLE AS f
      FROM per_fold CROSS JOIN points
    ), {_stump_rounds_sql(_SEARCH_ROUNDS)},
    losses AS (
      {" UNION ALL ".join(
          f"SELECT trial, fit, {k} AS k, sum(val_pos * ln(1 + exp(-f)) + val_neg * ln(1 + exp(f)))"
          f" / sum(val_pos + val_neg) AS loss FROM r{k} GROUP BY trial, fit"
          for k in range(1, _SEARCH_ROUNDS + 1))}
    ),
    lowest AS (SELECT trial, fit, min(loss) AS loss, arg_min(k, loss) AS k FROM losses GROUP BY trial, fit)
    SELECT CAST(trial AS INTEGER) AS trial, round(avg(loss), 6) AS logloss, CAST(sum(k) AS INTEGER) AS n_trees
    FROM lowest GROUP BY trial
    """,
)
def boosted_search_one_scan(spark, sf_dir):
    """Four settings in three folds: twelve fits that share every scan of the rows."""
    rows = splits.kfold(_barred(spark, sf_dir), ["event_id"], 3, seed=0)
    settings = _stump_params(_SEARCH_ROUNDS)
    fitted = boosting.fit_boosted(
        rows.select(F.array(F.col("part").cast("double")).alias("features"), "high", "fold"),
        "features", "high", [p for p in settings for _ in range(3)], "fold", [0, 1, 2] * len(settings),
    )
    judged = [
        (i // 3, min(model.losses[1:]), len(model.trees)) for i, model in enumerate(fitted)
    ]
    frame = spark.createDataFrame(judged, "trial int, loss double, n_trees int")
    return frame.groupBy("trial").agg(
        F.round(F.avg("loss"), 6).alias("logloss"), F.sum("n_trees").cast("int").alias("n_trees")
    )
