"""Grids, folds, sampled trials and sweeps."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tabloom.operators import columns, evaluation, models, scoring, splits, stages, tuning
from tabloom.operators.tuning import LogUniform, QUniform
from tabloom.queries.base import HOURLY, hash01_sql, hourly, load, query
from tabloom.session import stage

_FOLDS = f"""
folds AS (
  SELECT event_id, CAST(floor({hash01_sql(0, "event_id")} * 3) AS INTEGER) AS fold FROM events
)
"""


@query(
    "param_grid",
    f"""
    WITH {_FOLDS},
    sizes AS (
      SELECT fold, sum(count(*)) OVER () - count(*) AS n_train, count(*) AS n_validation
      FROM folds GROUP BY fold
    )
    SELECT fold, CAST(n_train AS BIGINT) AS n_train, n_validation,
           CAST(trial AS INTEGER) AS trial, CAST(d AS INTEGER) AS "maxDepth",
           CAST(i AS INTEGER) AS "maxIter"
    FROM sizes CROSS JOIN (VALUES (0, 2, 10), (1, 2, 100), (2, 5, 10), (3, 5, 100)) AS g(trial, d, i)
    """,
)
def param_grid(spark, sf_dir):
    """Every fit of a cross-validated grid search, with the rows it sees."""
    events = load(spark, sf_dir, "events").select("event_id")
    folds = splits.kfold(events, ["event_id"], 3, seed=0)
    # One row: how many rows fall in each fold.
    wide = folds.agg(*(F.count_if(F.col("fold") == k).alias(str(k)) for k in range(3)))
    total = F.col("0") + F.col("1") + F.col("2")
    sizes = wide.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(k).alias("fold"),
                        (total - F.col(str(k))).alias("n_train"),
                        F.col(str(k)).alias("n_validation"),
                    )
                    for k in range(3)
                )
            )
        )
    )
    return tuning.with_grid(sizes, tuning.BOOSTING_GRID)


@query(
    "cv_grid_search",
    f"""
    WITH {HOURLY},
    folded AS (
      SELECT hr, cnt, CAST(floor({hash01_sql(0, "instant")} * 3) AS INTEGER) AS fold FROM hourly
    ),
    predicted AS (
      SELECT v.fold, v.cnt, avg(t.cnt) AS p
      FROM (SELECT *, row_number() OVER () AS id FROM folded) v
      JOIN folded t ON t.hr = v.hr AND t.fold <> v.fold
      GROUP BY v.fold, v.id, v.cnt
    ),
    errors AS (SELECT fold, sqrt(avg((cnt - p) * (cnt - p))) AS rmse FROM predicted GROUP BY fold)
    SELECT CAST(trial AS INTEGER) AS trial, max_depth, max_iter, round(avg(rmse), 6) AS avg_rmse
    FROM errors
    CROSS JOIN (VALUES (0, '20', '1'), (1, '20', '2'), (2, '30', '1'), (3, '30', '2'))
      AS g(trial, max_depth, max_iter)
    GROUP BY trial, max_depth, max_iter
    """,
)
def cv_grid_search(spark, sf_dir):
    """Cross-validated grid whose trees all separate the hours: a second round of
    boosting then adds nothing, and each fold's error is that of the group means."""
    rows = stage(
        splits.kfold(hourly(spark, sf_dir), ["instant"], 3, seed=0).select("hr", "cnt", "fold"),
        "hourly-folds",
    )
    prepared = stages.assembler(["hr"], "features").transform(rows)
    _, trials = tuning.cross_validate(
        prepared,
        models.boosted_regressor("cnt"),
        {"maxDepth": [20, 30], "maxIter": [1, 2]},
        RegressionEvaluator(labelCol="cnt", metricName="rmse"),
        "fold",
    )
    return trials.select(
        "trial",
        F.col("params")["maxDepth"].alias("max_depth"),
        F.col("params")["maxIter"].alias("max_iter"),
        F.round("avg_metric", 6).alias("avg_rmse"),
    )


_SPACE = {k: v for k, v in tuning.BOOSTING_SPACE.items() if not isinstance(v, tuning.Constant)}


def draw_sql(name: str, dist: QUniform | LogUniform, key: str = "p_partkey") -> str:
    """The SQL twin of one column of ``draw_trials`` with seed 123."""
    u = hash01_sql(123, key, f"'{name}'")
    value = f"({float(dist.low)}::DOUBLE + {float(dist.high - dist.low)}::DOUBLE * {u})"
    if isinstance(dist, QUniform):
        return f"round_even({value}, 0) AS {name}"
    return f"round(exp({value}), 9) AS {name}"


@query(
    "sample_search_space",
    "SELECT p_partkey, "
    + ", ".join(draw_sql(name, dist) for name, dist in _SPACE.items())
    + ", 'binary:logistic' AS objective, 123 AS seed FROM part",
)
def sample_search_space(spark, sf_dir):
    """One trial for each part, its parameters fixed by the part's key."""
    parts = load(spark, sf_dir, "part").select("p_partkey")
    drawn = tuning.draw_trials(parts, "p_partkey", tuning.BOOSTING_SPACE, seed=123)
    smooth = [n for n, dist in _SPACE.items() if isinstance(dist, LogUniform)]
    return drawn.withColumns({n: F.round(n, 9) for n in smooth})


_SWEEP_ROWS = f"""
flagged AS (
  SELECT event_id, hour(ts) AS hr, CAST(value >= 50 AS INTEGER) AS high,
         {hash01_sql(123, "event_id")} AS u
  FROM events
)
"""


@query(
    "hyperparameter_sweep",
    f"""
    WITH {_SWEEP_ROWS},
    rates AS (
      SELECT hr, CAST(2 * sum(high) - count(*) AS DOUBLE) / count(*) AS score
      FROM flagged WHERE u < 0.6 GROUP BY hr
    ),
    tied AS (
      SELECT score, CAST(sum(high) AS DOUBLE) AS pos, CAST(sum(1 - high) AS DOUBLE) AS neg
      FROM flagged JOIN rates USING (hr) WHERE u >= 0.6 AND u < 0.8 GROUP BY score
    ),
    ranked AS (SELECT *, sum(neg) OVER (ORDER BY score) AS neg_upto FROM tied),
    area AS (SELECT sum(pos * (neg_upto - neg / 2)) / (sum(pos) * sum(neg)) AS auc FROM ranked)
    SELECT CAST(trial AS INTEGER) AS trial, round(auc, 6) AS auc, round(-auc, 6) AS loss
    FROM area CROSS JOIN (VALUES (0), (1), (2), (3)) AS t(trial)
    """,
)
def hyperparameter_sweep(spark, sf_dir):
    """Sampled trials fitted side by side, each judged by AUC on the validation split.

    All sampled depths separate the 24 hours and one round is boosted, so every
    trial ranks the hours by their rate in the training split.
    """
    rows = load(spark, sf_dir, "events").select(
        "event_id", F.hour("ts").alias("hr"), columns.binarize("value", 50).alias("high")
    )
    weights = {"train": 0.6, "validation": 0.2, "test": 0.2}
    split = splits.hash_split(rows, ["event_id"], weights, seed=123)
    prepared = stages.assembler(["hr"], "features").transform(split)
    train = prepared.where("split = 'train'")
    validation = prepared.where("split = 'validation'")
    space = {"max_depth": QUniform(24, 30), "learning_rate": LogUniform(-3, 0)}
    drawn = tuning.draw_trials(spark.range(4), "id", space, seed=123).orderBy("id").collect()

    def build(trial):
        return models.boosted_classifier(
            "high",
            maxIter=1,
            maxDepth=int(trial["max_depth"]),
            stepSize=trial["learning_rate"],
        )

    def measure(model):
        scored = model.transform(validation).select(
            "high", scoring.positive_probability().alias("p")
        )
        return {"auc": evaluation.auc(scored, "high", "p").first()["auc"]}

    done = tuning.sweep(train, [r.asDict() for r in drawn], build, measure)
    results = [(t.number, t.metrics["auc"], t.loss("auc")) for t in done]
    return spark.createDataFrame(results, "trial int, auc double, loss double").select(
        "trial", F.round("auc", 6).alias("auc"), F.round("loss", 6).alias("loss")
    )
