"""Metrics over a label and a score."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.functions import metrics
from tabloom.operators import evaluation
from tabloom.queries.base import load, query

# A number to predict and a formula that predicts it badly, per return flag.
_REGRESSION = """
scored AS (
  SELECT l_returnflag AS model, l_quantity AS y, 20 + l_extendedprice / 10000 AS p FROM lineitem
)
"""


def _regression(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("model"),
        F.col("l_quantity").alias("y"),
        (20 + F.col("l_extendedprice") / 10000).alias("p"),
    )


# A 0/1 label with a coarse score in (0, 1), so that many scores tie.
_BINARY = """
scored AS (
  SELECT l_returnflag AS model, CAST(l_quantity >= 25 AS INTEGER) AS y,
         (1 + floor(l_extendedprice / 1000)) / 200 AS p
  FROM lineitem
)
"""


def _binary(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("model"),
        F.when(F.col("l_quantity") >= 25, 1).otherwise(0).alias("y"),
        ((1 + F.floor(F.col("l_extendedprice") / 1000)) / 200).alias("p"),
    )


def _per_model(df, name, metric):
    return evaluation.evaluate(df, {name: F.round(metric, 6)}, ["model"])


@query(
    "metric_rmse",
    f"""
    WITH {_REGRESSION}
    SELECT model, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse FROM scored GROUP BY model
    """,
)
def metric_rmse(spark, sf_dir):
    return _per_model(_regression(spark, sf_dir), "rmse", metrics.rmse("y", "p"))


@query(
    "metric_mse",
    f"""
    WITH {_REGRESSION}
    SELECT model, round(avg((y - p) * (y - p)), 6) AS mse FROM scored GROUP BY model
    """,
)
def metric_mse(spark, sf_dir):
    return _per_model(_regression(spark, sf_dir), "mse", metrics.mse("y", "p"))


@query(
    "metric_r2",
    f"""
    WITH {_REGRESSION}
    SELECT model, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 6) AS r2
    FROM scored GROUP BY model
    """,
)
def metric_r2(spark, sf_dir):
    return _per_model(_regression(spark, sf_dir), "r2", metrics.r2("y", "p"))


@query(
    "metric_accuracy",
    f"""
    WITH {_BINARY}
    SELECT model, round(avg(CAST(y = CAST(p >= 0.2 AS INTEGER) AS INTEGER)), 6) AS accuracy
    FROM scored GROUP BY model
    """,
)
def metric_accuracy(spark, sf_dir):
    predicted = (F.col("p") >= 0.2).cast("int")
    return _per_model(_binary(spark, sf_dir), "accuracy", metrics.accuracy("y", predicted))


@query(
    "metric_logloss",
    f"""
    WITH {_BINARY}
    SELECT model, round(-avg(y * ln(p) + (1 - y) * ln(1 - p)), 6) AS logloss
    FROM scored GROUP BY model
    """,
)
def metric_logloss(spark, sf_dir):
    return _per_model(_binary(spark, sf_dir), "logloss", metrics.logloss("y", "p"))


_AUC_SQL = f"""
WITH {_BINARY},
tied AS (
  SELECT model, p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg
  FROM scored GROUP BY model, p
),
ranked AS (
  SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY p) AS neg_upto FROM tied
)
SELECT model, round(sum(pos * (neg_upto - neg / 2)) / (sum(pos) * sum(neg)), 6) AS auc
FROM ranked GROUP BY model
"""


@query("metric_auc", _AUC_SQL)
def metric_auc(spark, sf_dir):
    scored = evaluation.auc(_binary(spark, sf_dir), "y", "p", ["model"])
    return scored.withColumn("auc", F.round("auc", 6))


@query("metric_auc_ranked", _AUC_SQL)
def metric_auc_ranked(spark, sf_dir):
    """The same area when distinct scores are too many to sort in one task."""
    scored = evaluation.auc(_binary(spark, sf_dir), "y", "p", ["model"], small_rows=0)
    return scored.withColumn("auc", F.round("auc", 6))
