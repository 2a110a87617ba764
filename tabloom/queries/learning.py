"""Fitted models.

A tree deep enough to separate every value of a few coarse features predicts
group means or majority classes, so its output has an exact SQL twin.  The
queries below fit such trees on whole tables; with other parameters the same
calls give ordinary models (see ``tabloom.plans``).
"""

from __future__ import annotations

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.functions import metrics
from tabloom.operators import columns, evaluation, features, models, scoring, stages
from tabloom.operators.features import FeatureLookup
from tabloom.operators.splits import hash_split
from tabloom.queries.base import (
    HOURLY,
    LETTER_CODE,
    TEXT_FEATURES,
    hash01_sql,
    hourly,
    letter_code,
    load,
    query,
    text_shape,
    work_schema,
)
from tabloom.session import scratch_path, stage
from tabloom.sources import tables
from tabloom.sources.models import load_model, save_model

DEEP = {"maxDepth": models.MAX_DEPTH}
# A forest whose trees all see every row and every feature.
PLAIN_FOREST = {**DEEP, "bootstrap": False, "featureSubsetStrategy": "all"}


def _fitted(df, features_, estimator, max_categories=None):
    return models.fit(df, models.pipeline(features_, estimator, max_categories))


def _fitted_on_counts(df, features_, label, estimator):
    """For coarse features and labels: train on distinct rows and their counts."""
    merged = models.merge_repeats(df, [*features_, label])
    return _fitted(merged, features_, estimator.setWeightCol("n_rows"))


def _hours(spark, sf_dir):
    # Small next to the events it sums up; staged, as every tree level reads it.
    return stage(hourly(spark, sf_dir), "hourly")


# --- regression on hourly counts --------------------------------------------


def _hourly_boosted(spark, sf_dir, used=("hr", "workingday")):
    hours = _hours(spark, sf_dir)
    model = _fitted(hours, list(used), models.boosted_regressor("cnt", maxIter=1, **DEEP), 4)
    return scoring.predict(hours, model)


@query(
    "pipeline_predict",
    f"""
    WITH {HOURLY}
    SELECT instant, hr, workingday, cnt,
           round(avg(cnt) OVER (PARTITION BY hr, workingday), 6) AS prediction
    FROM hourly
    """,
)
def pipeline_predict(spark, sf_dir):
    """Assemble, index categories, boost, predict, in one pipeline."""
    return _hourly_boosted(spark, sf_dir).select(
        "instant", "hr", "workingday", "cnt", F.round("prediction", 6).alias("prediction")
    )


@query(
    "gbt_regression",
    f"WITH {HOURLY} SELECT hr, round(avg(cnt), 6) AS prediction FROM hourly GROUP BY hr",
)
def gbt_regression(spark, sf_dir):
    scored = _hourly_boosted(spark, sf_dir, ("hr",))
    return scored.select("hr", F.round("prediction", 6).alias("prediction")).distinct()


@query(
    "residuals",
    f"""
    WITH {HOURLY}
    SELECT instant, hr, cnt,
           round(cnt - avg(cnt) OVER (PARTITION BY weekday), 6) AS residual
    FROM hourly
    """,
)
def residuals(spark, sf_dir):
    scored = _hourly_boosted(spark, sf_dir, ("weekday",))
    return columns.with_residual(scored, "cnt").select(
        "instant", "hr", "cnt", F.round("residual", 6).alias("residual")
    )


@query(
    "mean_residual",
    f"""
    WITH {HOURLY},
    r AS (SELECT cnt, cnt - avg(cnt) OVER (PARTITION BY weekday) AS residual FROM hourly)
    SELECT round(abs(avg(residual)), 6) AS abs_mean_residual,
           round(avg(cnt), 6) AS mean_cnt FROM r
    """,
)
def mean_residual(spark, sf_dir):
    """Mean residual beside the mean label it is judged against."""
    scored = columns.with_residual(_hourly_boosted(spark, sf_dir, ("weekday",)), "cnt")
    means = scored.agg({"residual": "mean", "cnt": "mean"})
    return means.select(
        F.round(F.abs("avg(residual)"), 6).alias("abs_mean_residual"),
        F.round("avg(cnt)", 6).alias("mean_cnt"),
    )


@query(
    "residual_by_hour",
    f"""
    WITH {HOURLY},
    r AS (SELECT hr, cnt - avg(cnt) OVER (PARTITION BY weekday) AS residual FROM hourly)
    SELECT hr, count(*) AS n_rows, round(avg(residual), 6) AS mean_residual,
           round(stddev_samp(residual), 6) AS sd_residual
    FROM r GROUP BY hr
    """,
)
def residual_by_hour(spark, sf_dir):
    scored = columns.with_residual(_hourly_boosted(spark, sf_dir, ("weekday",)), "cnt")
    profile = evaluation.residual_profile(scored, "hr")
    return profile.withColumns({c: F.round(c, 6) for c in ("mean_residual", "sd_residual")})


@query(
    "additive_models",
    f"""
    WITH {HOURLY}
    SELECT instant, cnt,
           round(avg(casual) OVER (PARTITION BY hr)
                 + avg(registered) OVER (PARTITION BY hr), 6) AS prediction
    FROM hourly
    """,
)
def additive_models(spark, sf_dir):
    """One model for each part of the count, added up; one scan scores both."""
    scored = hours = _hours(spark, sf_dir)
    for part in ("casual", "registered"):
        model = _fitted(hours, ["hr"], models.boosted_regressor(part, maxIter=1, **DEEP))
        scored = scoring.predict(scored, model, f"{part}_prediction")
    total = F.col("casual_prediction") + F.col("registered_prediction")
    return scored.select("instant", "cnt", F.round(total, 6).alias("prediction"))


@query(
    "compare_models",
    f"""
    WITH {HOURLY},
    p AS (
      SELECT cnt, avg(cnt) OVER (PARTITION BY hr) AS by_hour,
             avg(cnt) OVER (PARTITION BY weekday) AS by_weekday
      FROM hourly
    )
    SELECT 'by_hour' AS model, round(sqrt(avg((cnt - by_hour) * (cnt - by_hour))), 6) AS rmse
    FROM p
    UNION ALL
    SELECT 'by_weekday', round(sqrt(avg((cnt - by_weekday) * (cnt - by_weekday))), 6) FROM p
    """,
)
def compare_models(spark, sf_dir):
    """Two models over the same rows: both predictions in one scan, one pass of metrics."""
    scored = hours = _hours(spark, sf_dir)
    for name, feature in (("by_hour", "hr"), ("by_weekday", "weekday")):
        model = _fitted(hours, [feature], models.tree_regressor("cnt", **DEEP))
        scored = scoring.predict(scored, model, name)
    return scored.agg(
        *(F.round(metrics.rmse("cnt", m), 6).alias(m) for m in ("by_hour", "by_weekday"))
    ).unpivot([], ["by_hour", "by_weekday"], "model", "rmse")


# --- regression on looked-up features ---------------------------------------


@query(
    "rf_regression",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           round(avg(l_quantity) OVER (PARTITION BY p_size), 6) AS prediction
    FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
)
def rf_regression(spark, sf_dir):
    """Forest on a feature fetched by key."""
    name = f"{work_schema(spark)}.part_features"
    part = load(spark, sf_dir, "part").select("p_partkey", "p_size")
    features.create_feature_table(spark, name, "p_partkey", part)
    rows = features.create_training_set(
        load(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
        ),
        [FeatureLookup(name, "l_partkey")],
        "l_quantity",
    ).load_df()
    forest = models.forest_regressor("l_quantity", maxBins=64, **PLAIN_FOREST)
    scored = scoring.predict(rows, _fitted_on_counts(rows, ["p_size"], "l_quantity", forest))
    return scored.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round("prediction", 6).alias("prediction"),
    )


@query(
    "score_table_native",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) OVER alike AS DOUBLE)
             / count(*) OVER alike AS prediction
    FROM lineitem WINDOW alike AS (PARTITION BY l_linenumber, l_discount)
    """,
)
def score_table_native(spark, sf_dir):
    """A stored table scored in bulk by a stored model, all inside the JVM.

    The label is the price in cents.  Sums of whole numbers do not depend on their order,
    so predictions are compared to the last bit.
    """
    rows = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount",
        F.round(F.col("l_extendedprice") * 100).alias("cents"),
    )
    used = ["l_linenumber", "l_discount"]
    model = _fitted(rows, used, models.tree_regressor("cents", **DEEP))
    path = scratch_path(spark, "model")
    save_model(model, path, scoring.infer_signature(rows, used))
    name = f"{work_schema(spark)}.batch"
    tables.overwrite_table(rows.drop("cents"), name)
    saved = load_model(spark, path)
    batch = scoring.check_signature(tables.read_table(spark, name), saved.signature)
    return scoring.predict(batch, saved.pipeline).drop("l_discount")


@query(
    "score_table_pandas_udf",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS prediction
    FROM lineitem
    """,
)
def score_table_pandas_udf(spark, sf_dir):
    """A model that only exists in Python, applied to Arrow batches of a struct."""

    def load_predictor():
        def predictor(batch: pd.DataFrame) -> pd.Series:
            return batch["l_extendedprice"] * (1 - batch["l_discount"]) * (1 + batch["l_tax"])

        return predictor

    score = scoring.python_scorer(load_predictor)
    packed = columns.pack(["l_extendedprice", "l_discount", "l_tax"])
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round(score(packed), 6).alias("prediction"),
    )


# --- classification ----------------------------------------------------------


def _flagged_events(spark, sf_dir):
    return load(spark, sf_dir, "events").select(
        "event_id", F.hour("ts").alias("hr"), columns.binarize("value", 50).alias("high")
    )


_FLAGGED = """
flagged AS (
  SELECT event_id, hour(ts) AS hr, CAST(value >= 50 AS INTEGER) AS high FROM events
)
"""


@query(
    "predict_probability",
    f"""
    WITH {_FLAGGED},
    rated AS (
      SELECT event_id, CAST(2 * sum(high) OVER w - count(*) OVER w AS DOUBLE)
                       / count(*) OVER w AS margin
      FROM flagged WINDOW w AS (PARTITION BY hr)
    )
    SELECT event_id, round(1 / (1 + exp(-2 * margin)), 9) AS prediction FROM rated
    """,
)
def predict_probability(spark, sf_dir):
    """Probability of class 1.  One boosting round fits the mean of labels -1 and 1,
    which the logistic function then maps to a probability."""
    rows = _flagged_events(spark, sf_dir)
    booster = models.boosted_classifier("high", maxIter=1, **DEEP)
    model = _fitted_on_counts(rows, ["hr"], "high", booster)
    scored = scoring.predict_probability(rows, model)
    return scored.select("event_id", F.round("prediction", 9).alias("prediction"))


_MAJORITY = f"""
WITH {_FLAGGED}
SELECT event_id, CAST(CASE WHEN avg(high) OVER (PARTITION BY hr) > 0.5 THEN 1 ELSE 0 END
                      AS DOUBLE) AS prediction
FROM flagged
"""


@query("rf_binary_class", _MAJORITY)
def rf_binary_class(spark, sf_dir):
    rows = _flagged_events(spark, sf_dir)
    forest = models.baseline_forest("high", **PLAIN_FOREST)
    model = _fitted_on_counts(rows, ["hr"], "high", forest)
    return scoring.predict(rows, model).select("event_id", "prediction")


@query("rf_binary_proba")
def rf_binary_proba(spark, sf_dir):
    """Baseline forest on text shape, scored by probability (bootstrapped: no SQL twin)."""
    rows = _labelled_texts(spark, sf_dir)
    model = _fitted(rows, TEXT_FEATURES, models.baseline_forest("quality"))
    scored = scoring.predict_probability(rows, model)
    return scored.select("doc_id", "quality", F.round("prediction", 6).alias("prediction"))


def _labelled_texts(spark, sf_dir):
    labels = load(spark, sf_dir, "labels").select("doc_id", "quality")
    shape = text_shape(load(spark, sf_dir, "documents"))
    # Text features cost far more than they take up, and training reads them often.
    return stage(shape.join(labels, "doc_id"), "text-shape")


_MAJORITY_LANG = f"""
{LETTER_CODE},
votes AS (SELECT letter_code, lang, count(*) AS n FROM letter_code GROUP BY letter_code, lang),
majority AS (
  SELECT letter_code, lang AS predicted_lang FROM votes
  QUALIFY row_number() OVER (PARTITION BY letter_code ORDER BY n DESC, lang) = 1
)
"""


def _classified(spark, sf_dir, estimator):
    rows = stage(letter_code(load(spark, sf_dir, "documents")), "letter-code")
    indexer = stages.label_indexer("lang").fit(rows)
    indexed = indexer.transform(rows)
    model = _fitted_on_counts(indexed, ["letter_code"], "label_index", estimator)
    return scoring.predict_class(indexed, model, indexer.labels, "predicted_lang")


@query(
    "dt_classification",
    f"""
    WITH {_MAJORITY_LANG}
    SELECT round(avg(CAST(lang = predicted_lang AS INTEGER)), 6) AS accuracy, count(*) AS n_rows
    FROM letter_code JOIN majority USING (letter_code)
    """,
)
def dt_classification(spark, sf_dir):
    """Accuracy of a tree over four languages."""
    scored = _classified(spark, sf_dir, models.tree_classifier("label_index", **DEEP))
    return scored.agg(
        F.round(metrics.accuracy("lang", "predicted_lang"), 6).alias("accuracy"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@query(
    "rf_classification",
    f"""
    WITH {_MAJORITY_LANG}
    SELECT lang, predicted_lang, count(*) AS n_rows
    FROM letter_code JOIN majority USING (letter_code) GROUP BY lang, predicted_lang
    """,
)
def rf_classification(spark, sf_dir):
    """Which language a forest takes for which."""
    forest = models.forest_classifier("label_index", **{**PLAIN_FOREST, "numTrees": 10})
    scored = _classified(spark, sf_dir, forest)
    return scored.groupBy("lang", "predicted_lang").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "classify",
    f"""
    WITH {_MAJORITY_LANG}
    SELECT doc_id, predicted_lang FROM letter_code JOIN majority USING (letter_code)
    """,
)
def classify(spark, sf_dir):
    """Class names for every document."""
    scored = _classified(spark, sf_dir, models.tree_classifier("label_index", **DEEP))
    return scored.select("doc_id", "predicted_lang")


_STEP, _TOLERANCE, _ROUNDS = 0.5, 0.1, 20

_BOOSTED = f"""
banded AS (
  SELECT CAST(least(9, floor(value / 10)) AS INTEGER) AS band, value >= 55 AS high,
         {hash01_sql(123, "event_id")} AS u
  FROM events
),
parts AS (
  SELECT band, high,
         CASE WHEN u < 0.6 THEN 'train' WHEN u < 0.8 THEN 'validation' ELSE 'test' END AS split
  FROM banded
),
bands AS (
  SELECT band,
         CAST(count(*) FILTER (split = 'train' AND high) AS DOUBLE) AS pos,
         CAST(count(*) FILTER (split = 'train' AND NOT high) AS DOUBLE) AS neg,
         count(*) FILTER (split = 'validation' AND high) AS val_pos,
         count(*) FILTER (split = 'validation' AND NOT high) AS val_neg
  FROM parts GROUP BY band
),
rounds AS (
  SELECT 1 AS k, band, pos, neg, val_pos, val_neg, (pos - neg) / (pos + neg) AS f FROM bands
  UNION ALL
  SELECT k + 1, band, pos, neg, val_pos, val_neg,
         f + {_STEP}::DOUBLE * 4 * (pos / (1 + exp(2 * f)) - neg / (1 + exp(-2 * f))) / (pos + neg)
  FROM rounds WHERE k < {_ROUNDS}
),
losses AS (
  SELECT k, 2 * sum(val_pos * ln(1 + exp(-2 * f)) + val_neg * ln(1 + exp(2 * f)))
            / sum(val_pos + val_neg) AS loss
  FROM rounds GROUP BY k
),
gains AS (SELECT k, loss, lag(loss) OVER (ORDER BY k) - loss AS gain FROM losses),
stopped AS (
  SELECT coalesce(min(k) FILTER (gain < {_TOLERANCE}::DOUBLE * greatest(loss, 0.01)) - 1,
                  {_ROUNDS}) AS n_trees
  FROM gains
),
rated AS (
  SELECT split, CAST(high AS INTEGER) AS y, 1 / (1 + exp(-2 * f)) AS p, n_trees
  FROM parts JOIN rounds USING (band) JOIN stopped ON k = n_trees
)
"""


@query(
    "gbt_early_stop",
    f"""
    WITH RECURSIVE {_BOOSTED}
    SELECT split, round(-avg(y * ln(p) + (1 - y) * ln(1 - p)), 6) AS logloss,
           count(*) AS n_rows, CAST(n_trees AS INTEGER) AS n_trees
    FROM rated GROUP BY split, n_trees
    """,
)
def gbt_early_stop(spark, sf_dir):
    """Boosting that ends when the held-out loss stops falling.

    Each round's tree separates the ten bands, so it adds the bands' mean
    gradients, and the rounds can be followed in SQL up to the stop.
    """
    rows = load(spark, sf_dir, "events").select(
        "event_id",
        F.least(F.lit(9), F.floor(F.col("value") / 10)).cast("int").alias("band"),
        columns.binarize("value", 55).alias("high"),
    )
    weights = {"train": 0.6, "validation": 0.2, "test": 0.2}
    split = hash_split(rows, ["event_id"], weights, seed=123)
    fitting = split.where("split <> 'test'").withColumn("held_out", F.col("split") == "validation")
    booster = models.boosted_classifier(
        "high", "held_out", maxIter=_ROUNDS, maxDepth=10, stepSize=_STEP, validationTol=_TOLERANCE
    )
    model = _fitted(fitting, ["band"], booster)
    scored = scoring.predict_probability(split, model)
    return scored.groupBy("split").agg(
        F.round(metrics.logloss("high", "prediction"), 6).alias("logloss"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(model.stages[-1].getNumTrees).alias("n_trees"),
    )


@query(
    "rf_flag_proba",
    """
    SELECT event_id, round(avg(CAST(value >= 55 AS INTEGER)) OVER (PARTITION BY value >= 50), 9)
                       AS prediction
    FROM events
    """,
)
def rf_flag_proba(spark, sf_dir):
    """Forest probabilities on one flag whose two sides vote differently: plain rates."""
    rows = load(spark, sf_dir, "events").select(
        "event_id",
        columns.binarize("value", 50).alias("flag"),
        columns.binarize("value", 55).alias("high"),
    )
    forest = models.baseline_forest("high", **PLAIN_FOREST)
    model = _fitted_on_counts(rows, ["flag"], "high", forest)
    scored = scoring.predict_probability(rows, model)
    return scored.select("event_id", F.round("prediction", 9).alias("prediction"))


# --- what a model or an indexer learned ----------------------------------------

_FLAGS = {
    "returned": "l_returnflag = 'R'",
    "open": "l_linestatus = 'O'",
    "discounted": "l_discount >= 0.05",
    "taxed": "l_tax >= 0.04",
    "early_line": "l_linenumber <= 3",
}


@query(
    "feature_importance",
    f"""
    WITH long AS ({
        " UNION ALL ".join(
            f"SELECT '{name}' AS feature, {test} AS flag, l_quantity AS y FROM lineitem"
            for name, test in _FLAGS.items()
        )
    }),
    sums AS (
      SELECT feature, flag, sum(y) * sum(y) / count(*) AS between_flags
      FROM long GROUP BY feature, flag
    ),
    gains AS (SELECT feature, sum(between_flags) AS gain FROM sums GROUP BY feature)
    SELECT feature, CAST(CASE WHEN gain = max(gain) OVER () THEN 1 ELSE 0 END AS DOUBLE)
                      AS importance
    FROM gains
    """,
)
def feature_importance(spark, sf_dir):
    """One split on the flag that explains most variance gets all the importance."""
    rows = load(spark, sf_dir, "lineitem").select(
        "l_quantity", *(F.expr(f"cast({test} AS int)").alias(n) for n, test in _FLAGS.items())
    )
    stump = models.tree_regressor("l_quantity", maxDepth=1)
    model = _fitted_on_counts(rows, list(_FLAGS), "l_quantity", stump)
    return models.feature_importance(rows, model, list(_FLAGS))


@query(
    "assemble_vector",
    """
    SELECT l_orderkey, l_linenumber, l_quantity AS slot_0, l_discount AS slot_1,
           CAST(l_linenumber AS DOUBLE) AS slot_2
    FROM lineitem
    """,
)
def assemble_vector(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem")
    vectors = stages.assembler(["l_quantity", "l_discount", "l_linenumber"]).transform(rows)
    slots = vector_to_array("rawFeatures")
    return vectors.select(
        "l_orderkey", "l_linenumber", *(slots[i].alias(f"slot_{i}") for i in range(3))
    )


_INDEXED = ["l_linenumber", "l_discount", "l_tax", "l_quantity"]


@query(
    "vector_index",
    "WITH long AS ("
    + " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS feature, CAST({c} AS DOUBLE) AS original_value FROM lineitem"
        for c in _INDEXED
    )
    + """),
    sized AS (SELECT *, count(*) OVER (PARTITION BY feature) AS k FROM long)
    SELECT feature, round(original_value, 6) AS original_value,
           CAST(dense_rank() OVER (PARTITION BY feature ORDER BY original_value) - 1 AS INTEGER)
             AS category_index
    FROM sized WHERE k <= 12
    """,
)
def vector_index(spark, sf_dir):
    """Slots with few values become categories; the others stay numbers."""
    rows = stages.assembler(_INDEXED).transform(load(spark, sf_dir, "lineitem").select(*_INDEXED))
    fitted = stages.category_indexer(12).fit(rows)
    mapped = stages.category_map(rows, fitted, _INDEXED)
    return mapped.withColumn("original_value", F.round("original_value", 6))
