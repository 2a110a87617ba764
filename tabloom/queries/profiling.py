"""Looking at columns before training."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import profiling, splits
from tabloom.queries.base import (
    HOURLY,
    TEXT_FEATURES,
    TEXT_SHAPE,
    hash01_sql,
    hourly,
    load,
    query,
    text_shape,
)


@query(
    "hourly_mean",
    f"""
    WITH {HOURLY}
    SELECT hr, round(avg(cnt), 6) AS mean_cnt FROM hourly
    WHERE {hash01_sql(0, "instant")} < 0.7 GROUP BY hr
    """,
)
def hourly_mean(spark, sf_dir):
    """Mean count by hour of the day over the training split."""
    split = splits.hash_split(
        hourly(spark, sf_dir), ["instant"], {"train": 0.7, "test": 0.3}, seed=0
    )
    means = profiling.group_mean(split.where("split = 'train'"), "hr", "cnt", "mean_cnt")
    return means.withColumn("mean_cnt", F.round("mean_cnt", 6))


@query("label_histogram", "SELECT p_size, count(*) AS n_rows FROM part GROUP BY p_size")
def label_histogram(spark, sf_dir):
    return profiling.value_histogram(load(spark, sf_dir, "part"), "p_size")


@query(
    "numeric_histogram",
    """
    WITH bounds AS (
      SELECT min(l_extendedprice) AS low,
             (max(l_extendedprice) - min(l_extendedprice)) / 20 AS width
      FROM lineitem
    ), binned AS (
      SELECT least(19, CAST(floor((l_extendedprice - low) / width) AS INTEGER)) AS bin, low, width
      FROM lineitem, bounds
    )
    SELECT bin, round(low + bin * width, 6) AS lower_edge,
           round(low + (bin + 1) * width, 6) AS upper_edge, count(*) AS n_rows
    FROM binned GROUP BY bin, low, width
    """,
)
def numeric_histogram(spark, sf_dir):
    bins = profiling.numeric_histogram(load(spark, sf_dir, "lineitem"), "l_extendedprice", 20)
    return bins.withColumns(
        {c: F.round(c, 6) for c in ("lower_edge", "upper_edge")}
    )


_BOX_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _box_sql(source: str, label: str, features: list[str]) -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {label} AS label, CAST({c} AS DOUBLE) AS value FROM {source}"
        for c in features
    )
    return f"""
      long AS ({long}),
      boxes AS (
        SELECT feature, label, count(*) AS n_rows, quantile_cont(value, 0.25) AS q1,
               quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
        FROM long GROUP BY feature, label
      ),
      stats AS (
        SELECT feature, label, n_rows, q1, median, q3,
               min(value) FILTER (inside) AS whisker_low,
               max(value) FILTER (inside) AS whisker_high,
               count(*) FILTER (NOT inside) AS n_outliers
        FROM (
          SELECT *, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
          FROM long JOIN boxes USING (feature, label)
        )
        GROUP BY feature, label, n_rows, q1, median, q3
      )
    """


_POINTS = ["q1", "median", "q3", "whisker_low", "whisker_high"]
_BOX_SQL = f"""
WITH {_box_sql("lineitem", "l_returnflag", _BOX_FEATURES)}
SELECT feature, label, n_rows, n_outliers,
       {", ".join(f"round({c}, 6) AS {c}" for c in _POINTS)}
FROM stats
"""


def _rounded(stats):
    return stats.withColumns({c: F.round(c, 6) for c in _POINTS})


@query("boxplot_stats", _BOX_SQL)
def boxplot_stats(spark, sf_dir):
    lineitem = load(spark, sf_dir, "lineitem")
    return _rounded(profiling.boxplot_stats(lineitem, _BOX_FEATURES, "l_returnflag"))


@query("boxplot_stats_ranked", _BOX_SQL)
def boxplot_stats_ranked(spark, sf_dir):
    """The same numbers the way tables too large for one task per group get them."""
    lineitem = load(spark, sf_dir, "lineitem")
    return _rounded(
        profiling.boxplot_stats(lineitem, _BOX_FEATURES, "l_returnflag")
    )


@query(
    "null_report",
    """
    WITH joined AS (
      SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
    )
    SELECT column_name, n_missing, n_missing > 0 AS has_missing FROM (
      SELECT 'doc_id' AS column_name, count(*) - count(doc_id) AS n_missing FROM joined
      UNION ALL SELECT 'lang', count(*) - count(lang) FROM joined
      UNION ALL SELECT 'n_chars', count(*) - count(n_chars) FROM joined
      UNION ALL SELECT 'quality', count(*) - count(quality) FROM joined
      UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM joined
    )
    """,
)
def null_report(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return profiling.null_report(docs.join(load(spark, sf_dir, "labels"), "doc_id", "left"))


@query(
    "median_separation",
    f"""
    WITH {TEXT_SHAPE},
    labelled AS (SELECT * FROM text_shape JOIN labels USING (doc_id)),
    {_box_sql("labelled", "quality", TEXT_FEATURES)},
    sides AS (
      SELECT feature,
             max(median) FILTER (label = 0) AS median_low,
             max(median) FILTER (label = 1) AS median_high,
             max(q1) FILTER (label = 0) AS q1_low, max(q3) FILTER (label = 0) AS q3_low
      FROM stats GROUP BY feature
    )
    SELECT feature, round(median_low, 9) AS median_low, round(median_high, 9) AS median_high,
           median_high > q3_low AS high_above_low_box, median_high < q1_low AS high_below_low_box
    FROM sides
    """,
)
def median_separation(spark, sf_dir):
    """Which text features tell good documents from bad ones by themselves."""
    shape = text_shape(load(spark, sf_dir, "documents"))
    labelled = shape.join(load(spark, sf_dir, "labels"), "doc_id")
    stats = profiling.boxplot_stats(labelled, TEXT_FEATURES, "quality")
    return profiling.median_separation(stats).withColumns(
        {c: F.round(c, 9) for c in ("median_low", "median_high")}
    )


_CANDIDATES = [
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_returnflag",
    "l_linestatus",
]


@query(
    "categorical_detection",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(DISTINCT {c}) <= 4 AS is_categorical, "
        f"CASE WHEN count(DISTINCT {c}) <= 4 THEN count(DISTINCT {c}) END AS n_categories, "
        f"count(DISTINCT {c}) AS n_distinct "
        "FROM lineitem"
        for c in _CANDIDATES
    ),
)
def categorical_detection(spark, sf_dir):
    return profiling.categorical_features(load(spark, sf_dir, "lineitem"), _CANDIDATES, 4)
