"""Projections, ids, labels and unions."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tabloom.functions.hashing import real_time_measurement
from tabloom.functions.names import account_prefix, column_safe_expr
from tabloom.operators import columns, ordering, stages
from tabloom.queries.base import HOURLY, hash01_sql, hourly, load, query


@query(
    "drop_leakage_columns",
    f"WITH {HOURLY} SELECT hr, weekday, workingday, cnt FROM hourly",
)
def drop_leakage_columns(spark, sf_dir):
    """Without index, date and the two parts that add up to the label."""
    return columns.drop_columns(
        hourly(spark, sf_dir), ["instant", "dteday", "casual", "registered"]
    )


@query(
    "select_columns",
    "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber FROM lineitem",
)
def select_columns(spark, sf_dir):
    """Label first, then the list of features."""
    lineitem = load(spark, sf_dir, "lineitem")
    features = ["l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    return lineitem.select("l_quantity", *features)


@query(
    "normalize_column_names",
    """
    SELECT p_partkey AS p_part_key, p_name AS p_full_name, p_brand, p_type, p_size,
           p_retailprice AS p_retail_price
    FROM part
    """,
)
def normalize_column_names(spark, sf_dir):
    spaced = load(spark, sf_dir, "part").withColumnsRenamed(
        {"p_partkey": "p part key", "p_name": "p full name", "p_retailprice": "p retail price"}
    )
    return columns.normalize_names(spaced)


@query(
    "union_with_source_flag",
    """
    SELECT doc_id, lang, source, n_chars, CAST(lang = 'en' AS INTEGER) AS is_en FROM documents
    """,
)
def union_with_source_flag(spark, sf_dir):
    """Two files with columns in different order, put together with a flag."""
    docs = load(spark, sf_dir, "documents")
    english = docs.where("lang = 'en'").select("doc_id", "lang", "source", "n_chars")
    others = docs.where("lang <> 'en'").select("n_chars", "source", "lang", "doc_id")
    return columns.union_flagged(english, others, "is_en")


@query(
    "binarize_label",
    "SELECT p_partkey, CAST(p_size >= 25 AS INTEGER) AS p_size FROM part",
)
def binarize_label(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    return part.select("p_partkey", columns.binarize("p_size", 25).alias("p_size"))


@query(
    "add_row_id",
    """
    SELECT event_id, event_type, user_id,
           row_number() OVER (ORDER BY event_type, user_id, event_id) - 1 AS row_id
    FROM events
    """,
)
def add_row_id(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    return ordering.dense_row_id(events, "row_id", ["event_type", "user_id", "event_id"])


@query(
    "realtime_feature",
    f"""
    SELECT event_id, value, round(10 * {hash01_sql(7, "event_id")}, 9) AS real_time_measurement
    FROM events
    """,
)
def realtime_feature(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    return events.select(
        "event_id",
        "value",
        F.round(real_time_measurement(7, "event_id"), 9).alias("real_time_measurement"),
    )


@query(
    "struct_features",
    """
    SELECT l_orderkey, l_linenumber, l_quantity AS packed_quantity,
           l_extendedprice AS packed_price, l_discount AS packed_discount
    FROM lineitem
    """,
)
def struct_features(spark, sf_dir):
    """Features packed into a struct; the parts are read back out of it."""
    packed = load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        columns.pack(["l_quantity", "l_extendedprice", "l_discount"]).alias("features"),
    )
    return packed.select(
        "l_orderkey",
        "l_linenumber",
        F.col("features.l_quantity").alias("packed_quantity"),
        F.col("features.l_extendedprice").alias("packed_price"),
        F.col("features.l_discount").alias("packed_discount"),
    )


@query(
    "label_index",
    """
    SELECT doc_id, lang, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS DOUBLE) AS label_index
    FROM documents
    """,
)
def label_index(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang")
    return stages.label_indexer("lang").fit(docs).transform(docs)


@query(
    "crossed_feature",
    """
    SELECT o_orderkey, crossing,
           CAST(dense_rank() OVER (ORDER BY crossing) - 1 AS DOUBLE) AS crossing_index
    FROM (SELECT o_orderkey, concat_ws('_x_', o_orderstatus, o_orderpriority) AS crossing
          FROM orders)
    """,
)
def crossed_feature(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    crossed = stages.crossed(orders, ["o_orderstatus", "o_orderpriority"], "crossing")
    indexer = stages.label_indexer("crossing", "crossing_index")
    return (
        Pipeline(stages=[indexer])
        .fit(crossed)
        .transform(crossed)
        .select("o_orderkey", "crossing", "crossing_index")
    )


@query(
    "scalar_name_rules",
    """
    SELECT p_partkey, replace(p_name, ' ', '_') AS safe_name,
           replace(split_part(concat(replace(p_name, ' ', '.'), '@', lower(p_brand)), '@', 1),
                   '.', '_') AS account
    FROM part
    """,
)
def scalar_name_rules(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    address = F.concat(F.replace("p_name", F.lit(" "), F.lit(".")), F.lit("@"), F.lower("p_brand"))
    return part.select(
        "p_partkey",
        column_safe_expr("p_name").alias("safe_name"),
        account_prefix(address).alias("account"),
    )
