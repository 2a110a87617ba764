"""Feature tables, lookups, training sets and scoring by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.functions.hashing import real_time_measurement
from tabloom.operators import features, models, scoring
from tabloom.operators.features import FeatureLookup
from tabloom.operators.joins import lookup_join
from tabloom.queries.base import SQL, hash01_sql, load, query, work_schema
from tabloom.session import scratch_path
from tabloom.sources.models import load_model, save_model

_ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _part_features(spark, sf_dir, schema):
    name = f"{schema}.part_features"
    part = load(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice", "p_brand")
    features.create_feature_table(spark, name, "p_partkey", part, description="part features")
    return name


def _part_changes(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    stored = ["p_partkey", "p_size", "p_retailprice", "p_brand"]
    changed = part.where("p_type = 'ECONOMY'").withColumn("p_size", F.col("p_size") + 100)
    added = part.where("p_type = 'PROMO'").withColumn("p_partkey", -F.col("p_partkey") - 1)
    return changed.select(*stored).unionByName(added.select(*stored))


def _supplier_features(spark, sf_dir, schema):
    name = f"{schema}.supplier_features"
    supplier = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    features.create_feature_table(spark, name, "s_suppkey", supplier)
    return name


def _labelled(spark, sf_dir):
    """Keys, label and a column known only when scoring."""
    measured = F.round(real_time_measurement(7, *_ROW_KEY), 9).alias("real_time_measurement")
    return load(spark, sf_dir, "lineitem").select(*_ROW_KEY, "l_quantity", measured)


_LABELLED = f"""
labelled AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
         round(10 * {hash01_sql(7, *_ROW_KEY)}, 9) AS real_time_measurement
  FROM lineitem
)
"""


@query(
    "training_set_lookup",
    f"""
    WITH {_LABELLED}
    SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, real_time_measurement,
           p_size, p_retailprice, p_brand
    FROM labelled LEFT JOIN part ON l_partkey = p_partkey
    """,
)
def training_set_lookup(spark, sf_dir):
    """All features of a table by key; the key itself is left out."""
    table = _part_features(spark, sf_dir, work_schema(spark))
    return features.create_training_set(
        _labelled(spark, sf_dir),
        [FeatureLookup(table, "l_partkey")],
        label="l_quantity",
        exclude_columns="l_partkey",
    ).load_df()


@query(
    "training_set_lookup_subset",
    "SELECT doc_id, lang, n_chars, quality FROM documents LEFT JOIN labels USING (doc_id)",
)
def training_set_lookup_subset(spark, sf_dir):
    """One named feature; documents without an entry keep their row."""
    table = f"{work_schema(spark)}.document_labels"
    features.create_feature_table(spark, table, "doc_id", load(spark, sf_dir, "labels"))
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    lookup = FeatureLookup(table, "doc_id", ("quality",))
    return features.create_training_set(docs, [lookup], label="n_chars").load_df()


@query(
    "training_set_multi_lookup",
    f"""
    WITH {_LABELLED}
    SELECT l_orderkey, l_linenumber, l_quantity, real_time_measurement,
           p_size, p_retailprice, s_nationkey, s_acctbal
    FROM labelled LEFT JOIN part ON l_partkey = p_partkey
                  LEFT JOIN supplier ON l_suppkey = s_suppkey
    """,
)
def training_set_multi_lookup(spark, sf_dir):
    schema = work_schema(spark)
    lookups = [
        FeatureLookup(
            _part_features(spark, sf_dir, schema), "l_partkey", ("p_size", "p_retailprice")
        ),
        FeatureLookup(_supplier_features(spark, sf_dir, schema), "l_suppkey"),
    ]
    return features.create_training_set(
        _labelled(spark, sf_dir), lookups, "l_quantity", ["l_partkey", "l_suppkey"]
    ).load_df()


@query(
    "score_batch_lookup",
    f"""
    WITH {_LABELLED},
    joined AS (SELECT * FROM labelled LEFT JOIN part ON l_partkey = p_partkey)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, real_time_measurement, p_size,
           round(avg(l_quantity) OVER (PARTITION BY p_size), 6) AS prediction
    FROM joined
    """,
)
def score_batch_lookup(spark, sf_dir):
    """Rows with keys only: the saved model fetches the features it was trained on."""
    table = _part_features(spark, sf_dir, work_schema(spark))
    labelled = _labelled(spark, sf_dir)
    training = features.create_training_set(
        labelled, [FeatureLookup(table, "l_partkey", ("p_size",))], "l_quantity"
    )
    rows = training.load_df()
    used = ["p_size"]
    tree = models.tree_regressor("l_quantity", maxDepth=30, maxBins=64, weightCol="n_rows")
    # 50 sizes and 50 quantities: distinct pairs with counts stand for all rows.
    merged = models.merge_repeats(rows, [*used, "l_quantity"])
    model = models.fit(merged, models.pipeline(used, tree, None))
    path = scratch_path(spark, "model")
    save_model(model, path, scoring.infer_signature(rows, used), training.recipe)
    batch = labelled.drop("l_quantity")
    scored = scoring.score_saved(batch, load_model(spark, path))
    return scored.withColumn("prediction", F.round("prediction", 6))


@query(
    "feature_table_upsert",
    """
    SELECT p_partkey, p_size, p_retailprice, p_brand FROM part WHERE p_type <> 'ECONOMY'
    UNION ALL
    SELECT p_partkey, p_size + 100, p_retailprice, p_brand FROM part WHERE p_type = 'ECONOMY'
    UNION ALL
    SELECT -p_partkey - 1, p_size, p_retailprice, p_brand FROM part WHERE p_type = 'PROMO'
    """,
)
def feature_table_upsert(spark, sf_dir):
    """Changed rows replace theirs, new keys are added."""
    table = _part_features(spark, sf_dir, work_schema(spark))
    features.write_feature_table(spark, table, _part_changes(spark, sf_dir))
    return spark.read.table(table)


_UPSERT_SQL = SQL["feature_table_upsert"]


@query("feature_table_upsert_layered", _UPSERT_SQL)
def feature_table_upsert_layered(spark, sf_dir):
    """The same, read while the changes still lie over an untouched base."""
    schema = work_schema(spark)
    table = _part_features(spark, sf_dir, schema)
    features.write_feature_table(
        spark, table, _part_changes(spark, sf_dir), compact_share=float("inf")
    )
    return spark.read.table(table)


@query(
    "training_set_lookup_skewed",
    """
    WITH kinds AS (
      SELECT event_type, count(*) AS n_events, round(avg(value), 6) AS mean_value
      FROM events GROUP BY event_type
    )
    SELECT event_id, event_type, user_id, n_events, mean_value
    FROM events LEFT JOIN kinds USING (event_type)
    """,
)
def training_set_lookup_skewed(spark, sf_dir):
    """Keys that each hold a fifth of the rows, salted as if no side were small."""
    events = load(spark, sf_dir, "events")
    kinds = events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.round(F.avg("value"), 6).alias("mean_value")
    )
    rows = events.select("event_id", "event_type", "user_id")
    return lookup_join(rows, kinds, ["event_type"], small_bytes=0, rows_per_task=100)


@query(
    "training_set_lookup_mixed_types",
    """
    WITH lines AS (
      SELECT l_linenumber AS line, count(*) AS n_lines, sum(l_orderkey) AS orderkey_sum
      FROM lineitem GROUP BY l_linenumber
    )
    SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS INTEGER) AS line, n_lines,
           CAST(orderkey_sum AS BIGINT) AS orderkey_sum
    FROM lineitem LEFT JOIN lines ON l_linenumber = line
    """,
)
def training_set_lookup_mixed_types(spark, sf_dir):
    """Few keys, 32-bit beside 64-bit features, salted: every row finds its features."""
    lineitem = load(spark, sf_dir, "lineitem")
    lines = lineitem.groupBy(F.col("l_linenumber").cast("bigint").alias("line")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_orderkey").alias("orderkey_sum")
    )
    rows = lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_linenumber").cast("int").alias("line")
    )
    return lookup_join(rows, lines, ["line"], small_bytes=0, rows_per_task=100)


@query(
    "training_set_lookup_text_keys",
    """
    WITH asked AS (
      SELECT l_orderkey, l_linenumber, CAST(l_partkey AS BIGINT) AS part FROM lineitem
    ),
    named AS (
      SELECT CAST(p_partkey AS VARCHAR) AS part, p_size FROM part
      UNION ALL
      SELECT '0' || p_partkey, p_size + 100 FROM part WHERE p_partkey > 0
    )
    SELECT l_orderkey, l_linenumber, asked.part, p_size
    FROM asked LEFT JOIN named ON CAST(asked.part AS VARCHAR) = named.part
    """,
)
def training_set_lookup_text_keys(spark, sf_dir):
    """Feature keys ``7`` and ``07`` are two keys; a number finds the one it is written as."""
    name = f"{work_schema(spark)}.named_parts"
    part = load(spark, sf_dir, "part")
    plain = part.select(F.col("p_partkey").cast("string").alias("part"), "p_size")
    padded = part.where("p_partkey > 0").select(
        F.concat(F.lit("0"), F.col("p_partkey").cast("string")).alias("part"),
        (F.col("p_size") + 100).alias("p_size"),
    )
    features.create_feature_table(spark, name, "part", plain.unionByName(padded))
    rows = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("long").alias("part")
    )
    return features.apply_lookups(rows, [FeatureLookup(name)], small_bytes=0)


@query(
    "training_set_lookup_large_keys",
    """
    WITH base AS (SELECT 9007199254740992::BIGINT AS b),
    asked AS (
      SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(b + o_orderkey AS DOUBLE)
                              WHEN o_orderkey % 3 = 1 THEN CAST(o_orderkey AS DOUBLE)
                              ELSE o_orderkey + 0.5 END AS k
      FROM orders, base
    ),
    known AS (
      SELECT o_orderkey AS k, o_custkey FROM orders
      UNION ALL SELECT b + o_orderkey, -o_custkey FROM orders, base
    )
    SELECT asked.o_orderkey, asked.k, o_custkey
    FROM asked LEFT JOIN known
      ON abs(asked.k) < 9007199254740992 AND asked.k = floor(asked.k)
     AND CAST(floor(CASE WHEN abs(asked.k) < 9007199254740992 THEN asked.k END) AS BIGINT) = known.k
    """,
)
def training_set_lookup_large_keys(spark, sf_dir):
    """Double keys beside 64-bit ones, on both sides of 2**53: no row comes out twice."""
    base = F.lit(1 << 53)
    name = f"{work_schema(spark)}.large_keys"
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_custkey"
    )
    known = orders.select(F.col("o_orderkey").alias("k"), "o_custkey").unionByName(
        orders.select((base + F.col("o_orderkey")).alias("k"), (-F.col("o_custkey")).alias("o_custkey"))
    )
    features.create_feature_table(spark, name, "k", known)
    key, third = F.col("o_orderkey"), F.col("o_orderkey") % 3
    asked = F.when(third == 0, (base + key).cast("double")).when(third == 1, key.cast("double"))
    rows = orders.select("o_orderkey", asked.otherwise(key + F.lit(0.5)).cast("double").alias("k"))
    return features.apply_lookups(rows, [FeatureLookup(name)], small_bytes=0)


@query(
    "training_set_three_lookups_skewed",
    f"""
    WITH {_LABELLED},
    lines AS (
      SELECT l_linenumber, count(*) AS n_lines FROM lineitem GROUP BY l_linenumber
    )
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, real_time_measurement,
           p_size, p_retailprice, s_nationkey, s_acctbal, n_lines
    FROM labelled LEFT JOIN part ON l_partkey = p_partkey
                  LEFT JOIN supplier ON l_suppkey = s_suppkey
                  LEFT JOIN lines USING (l_linenumber)
    """,
)
def training_set_three_lookups_skewed(spark, sf_dir):
    """Three tables looked up as if none were small; the labelled rows are joined in one pass."""
    schema = work_schema(spark)
    lines = f"{schema}.line_features"
    counts = load(spark, sf_dir, "lineitem").groupBy("l_linenumber")
    features.create_feature_table(
        spark, lines, "l_linenumber", counts.agg(F.count(F.lit(1)).alias("n_lines"))
    )
    lookups = [
        FeatureLookup(
            _part_features(spark, sf_dir, schema), "l_partkey", ("p_size", "p_retailprice")
        ),
        FeatureLookup(_supplier_features(spark, sf_dir, schema), "l_suppkey"),
        FeatureLookup(lines),
    ]
    rows = _labelled(spark, sf_dir)
    return features.apply_lookups(rows, lookups, small_bytes=0, rows_per_task=100)


@query(
    "primary_key_violations",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber
    HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
    """,
)
def primary_key_violations(spark, sf_dir):
    return features.key_violations(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "feature_table_create",
    """
    SELECT c_custkey, c_nationkey, c_acctbal, 'c_custkey' AS key_columns,
           'customer features' AS description
    FROM customer
    """,
)
def feature_table_create(spark, sf_dir):
    """An empty keyed table from a schema, bucketed by key, then filled."""
    name = f"{work_schema(spark)}.customer_features"
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    features.create_feature_table(
        spark,
        name,
        ["c_custkey"],
        schema=rows.schema,
        description="customer features",
        buckets=8,
    )
    features.write_feature_table(spark, name, rows, mode="merge")
    spec = features.feature_table_spec(spark, name)
    return spark.read.table(name).select(
        "*",
        F.lit(",".join(spec.primary_keys)).alias("key_columns"),
        F.lit(spec.description).alias("description"),
    )


@query(
    "signature_check",
    """
    SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_quantity, l_returnflag
    FROM lineitem
    """,
)
def signature_check(spark, sf_dir):
    """Integers widened to what a model expects; a further column passes through."""
    rows = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    trained_on = rows.select(F.col("l_linenumber").cast("double"), "l_quantity")
    signature = scoring.infer_signature(trained_on, ["l_linenumber", "l_quantity"])
    return scoring.check_signature(rows, signature)
