"""Reading and writing: files, tables, saved models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import columns, models, scoring, splits
from tabloom.queries.base import (
    HOURLY,
    TEXT_FEATURES,
    TEXT_SHAPE,
    hash01_sql,
    hourly,
    load,
    query,
    text_shape,
    work_schema,
)
from tabloom.session import scratch_path
from tabloom.sources import files, tables
from tabloom.sources.models import load_model, save_model


def _lineitem_csv(spark, sf_dir):
    path = scratch_path(spark, "lineitem-csv")
    files.write_csv(
        load(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate")), path
    )
    return files.read_csv(spark, path)


@query(
    "csv_scan",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus,
           strftime(CAST(l_shipdate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate
    FROM lineitem
    """,
)
def csv_scan(spark, sf_dir):
    """Types inferred from the text, times to the microsecond."""
    path = scratch_path(spark, "lineitem-csv")
    lineitem = load(spark, sf_dir, "lineitem")
    files.write_csv(lineitem, path)
    return files.read_csv(spark, path).select(
        *(F.col(f.name).cast(f.dataType) for f in lineitem.schema.fields if f.name != "l_shipdate"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("l_shipdate"),
    )


def _integer_type(column: str) -> str:
    return f"CASE WHEN max({column}) <= 2147483647 THEN 'int' ELSE 'bigint' END"


_INFERRED = [
    ("l_orderkey", _integer_type("l_orderkey")),
    ("l_partkey", _integer_type("l_partkey")),
    ("l_suppkey", _integer_type("l_suppkey")),
    ("l_linenumber", _integer_type("l_linenumber")),
    ("l_quantity", "'double'"),
    ("l_extendedprice", "'double'"),
    ("l_discount", "'double'"),
    ("l_tax", "'double'"),
    ("l_returnflag", "'string'"),
    ("l_linestatus", "'string'"),
    ("l_shipdate", "'date'"),
]


@query(
    "schema_report",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{name}' AS name, {kind} AS type, "
        "true AS nullable FROM lineitem"
        + ("" if "max(" in kind else " HAVING count(*) > 0")
        for i, (name, kind) in enumerate(_INFERRED)
    ),
)
def schema_report(spark, sf_dir):
    """Schema inferred from the text of a whole table."""
    return columns.schema_report(_lineitem_csv(spark, sf_dir))


@query("csv_scan_semicolon", "SELECT * FROM part")
def csv_scan_semicolon(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    path = scratch_path(spark, "part-csv")
    files.write_csv(part, path, sep=";")
    scanned = files.read_csv(spark, path, sep=";")
    return scanned.select(*(F.col(f.name).cast(f.dataType) for f in part.schema.fields))


@query("table_roundtrip", "SELECT * FROM customer")
def table_roundtrip(spark, sf_dir):
    name = f"{work_schema(spark)}.customers"
    tables.overwrite_table(load(spark, sf_dir, "customer"), name)
    return tables.read_table(spark, name)


@query(
    "path_roundtrip",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
    FROM orders
    """,
)
def path_roundtrip(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders")
    files.overwrite_path(orders.select("o_orderkey"), path)
    files.overwrite_path(orders, path)
    return files.read_path(spark, path).withColumn(
        "o_orderdate", F.col("o_orderdate").cast("string")
    )


@query(
    "table_overwrite_schema",
    "SELECT s_suppkey, s_acctbal, CAST(s_acctbal < 0 AS INTEGER) AS in_debt FROM supplier",
)
def table_overwrite_schema(spark, sf_dir):
    """A table replaced by one with other columns."""
    name = f"{work_schema(spark)}.suppliers"
    supplier = load(spark, sf_dir, "supplier")
    tables.overwrite_table(supplier, name)
    tables.overwrite_table(
        supplier.select(
            "s_suppkey", "s_acctbal", (F.col("s_acctbal") < 0).cast("int").alias("in_debt")
        ),
        name,
    )
    return tables.read_table(spark, name)


_ROUNDED = ", ".join(f"round({c}, 9) AS {c}" for c in TEXT_FEATURES)


@query(
    "scoring_batch_from_split",
    f"""
    WITH {TEXT_SHAPE}
    SELECT doc_id, {_ROUNDED} FROM text_shape WHERE {hash01_sql(123, "doc_id")} < 0.6
    """,
)
def scoring_batch_from_split(spark, sf_dir):
    """Training rows stored as a table, standing for a new batch to score."""
    shape = text_shape(load(spark, sf_dir, "documents"))
    weights = {"train": 0.6, "validation": 0.2, "test": 0.2}
    name = f"{work_schema(spark)}.batch"
    batch = splits.hash_split(shape, ["doc_id"], weights, seed=123)
    tables.overwrite_table(batch.where("split = 'train'").drop("split"), name)
    return tables.read_table(spark, name).select(
        "doc_id", *(F.round(c, 9).alias(c) for c in TEXT_FEATURES)
    )


@query(
    "model_save_load_score",
    f"""
    WITH {HOURLY}
    SELECT instant, hr, round(avg(cnt) OVER (PARTITION BY hr), 6) AS prediction FROM hourly
    """,
)
def model_save_load_score(spark, sf_dir):
    """Predictions of a model that went to storage and back."""
    hours = hourly(spark, sf_dir).select("instant", "hr", "cnt")
    stages = models.pipeline(["hr"], models.tree_regressor("cnt", maxDepth=30), None)
    path = scratch_path(spark, "model")
    save_model(models.fit(hours, stages), path, scoring.infer_signature(hours, ["hr"]))
    saved = load_model(spark, path)
    rows = scoring.check_signature(hours.drop("cnt"), saved.signature)
    return scoring.predict(rows, saved.pipeline).withColumn(
        "prediction", F.round("prediction", 6)
    )


@query(
    "preview_top_n",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity LIMIT 10
    """,
)
def preview_top_n(spark, sf_dir):
    wanted = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return columns.preview(load(spark, sf_dir, "lineitem").select(*wanted), wanted, 10)
