from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabloom.session import scratch_path
from tabloom.sources import files, tables


def _rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test")


@pytest.mark.parametrize("sep", [",", ";"])
def test_csv_types_are_inferred(spark, path, sep):
    rows = spark.createDataFrame(
        [(1, 0.5, "a", "2011-01-01"), (2, None, "b", "2012-12-31")],
        "hr int, temp double, s string, day string",
    ).withColumn("day", F.to_date("day"))
    files.write_csv(rows, path, sep)
    scanned = files.read_csv(spark, path, sep)
    assert dict(scanned.dtypes) == {"hr": "int", "temp": "double", "s": "string", "day": "date"}
    assert _rows(scanned) == _rows(rows)


def test_csv_with_schema_or_sample(spark, path):
    files.write_csv(spark.range(1000), path)
    assert files.read_csv(spark, path, schema="id string").dtypes == [("id", "string")]
    assert files.read_csv(spark, path, sampling_ratio=0.5).dtypes == [("id", "int")]


def test_csv_quotes_separators_and_line_breaks(spark, path):
    rows = spark.createDataFrame([("say \"hi\", you",), ("a;b",), ("two\nlines",)], "s string")
    files.write_csv(rows, path)
    assert _rows(files.read_csv(spark, path, multi_line=True)) == _rows(rows)


def test_csv_as_others_write_it(spark, tmp_path):
    (tmp_path / "w.csv").write_text('fixed acidity;name;quality\n7.4;"a ""b""; c";5\n')
    scanned = files.read_csv(spark, f"file://{tmp_path}/w.csv", sep=";")
    assert scanned.columns == ["fixed acidity", "name", "quality"]
    assert tuple(scanned.first()) == (7.4, 'a "b"; c', 5)


def test_path_is_replaced(spark, path):
    files.overwrite_path(spark.range(10), path)
    files.overwrite_path(spark.range(3).withColumn("p", F.lit("x")), path, ("p",))
    assert _rows(files.read_path(spark, path)) == _rows(spark.range(3).withColumn("p", F.lit("x")))


def test_table_is_replaced_with_its_schema(spark, schema):
    name = f"{schema}.t"
    tables.overwrite_table(spark.range(10), name)
    tables.overwrite_table(spark.range(4).select(F.col("id").cast("string").alias("s")), name, ("s",), 2)
    assert tables.read_table(spark, name).dtypes == [("s", "string")]
    assert tables.read_table(spark, name).count() == 4


def test_schema_can_be_used(spark, schema):
    tables.ensure_schema(spark, schema)
    tables.use_schema(spark, schema)
    try:
        tables.overwrite_table(spark.range(2), "short_name")
        assert spark.read.table(f"{schema}.short_name").count() == 2
    finally:
        tables.use_schema(spark, "default")


def test_view_properties_survive_quotes(spark, schema):
    tables.overwrite_table(spark.range(2), f"{schema}.base")
    view, text = f"{schema}.v", "it's a \\ path"
    tables.publish_view(spark, view, f"SELECT * FROM {schema}.base", text, {"k": text})
    assert tables.table_properties(spark, view)["k"] == text
    assert tables.table_comment(spark, view) == text
