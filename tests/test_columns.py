from __future__ import annotations

import pytest

from tabloom.functions.names import account_prefix, unique_name
from tabloom.operators import columns, stages


def test_rename_and_collision(spark):
    rows = spark.createDataFrame([(1, 2)], ["fixed acidity", "p_h"])
    assert columns.normalize_names(rows).columns == ["fixed_acidity", "p_h"]
    with pytest.raises(ValueError, match="collide"):
        columns.normalize_names(spark.createDataFrame([(1, 2)], ["a b", "a_b"]))


def test_union_goes_by_name_and_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], ["n", "s"])
    b = spark.createDataFrame([("y", 2)], ["s", "n"])
    got = sorted(map(tuple, columns.union_flagged(a, b, "is_a").collect()))
    assert got == [(1, "x", 1), (1, "x", 1), (2, "y", 0)]


def test_binarize_keeps_null(spark):
    rows = spark.createDataFrame([(6,), (7,), (None,)], "q int")
    assert [r[0] for r in rows.select(columns.binarize("q", 7)).collect()] == [0, 1, None]


def test_drop_and_feature_list(spark):
    rows = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"])
    assert columns.drop_columns(rows, ["b"]).columns == ["a", "c"]
    with pytest.raises(ValueError, match="nope"):
        columns.drop_columns(rows, ["nope"])
    assert columns.feature_columns(rows, ["b"]) == ["a", "c"]


def test_preview_is_ordered(spark):
    rows = spark.range(100).repartition(7)
    assert [r["id"] for r in columns.preview(rows, ["id"], 3).collect()] == [0, 1, 2]


def test_schema_report(spark):
    rows = spark.createDataFrame([(1, "a")], "i int NOT NULL, s string")
    got = [tuple(r) for r in columns.schema_report(rows).orderBy("position").collect()]
    assert got == [(0, "i", "int", False), (1, "s", "string", True)]


def test_account_prefix(spark):
    rows = spark.createDataFrame([("jo.q.public@example.com",), ("plain",)], "u string")
    assert [r[0] for r in rows.select(account_prefix("u")).collect()] == ["jo_q_public", "plain"]
    assert unique_name("t") != unique_name("t")


def test_labels_are_alphabetical_and_decode(spark):
    rows = spark.createDataFrame([("setosa",), ("virginica",), ("setosa",), ("alba",)], "s string")
    indexer = stages.label_indexer("s").fit(rows)
    indexed = indexer.transform(rows)
    assert [r["label_index"] for r in indexed.collect()] == [1.0, 2.0, 1.0, 0.0]
    back = stages.label_decoder(indexer, "label_index", "again").transform(indexed)
    assert all(r["s"] == r["again"] for r in back.collect())


def test_unseen_label(spark):
    seen = spark.createDataFrame([("a",), ("b",)], "s string")
    unseen = spark.createDataFrame([("c",)], "s string")
    kept = stages.label_indexer("s", handle_invalid="keep").fit(seen).transform(unseen)
    assert kept.first()["label_index"] == 2.0
    with pytest.raises(Exception, match="(?i)unseen"):
        stages.label_indexer("s").fit(seen).transform(unseen).collect()


def test_invalid_values_when_assembling(spark):
    rows = spark.createDataFrame([(1.0, None)], "a double, b double")
    vector = stages.assembler(["a", "b"]).transform(rows).first()["rawFeatures"]
    assert vector[0] == 1.0 and vector[1] != vector[1]
    with pytest.raises(Exception):
        stages.assembler(["a", "b"], handle_invalid="error").transform(rows).collect()


def test_unseen_category_when_indexing(spark):
    fit_on = spark.createDataFrame([(float(i % 3), float(i)) for i in range(30)], "a double, b double")
    new = spark.createDataFrame([(7.0, 1.0)], "a double, b double")
    vectors = stages.assembler(["a", "b"]).transform
    kept = stages.category_indexer(4).fit(vectors(fit_on)).transform(vectors(new))
    assert kept.first()["features"][0] == 3.0
    strict = stages.category_indexer(4, handle_invalid="error").fit(vectors(fit_on))
    with pytest.raises(Exception):
        strict.transform(vectors(new)).collect()
