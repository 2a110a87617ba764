from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators import columns, models, scoring
from tabloom.session import scratch_path
from tabloom.sources.models import load_model, save_model


def _signature(ddl):
    return T.StructType.fromDDL(ddl)


def test_signature(spark):
    rows = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, extra string")
    checked = scoring.check_signature(rows, _signature("a double, b double"))
    assert dict(checked.dtypes) == {"a": "double", "b": "double", "extra": "string"}
    assert scoring.check_signature(rows, _signature("a int")) is rows
    with pytest.raises(ValueError, match="lacks"):
        scoring.check_signature(rows, _signature("c int"))
    with pytest.raises(ValueError, match="expects"):
        scoring.check_signature(rows, _signature("b int"))
    # Not every 64-bit integer is a double.
    with pytest.raises(ValueError, match="expects"):
        scoring.check_signature(spark.range(1).toDF("a"), _signature("a double"))
    with pytest.raises(ValueError, match="expects"):
        scoring.check_signature(rows, _signature("extra double"))


@pytest.fixture(scope="module")
def steps(spark):
    return spark.range(400).select(
        "id", (F.col("id") % 20).cast("double").alias("x"),
        ((F.col("id") % 20) >= 12).cast("int").alias("y"),
    )


def test_classifier_probability_and_class_agree(spark, steps):
    model = models.fit(steps, models.pipeline(["x"], models.baseline_forest("y", maxDepth=5), None))
    scored = model.transform(steps).select("y", "prediction", scoring.positive_probability().alias("p"))
    rows = scored.collect()
    assert all(0 <= r["p"] <= 1 and (r["p"] > 0.5) == (r["prediction"] == 1.0) for r in rows)
    assert all(r["prediction"] == r["y"] for r in rows)


def test_importances(spark, steps):
    noisy = steps.withColumn("noise", F.hash("id").cast("double") % 5)
    used = ["noise", "x"]
    model = models.fit(noisy, models.pipeline(used, models.forest_regressor("y"), None))
    got = models.feature_importance(noisy, model, used).collect()
    assert [r["feature"] for r in got] == ["x", "noise"]
    assert abs(sum(r["importance"] for r in got) - 1) < 1e-9


def test_reload_predicts_the_same(spark, steps):
    model = models.fit(steps, models.pipeline(["x"], models.boosted_regressor("y", maxIter=3), 4))
    path = scratch_path(spark, "model")
    signature = scoring.infer_signature(steps, ["x"])
    save_model(model, path, signature)
    saved = load_model(spark, path)
    assert saved.signature == signature and saved.recipe == []
    before = scoring.predict(steps, model).orderBy("id").collect()
    assert scoring.predict(steps, saved.pipeline).orderBy("id").collect() == before


def test_output_schema_is_saved_and_checked(spark, steps):
    model = models.fit(steps, models.pipeline(["x"], models.tree_regressor("y"), None))
    output = scoring.infer_output_signature(steps, scoring.predict(steps, model))
    assert [(f.name, f.dataType) for f in output.fields] == [("prediction", T.DoubleType())]
    path = scratch_path(spark, "model")
    save_model(model, path, scoring.infer_signature(steps, ["x"]), output=output)
    saved = load_model(spark, path)
    assert [(f.name, f.dataType) for f in saved.output.fields] == [("prediction", T.DoubleType())]
    assert scoring.score_saved(steps, saved, "score").columns == [*steps.columns, "score"]
    for wrong, said in (("prediction int", "saved with"), ("other double", "lacks")):
        save_model(model, path, scoring.infer_signature(steps, ["x"]), output=_signature(wrong))
        with pytest.raises(ValueError, match=said):
            scoring.score_saved(steps, load_model(spark, path))


def test_forest_does_not_depend_on_the_layout(spark, steps):
    noisy = steps.withColumns({"noise": F.hash("id") % 50, "y": (F.hash("x", "id") % 3 == 0).cast("int")})
    forest = models.pipeline(["x", "noise"], models.baseline_forest("y", maxDepth=8), None)
    scored = [
        scoring.predict_probability(steps.select("id", "x").join(noisy.select("id", "noise"), "id"),
                                    models.fit(noisy.repartition(n), forest)).orderBy("id").collect()
        for n in (2, 7)
    ]
    assert scored[0] == scored[1]


def test_single_stage_can_be_saved(spark, steps):
    prepared = models.fit(steps, models.pipeline(["x"], models.tree_regressor("y"), None))
    path = scratch_path(spark, "stage")
    save_model(prepared.stages[-1], path, scoring.infer_signature(steps, ["x"]))
    assert len(load_model(spark, path).pipeline.stages) == 1


def test_python_scorer_loads_once_per_task(spark):
    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)
        return lambda batch: batch["a"] * batch["b"]

    rows = spark.range(1000, numPartitions=3).select(F.col("id").cast("double").alias("a"), F.lit(2.0).alias("b"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        score = scoring.python_scorer(load)
        got = rows.withColumn("p", score(columns.pack(["a", "b"]))).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert all(r["p"] == r["a"] * 2 for r in got)
    assert loads.value == 3


def test_classes_by_name(spark, steps):
    model = models.fit(steps, models.pipeline(["x"], models.tree_classifier("y"), None))
    got = scoring.predict_class(steps, model, ["low", "high"]).collect()
    assert all(r["predicted_label"] == ("high" if r["y"] else "low") for r in got)


def test_missing_feature_is_kept(spark, steps):
    model = models.fit(steps, models.pipeline(["x"], models.tree_classifier("y"), None))
    rows = spark.createDataFrame([(1, None)], "id bigint, x double")
    assert scoring.predict(rows, model).first()["prediction"] in (0.0, 1.0)


def test_counted_rows_train_the_same_trees(spark, steps):
    noisy = steps.withColumn("y", F.when(F.hash("id") % 5 == 0, 1 - F.col("y")).otherwise(F.col("y")))
    merged = models.merge_repeats(noisy, ["x", "y"])
    assert merged.count() < noisy.count()
    for build in (
        lambda **kw: models.tree_regressor("y", maxDepth=3, **kw),
        lambda **kw: models.boosted_regressor("y", maxDepth=2, maxIter=3, **kw),
        lambda **kw: models.forest_classifier("y", numTrees=3, bootstrap=False, **kw),
    ):
        plain = models.fit(noisy, models.pipeline(["x"], build(), None))
        counted = models.fit(merged, models.pipeline(["x"], build(weightCol="n_rows"), None))
        a = [r["prediction"] for r in scoring.predict(noisy, plain).orderBy("id").collect()]
        b = [r["prediction"] for r in scoring.predict(noisy, counted).orderBy("id").collect()]
        assert max(abs(p - q) for p, q in zip(a, b)) < 1e-9
