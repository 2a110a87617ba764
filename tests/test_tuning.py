from __future__ import annotations

from math import exp

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabloom.operators import models, scoring, stages, tuning


def test_grid_has_all_points(spark):
    points = tuning.grid_points(tuning.BOOSTING_GRID)
    assert [(p["maxDepth"], p["maxIter"]) for p in points] == [(2, 10), (2, 100), (5, 10), (5, 100)]
    maps = tuning.param_maps(models.boosted_regressor("y"), tuning.BOOSTING_GRID)
    assert sorted(sorted(m.values()) for m in maps) == sorted(sorted(p.values()) for p in points)
    assert tuning.with_grid(spark.range(3), tuning.BOOSTING_GRID).count() == 12


def test_draws_stay_in_range_and_repeat(spark):
    drawn = tuning.draw_trials(spark.range(500), "id", tuning.BOOSTING_SPACE, 123)
    rows = drawn.collect()
    assert all(4 <= r["max_depth"] <= 100 and r["max_depth"] == int(r["max_depth"]) for r in rows)
    assert all(exp(-3) <= r["learning_rate"] <= 1 for r in rows)
    assert all(exp(-1) <= r["min_child_weight"] <= exp(3) for r in rows)
    assert {(r["objective"], r["seed"]) for r in rows} == {("binary:logistic", 123)}
    again = tuning.draw_trials(spark.range(500).repartition(9), "id", tuning.BOOSTING_SPACE, 123)
    assert sorted(again.collect()) == sorted(rows)


def test_settings_of_a_trial():
    trial = {"max_depth": 77.0, "learning_rate": 0.2, "min_child_weight": 0.4, "seed": 123}
    assert tuning.boosting_params(trial) == {
        "maxDepth": 30, "stepSize": 0.2, "minInstancesPerNode": 1, "seed": 123
    }
    logged = tuning.fitted_params({**trial, "reg_alpha": 0.5})
    assert logged == {
        "max_depth": 30, "drawn_max_depth": 77.0, "learning_rate": 0.2, "seed": 123,
        "min_child_weight": 1, "drawn_min_child_weight": 0.4, "reg_alpha": 0.5,
    }
    assert tuning.default_parallelism(30) == 5 and tuning.default_parallelism(96) == 10


def test_trials_without_a_metric_are_the_worst():
    trials = [tuning.Trial(i, {}, None, {"auc": v}) for i, v in enumerate([None, 0.4, float("nan"), 0.6])]
    assert tuning.best_trial(trials, "auc").number == 3
    with pytest.raises(ValueError, match="no trial"):
        tuning.best_trial([trials[0], trials[2]], "auc")


def test_cross_validation_takes_the_least_error(spark):
    rows = spark.range(600).select(
        (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 * 3.0).alias("y"),
        (F.col("id") % 3).cast("int").alias("fold"),
    )
    prepared = stages.assembler(["x"], "features").transform(rows)
    fitted, trials = tuning.cross_validate(
        prepared, models.tree_regressor("y"), {"maxDepth": [1, 5]},
        RegressionEvaluator(labelCol="y", metricName="rmse"), "fold",
    )
    got = {r["params"]["maxDepth"]: r["avg_metric"] for r in trials.collect()}
    assert got["5"] == pytest.approx(0) and got["1"] > 1
    assert fitted.bestModel.getOrDefault("maxDepth") == 5


def test_sweep_keeps_order_and_finds_the_best(spark):
    rows = spark.range(300).select((F.col("id") % 8).cast("double").alias("x"), (F.col("id") % 8 > 3).cast("int").alias("y"))
    prepared = stages.assembler(["x"], "features").transform(rows)
    trials = [{"depth": d} for d in (1, 2, 3)]
    done = tuning.sweep(
        prepared, trials,
        lambda t: models.tree_classifier("y", maxDepth=t["depth"]),
        lambda m: {"score": 1.0 if m.depth >= 1 else 0.0, "nodes": float(m.numNodes)},
        parallelism=2,
    )
    assert [t.params["depth"] for t in done] == [1, 2, 3]
    assert tuning.best_trial(done, "score").number == 0
    assert done[0].loss("score") == -1.0


def test_sweep_passes_errors_on(spark):
    rows = stages.assembler(["id"], "features").transform(spark.range(5)).withColumn("y", F.lit(1))

    def fail(model):
        raise RuntimeError("no measure")

    with pytest.raises(RuntimeError, match="no measure"):
        tuning.sweep(rows, [{}], lambda t: models.tree_regressor("y"), fail)


def test_parameters_that_are_not_numbers(spark):
    runs = spark.range(20).select(
        F.concat(F.lit("r"), "id").alias("run_id"),
        F.create_map(F.lit("n"), F.col("id").cast("string"), F.lit("kind"), F.lit("tree")).alias("params"),
        F.create_map(F.lit("auc"), F.col("id") * 2.0).alias("metrics"),
    )
    got = {r["param"]: (r["n_runs"], r["correlation"]) for r in tuning.param_metric_corr(runs, "auc").collect()}
    assert got["n"][0] == 20 and got["n"][1] == pytest.approx(1.0)
    assert got["kind"] == (0, None)


def test_patience_counts_rounds_without_gain():
    losses = [5.0, 4.0, 4.5, 3.0, 3.1, 3.0, 3.2, 1.0]
    assert models.patient_best(losses, 3, 1e-9) == (4, True)
    assert models.patient_best(losses, 4, 1e-9) == (8, False)
    # A gain too small to count does not start the waiting anew.
    assert models.patient_best([1.0, 1.0 - 1e-12, 1.0 - 2e-12], 2, 1e-9) == (1, True)


def test_patience_keeps_the_best_round(spark):
    # Held-out rows say the contrary of the others: every round after the first is worse.
    rows = spark.range(400).select(
        (F.col("id") % 4).cast("double").alias("x"),
        (F.pmod(F.xxhash64("id"), F.lit(10)) < F.col("id") % 4 * 2 + 2).cast("int").alias("y"),
        (F.col("id") % 5 == 0).alias("held_out"),
    )
    rows = rows.withColumn("y", F.when(F.col("held_out"), 1 - F.col("y")).otherwise(F.col("y")))
    stages_ = models.pipeline(["x"], models.boosted_classifier("y", maxDepth=2), None)
    model = models.fit_with_patience(rows, stages_, "held_out", patience=3, max_rounds=20)
    assert model.stages[-1].getNumTrees == 1
    same = rows.withColumn("y", F.when(F.col("held_out"), 1 - F.col("y")).otherwise(F.col("y")))
    regressor = models.pipeline(["x"], models.boosted_regressor("y", maxDepth=2, stepSize=0.1), None)
    model = models.fit_with_patience(same, regressor, "held_out", patience=2, max_rounds=4)
    assert 1 <= model.stages[-1].getNumTrees <= 4
    with pytest.raises(ValueError, match="no row"):
        models.fit_with_patience(rows.where("not held_out"), stages_, "held_out")


def test_trials_stage_in_the_callers_scope_and_are_stored_at_once(spark, tmp_path):
    from tabloom.session import noting, stage

    rows = spark.range(40).select((F.col("id") % 4).cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    rows = stages.assembler(["x"], "features").transform(rows)
    paths: list[str] = []

    def measure(model):
        return {"n": float(stage(model.transform(rows), "scored").count())}

    with noting(paths):
        done = tuning.sweep(
            rows, [{"d": 1}, {"d": 2}, {"d": 3}], lambda t: models.tree_regressor("y", maxDepth=t["d"]), measure, 3,
            lambda model: f"{tmp_path}/{model.depth}",
        )
    assert len(paths) == 3
    assert [t.model for t in done] == [None] * 3 and all(t.path for t in done)


def counting(monkeypatch, kind):
    """The numbers of rows that fits of a kind read from now on."""
    seen, plain = [], kind._fit
    monkeypatch.setattr(kind, "_fit", lambda self, rows: (seen.append(rows.count()), plain(self, rows))[1])
    return seen


def hours(spark, n=20_000):
    chance, part = F.pmod(F.xxhash64("id"), F.lit(100)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3))
    hr = F.col("id") % 6
    return spark.range(n).select(
        "id", hr.cast("double").alias("hr"), (chance < 30 + 8 * hr).cast("int").alias("high"), part.cast("int").alias("fold")
    )


def test_grid_search_reads_equal_rows_once(spark, monkeypatch):
    seen = counting(monkeypatch, GBTClassifier)
    prepared = VectorAssembler(inputCols=["hr"], outputCol="features").transform(hours(spark))
    judge = MulticlassClassificationEvaluator(labelCol="high", metricName="logLoss")

    def search(**params):
        seen.clear()
        booster = models.boosted_classifier("high", maxDepth=4, **params)
        fitted, trials = tuning.cross_validate(prepared, booster, {"maxIter": [1, 3]}, judge, "fold")
        return [r["avg_metric"] for r in trials.orderBy("trial").collect()], fitted.bestModel

    merged, best = search()
    assert max(seen) == 36 and len(seen) == 7
    monkeypatch.setattr(models, "takes_merged_rows", lambda *_: False)
    whole, same = search()
    assert max(seen) == 20_000
    assert merged == pytest.approx(whole, abs=1e-12) and best.getNumTrees == same.getNumTrees
    monkeypatch.undo()
    sampling = models.boosted_classifier("high", subsamplingRate=0.5)
    assert models.takes_merged_rows(models.boosted_classifier("high"))
    assert not models.takes_merged_rows(sampling) and not models.takes_merged_rows(models.baseline_forest("high"))
    assert not models.takes_merged_rows(models.boosted_classifier("high"), ["minInstancesPerNode"])


def test_patient_fit_reads_equal_rows_once(spark, monkeypatch):
    seen = counting(monkeypatch, GBTClassifier)
    rows = hours(spark).withColumn("held_out", F.col("fold") == 2)

    def fit():
        seen.clear()
        booster = models.boosted_classifier("high", stepSize=0.5, maxDepth=4)
        model = models.fit_with_patience(rows, models.pipeline(["hr"], booster, None), "held_out", 3, 8)
        scored = scoring.predict_probability(spark.range(6).select(F.col("id").cast("double").alias("hr")), model)
        return model.stages[-1].getNumTrees, [r["prediction"] for r in scored.orderBy("hr").collect()]

    trees, merged = fit()
    assert max(seen) == 12
    monkeypatch.setattr(models, "takes_merged_rows", lambda *_: False)
    same, whole = fit()
    assert max(seen) > 13_000 and same == trees and merged == pytest.approx(whole, abs=1e-12)
