"""Whole jobs on the small tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabloom.operators import features, profiling
from tabloom.operators.features import FeatureLookup
from tabloom.operators.registry import ModelRegistry
from tabloom.operators.tuning import LogUniform, QUniform
from tabloom.plans import classes, demand, feature_scoring, quality
from tabloom.queries.base import TEXT_FEATURES, hourly, text_shape


@pytest.fixture
def registry(spark, schema):
    return ModelRegistry(spark, schema)


def test_demand(spark, sf_dir):
    hours = hourly(spark, sf_dir)
    # A signal by hour, as the test events have none.
    hours = hours.withColumn("cnt", F.col("cnt") + 10 * F.abs(F.col("hr") - 12))
    result = demand.forecast_demand(
        hours, "instant", "cnt", ["dteday", "casual", "registered"],
        grid={"maxDepth": [1, 4], "maxIter": [5]},
    )
    trials = result.trials.collect()
    best = min(trials, key=lambda r: r["avg_metric"])
    assert best["params"]["maxDepth"] == "4"
    assert result.model.stages[-1].getOrDefault("maxDepth") == 4
    assert abs(result.metrics["mean_residual"]) < 0.05 * result.metrics["mean_label"]
    assert result.metrics["r2"] > 0.9
    assert result.residuals.count() == 24
    assert set(result.predictions.columns) >= {"cnt", "prediction", "residual"}


def test_feature_scoring(spark, sf_dir, schema, registry):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    table = f"{schema}.parts"
    features.create_feature_table(spark, table, "p_partkey", part.select("p_partkey", "p_size", "p_retailprice"))
    labelled = part.select("p_partkey", (F.col("p_size") * 2.0 + F.col("p_partkey") % 3).alias("score"))
    labelled = labelled.withColumn("live", F.col("p_partkey") % 3)
    trained = feature_scoring.train_on_lookups(
        registry, labelled, [FeatureLookup(table, "p_partkey")], "score", ["p_partkey"], "m.parts"
    )
    assert trained.version == 1 and trained.metrics["test_r2_score"] > 0.8
    scored = feature_scoring.score_latest(registry, "m.parts", labelled.drop("score"))
    assert scored.columns == ["p_partkey", "live", "p_size", "p_retailprice", "prediction"]
    assert scored.count() == part.count()
    assert scored.where("prediction is null").isEmpty()
    # A second version of the model uses the table as updated.
    features.write_feature_table(spark, table, part.select("p_partkey", (F.col("p_size") + 1).alias("p_size"), "p_retailprice"))
    again = feature_scoring.train_on_lookups(
        registry, labelled, [FeatureLookup(table, "p_partkey")], "score", ["p_partkey"], "m.parts"
    )
    assert again.version == 2 and registry.latest_version("m.parts") == 2


def test_quality(spark, registry):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", (F.col("quality") * 7).alias("quality"))
    rows = docs.select("doc_id", "lang").join(text_shape(docs), "doc_id").join(labels, "doc_id").persist()
    english, others = rows.where("lang = 'en'").drop("lang"), rows.where("lang <> 'en'").drop("lang")
    data = quality.prepare(english, others, "is en", "quality", 7)
    assert "is_en" in data.columns
    profile = quality.profile(data, TEXT_FEATURES, "quality")
    assert profile.boxes.count() == 2 * len(TEXT_FEATURES)
    assert not any(r["has_missing"] for r in profile.missing.collect())

    used = [*TEXT_FEATURES, "is_en"]
    split = quality.split_rows(data, ["doc_id"]).persist()
    test = split.where("split = 'test'")
    version, area = quality.train_baseline(registry, split, used, "quality", "q")
    assert version == 1 and area > 0.8
    assert quality.champion_auc(registry, "q", test, "quality") == pytest.approx(area)

    space = {
        "max_depth": QUniform(2, 4), "learning_rate": LogUniform(-2, 0),
        "min_child_weight": LogUniform(-1, 1), "reg_alpha": LogUniform(-5, -1),
        "seed": quality.tuning.Constant(123),
    }
    parent = quality.tune(registry, split, used, "quality", max_evals=3, rounds=4, space=space)
    children = registry.table("runs").where(F.col("parent_run_id") == parent)
    assert children.count() == 3
    best = children.agg(F.max(F.col("metrics")["auc"])).first()[0]
    second = quality.promote_best(registry, parent, "q", replaces=version)
    assert second == 2 and best > 0.8
    assert 0.5 < quality.champion_auc(registry, "q", test, "quality") <= 1
    assert registry.resolve("models:/q/production") == registry.resolve("models:/q@champion")
    assert registry.resolve("models:/q/archived") == registry.resolve("models:/q/1")
    batch = split.where("split = 'train'").drop("quality", "split")
    scored = quality.score_table(registry, "q", batch)
    assert scored.count() == batch.count()
    assert scored.where("prediction < 0 or prediction > 1 or prediction is null").isEmpty()
    assert quality.trial_correlations(registry, parent).where("param = 'reg_alpha'").count() == 1


def test_classes(spark, registry):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    n = F.greatest(F.length("text"), F.lit(1))
    letters = {"french": "[éèêàç]", "german": "[äöüß]", "spanish": "[ñóáíú]"}
    rows = docs.select(
        "doc_id", "lang", *((F.regexp_count("text", F.lit(p)) / n).alias(c) for c, p in letters.items())
    ).persist()
    candidates = classes.standard_candidates()
    candidates[1].estimator.setNumTrees(10)
    results = classes.train_candidates(registry, rows, ["doc_id"], list(letters), "lang", "langs", candidates)
    assert sorted(results) == [1, 2] and min(results.values()) > 0.9
    test = classes.splits.hash_split(rows, ["doc_id"], {"train": 0.5, "test": 0.5}, 42).where("split = 'test'")
    assert classes.champion_accuracy(registry, "langs", test, "lang") == pytest.approx(results[2])
    assert registry.resolve("models:/langs@Archived") == registry.resolve("models:/langs/1")
    means = profiling.group_mean(rows, "lang", "french", "m").collect()
    assert max(means, key=lambda r: r["m"])["lang"] == "fr"
