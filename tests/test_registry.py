from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabloom.operators import models, registry, scoring
from tabloom.operators.registry import ModelRegistry


@pytest.fixture
def store(spark, schema):
    return ModelRegistry(spark, schema)


@pytest.fixture(scope="module")
def trained(spark):
    rows = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") > 20).cast("int").alias("y"))
    model = models.fit(rows, models.pipeline(["x"], models.tree_classifier("y"), None))
    return model, scoring.infer_signature(rows, ["x"]), rows


def _rows(df):
    return {tuple(r) for r in df.collect()}


def test_versions_compare_as_numbers(spark):
    rows = spark.createDataFrame([("m", "9"), ("m", "10"), ("other", "11")], "name string, version string")
    assert tuple(registry.latest_version(rows, "m").first()) == (10, True)
    assert tuple(registry.latest_version(rows, "absent").first()) == (1, False)
    assert _rows(registry.next_versions(rows)) == {("m", 11), ("other", 12)}


def test_alias_moves_and_goes(spark):
    events = spark.createDataFrame(
        [(1, "m", "Champion", 1), (2, "m", "champion", 2), (3, "m", "old", 1), (4, "m", "OLD", None)],
        "seq bigint, name string, alias string, version int",
    )
    assert _rows(registry.current_aliases(events)) == {("m", "champion", 2)}


def test_tags_of_deleted_versions_are_gone(spark):
    tags = spark.createDataFrame(
        [(1, "m", 1, "a", "x"), (2, "m", None, "a", "y"), (6, "m", 1, "b", "z"), (1, "n", 1, "a", "w")],
        registry.SCHEMAS["tags"],
    )
    gone = spark.createDataFrame([(5, "m", 1), (3, "n", None)], registry.SCHEMAS["deletions"])
    assert _rows(registry.live_tags(tags, gone)) == {("m", None, "a", "y"), ("m", 1, "b", "z")}


def test_tags_of_model_and_version(spark):
    events = spark.createDataFrame(
        [(1, "m", None, "task", "a"), (2, "m", 1, "task", "b"), (3, "m", None, "task", "c")],
        "seq bigint, name string, version int, key string, value string",
    )
    assert _rows(registry.current_tags(events)) == {("m", None, "task", "c"), ("m", 1, "task", "b")}


def test_deletion_hides_what_came_before(spark):
    versions = spark.createDataFrame(
        [(1, "m", 1), (2, "m", 2), (9, "m", 3), (3, "n", 1)], "seq bigint, name string, version int"
    )
    deletions = spark.createDataFrame([(4, "m", None), (5, "n", 1), (10, "m", 1)], "seq bigint, name string, version int")
    assert _rows(registry.live_versions(versions, deletions)) == {(9, "m", 3)}


def test_parse_uris(spark):
    uris = ["models:/a.b.m@Champion", "models:/m/Production", "models:/a.b.m/12", "runs:/r1/x/y", "nonsense", "models:/m"]
    got = registry.parse_uris(spark.createDataFrame([(u,) for u in uris], "uri string")).collect()
    assert [(r["kind"], r["name"], r["selector"]) for r in got] == [
        ("alias", "a.b.m", "champion"),
        ("stage", "m", "production"),
        ("version", "a.b.m", "12"),
        ("run", "r1", "x/y"),
        (None, None, None),
        (None, None, None),
    ]


def test_best_and_latest(spark):
    runs = spark.createDataFrame(
        [("a", "n", "p", 1, 0.5), ("b", "n", "p", 2, None), ("c", "n", "q", 3, 0.9), ("d", "o", "p", 1, 0.7)],
        "run_id string, run_name string, parent_run_id string, t int, auc double",
    ).select(
        "run_id", "run_name", "parent_run_id",
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,t)").alias("start_time"),
        F.when(F.col("auc").isNull(), F.expr("map()").cast("map<string,double>"))
        .otherwise(F.create_map(F.lit("auc"), "auc")).alias("metrics"),
    )
    assert registry.best_run(runs, "auc").first()["run_id"] == "c"
    assert registry.best_run(runs, "auc", parent_run_id="p").first()["run_id"] == "d"
    assert [r["run_id"] for r in registry.order_by_metric(runs, "auc").collect()] == ["c", "d", "a", "b"]
    latest = {r["run_name"]: r["run_id"] for r in registry.latest_run_per_name(runs).collect()}
    assert latest == {"n": "c", "o": "d"}
    assert registry.search_runs(runs, "n", "p").count() == 2


def test_life_of_a_model(spark, store, trained):
    model, signature, rows = trained
    name = "cat.models.thing"
    path = store.store_model(model, signature)
    run = store.log_run("first", {"n": 10}, {"auc": 0.8}, {"tree/model": path})
    assert store.latest_run("first") == run
    with pytest.raises(LookupError):
        store.latest_run("absent")
    assert store.register_model(f"runs:/{run}/tree/model", name) == 1
    assert store.register_model(f"runs:/{run}/tree/model", name) == 2
    store.set_alias(name, "Champion", 1)
    store.set_tag(name, "task", "classification")
    store.set_tag(name, "validation_status", "approved", 1)
    store.set_stage(name, 1, "Production")
    assert store.resolve(f"models:/{name}@champion") == path
    assert store.resolve(f"models:/{name}/production") == path
    assert store.latest_version(name) == 2
    assert _rows(store.tags()) == {
        (name, None, "task", "classification"), (name, 1, "validation_status", "approved")
    }
    saved = store.load(f"models:/{name}/2")
    assert saved.signature == signature
    assert scoring.predict(rows, saved.pipeline).count() == 50

    store.delete_version(name, 1)
    for uri in (f"models:/{name}@champion", f"models:/{name}/production", f"models:/{name}/1"):
        with pytest.raises(LookupError):
            store.resolve(uri)
    # The number of a deleted version is not reused ...
    store.delete_version(name, 2)
    assert store.register_model(f"runs:/{run}/tree/model", name) == 3
    # ... until the whole model is gone; deleting twice does no harm.
    store.delete_model(name)
    store.delete_model(name)
    assert store.versions().count() == 0 and store.tags().count() == 0
    assert store.register_model(f"runs:/{run}/tree/model", name) == 1
    with pytest.raises(LookupError):
        store.resolve(f"models:/{name}@champion")


def test_alias_can_be_removed(store, trained):
    model, signature, _ = trained
    run = store.log_run("r", artifacts={"m": store.store_model(model, signature)})
    version = store.register_model(f"runs:/{run}/m", "x")
    store.set_alias("x", "a", version)
    assert store.resolve("models:/x@A")
    store.delete_alias("x", "A")
    with pytest.raises(LookupError):
        store.resolve("models:/x@a")
    with pytest.raises(LookupError):
        store.register_model("runs:/absent/m", "x")


def test_writers_at_the_same_time_get_different_versions(spark, schema):
    from concurrent.futures import ThreadPoolExecutor

    store = ModelRegistry(spark, f"{schema}_race")
    run = store.log_run("r", {}, {}, {"model": "/path"})
    with ThreadPoolExecutor(4) as pool:
        # All of them have seen an empty registry.
        claimed = list(pool.map(lambda _: store._claim_version("m", 1, run), range(8)))
    assert sorted(claimed) == list(range(1, 9))
    assert store.register_model(f"runs:/{run}/model", "m") == 9
    store.delete_model("m")
    assert store.register_model(f"runs:/{run}/model", "m") == 1
