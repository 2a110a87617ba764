from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabloom.operators import features, models, scoring
from tabloom.operators.features import FeatureLookup
from tabloom.operators.joins import crowded_keys, lookup_join
from tabloom.session import scratch_path
from tabloom.sources.models import load_model, save_model


def _rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.fixture
def items(spark, schema):
    name = f"{schema}.items"
    rows = spark.range(10).select(
        F.col("id").alias("item_id"), (F.col("id") * 1.5).alias("size"), F.lit("s").alias("kind")
    )
    features.create_feature_table(spark, name, "item_id", rows, description="it's items")
    return name


def test_spec_is_kept_with_the_table(spark, items):
    spec = features.feature_table_spec(spark, items)
    assert spec.primary_keys == ("item_id",) and spec.description == "it's items"
    assert spark.read.table(items).count() == 10


def test_bad_keys_are_refused(spark, schema):
    twice = spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    null = spark.createDataFrame([(None, 2)], "k int, v int")
    for rows in (twice, null):
        with pytest.raises(ValueError, match="null or repeated"):
            features.create_feature_table(spark, f"{schema}.bad", "k", rows)
        assert features.key_violations(rows, ["k"]).count() == 1
        assert not spark.catalog.tableExists(f"{schema}.bad")
    with pytest.raises(ValueError, match="lacks"):
        features.create_feature_table(spark, f"{schema}.bad", "nokey", twice)


def test_table_cannot_be_created_twice(spark, items):
    with pytest.raises(ValueError, match="exists"):
        features.create_feature_table(spark, items, "item_id", spark.range(1).toDF("item_id"))


def test_upsert_layers_then_compacts(spark, items):
    before = features.feature_table_spec(spark, items)
    change = spark.createDataFrame([(3, 99.0, "new"), (50, 1.0, "new")], "item_id bigint, size double, kind string")
    # A huge share keeps the changes apart; zero folds them in.
    layered = features.write_feature_table(spark, items, change, compact_share=1e9)
    assert layered.base == before.base and layered.changes
    again = spark.createDataFrame([(50, 2.0, "newer")], "item_id bigint, size double, kind string")
    layered = features.write_feature_table(spark, items, again, compact_share=1e9)
    got = {r["item_id"]: (r["size"], r["kind"]) for r in spark.read.table(items).collect()}
    assert len(got) == 11
    assert got[3] == (99.0, "new") and got[50] == (2.0, "newer") and got[4] == (6.0, "s")
    compacted = features.write_feature_table(spark, items, again, compact_share=0)
    assert not compacted.changes and compacted.base != before.base
    assert {r["item_id"]: (r["size"], r["kind"]) for r in spark.read.table(items).collect()} == got
    features.drop_superseded(spark, layered)
    assert spark.read.table(items).count() == 11
    assert len(layered.changes) == 2
    assert not any(spark.catalog.tableExists(layer) for layer in layered.changes)


def test_an_upsert_writes_its_own_rows_only(spark, items):
    columns = "item_id bigint, size double, kind string"
    want = {r["item_id"]: r["kind"] for r in spark.read.table(items).collect()}
    for i, keys in enumerate([(1, 2, 100), (2, 3), (100, 200)]):
        change = spark.createDataFrame([(k, 0.0, f"layer {i}") for k in keys], columns)
        spec = features.write_feature_table(spark, items, change, compact_share=1e9)
        want |= {k: f"layer {i}" for k in keys}
        assert spark.read.table(spec.changes[-1]).count() == len(keys) and len(spec.changes) == i + 1
        assert {r["item_id"]: r["kind"] for r in spark.read.table(items).collect()} == want
    for _ in range(features.MOST_LAYERS - 2):
        spec = features.write_feature_table(spark, items, change, compact_share=1e9)
    assert spec.changes == ()
    assert {r["item_id"]: r["kind"] for r in spark.read.table(items).collect()} == want


def test_of_two_writers_one_is_refused(spark, items):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    columns, ready = "item_id bigint, size double, kind string", Barrier(4)
    before = features.feature_table_spec(spark, items)
    real = features._store

    def slow(*args, **kwargs):  # all have read the same state before any of them commits
        stored = real(*args, **kwargs)
        ready.wait(60)
        return stored

    def write(i):
        try:
            features.write_feature_table(spark, items, spark.createDataFrame([(i, -1.0, "race")], columns), compact_share=1e9)
            return i
        except RuntimeError as e:
            assert "meanwhile" in str(e)

    features._store = slow
    try:
        with ThreadPoolExecutor(4) as pool:
            done = [i for i in pool.map(write, range(4)) if i is not None]
    finally:
        features._store = real
    assert len(done) == 1
    assert [r["item_id"] for r in spark.read.table(items).where("kind = 'race'").collect()] == done
    assert features.feature_table_spec(spark, items).version == before.version + 1
    # Nothing stands in the way of the next writer.
    for i in range(4):
        features.write_feature_table(spark, items, spark.createDataFrame([(i, -1.0, "race")], columns), compact_share=1e9)
    assert spark.read.table(items).where("kind = 'race'").count() == 4


def test_a_commit_whose_writer_died_is_not_lost(spark, items, monkeypatch):
    columns = "item_id bigint, size double, kind string"
    with monkeypatch.context() as m:
        m.setattr(features, "_show", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            features.write_feature_table(spark, items, spark.createDataFrame([(1, -1.0, "first")], columns), compact_share=1e9)
    features.write_feature_table(spark, items, spark.createDataFrame([(2, -1.0, "second")], columns), compact_share=1e9)
    kinds = {r["item_id"]: r["kind"] for r in spark.read.table(items).collect()}
    assert (kinds[1], kinds[2], len(kinds)) == ("first", "second", 10)


def test_readers_keep_the_rows_they_started_with(spark, items):
    earlier = spark.read.table(items)
    features.write_feature_table(spark, items, earlier.limit(1), mode="overwrite")
    assert spark.read.table(items).count() == 1
    assert earlier.count() == 10


def test_upsert_edges(spark, items):
    columns = "item_id bigint, size double, kind string"
    twice = spark.createDataFrame([(1, 1.0, "a"), (1, 2.0, "b")], columns)
    with pytest.raises(ValueError, match="null or repeated"):
        features.write_feature_table(spark, items, twice)
    with pytest.raises(ValueError, match="differ"):
        features.write_feature_table(spark, items, spark.range(1).toDF("item_id"))
    before = _rows(spark.read.table(items))
    features.write_feature_table(spark, items, spark.createDataFrame([], columns))
    assert _rows(spark.read.table(items)) == before


def test_empty_table_is_filled_later(spark, schema):
    rows = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, v double")
    name = f"{schema}.later"
    features.create_feature_table(spark, name, ["a", "b"], schema=rows.schema, buckets=4)
    assert spark.read.table(name).count() == 0
    features.write_feature_table(spark, name, rows)
    assert _rows(spark.read.table(name)) == _rows(rows)
    with pytest.raises(ValueError, match="rows or a schema"):
        features.create_feature_table(spark, f"{schema}.none", "a")


def test_bucketed_lookup_shuffles_one_side_only(spark, schema):
    name = f"{schema}.bucketed"
    features.create_feature_table(spark, name, "k", spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v")), buckets=4)
    labelled = spark.range(1000).select((F.col("id") % 100).alias("k"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = features.apply_lookups(labelled, [FeatureLookup(name)])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_layers_are_read_without_a_shuffle(spark, schema):
    name = f"{schema}.layered"
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    features.create_feature_table(spark, name, "k", rows, buckets=4)
    changes = rows.limit(5).withColumn("v", F.lit(2))
    features.write_feature_table(spark, name, changes, compact_share=1e9)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = spark.read.table(name)
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in plan and "Exchange" not in plan
        assert {r["v"]: r["count"] for r in table.groupBy("v").count().collect()} == {1: 95, 2: 5}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lookup_keeps_unmatched_rows_and_selects(spark, items):
    labelled = spark.createDataFrame([(1, 0), (77, 1), (None, 1)], "item_id bigint, y int")
    full = features.create_training_set(labelled, [FeatureLookup(items, "item_id")], "y", "item_id")
    assert full.load_df().columns == ["y", "size", "kind"]
    assert full.feature_names == ["size", "kind"]
    assert _rows(full.load_df()) == sorted(map(repr, [(0, 1.5, "s"), (1, None, None), (1, None, None)]))
    one = features.create_training_set(labelled, [FeatureLookup(items, "item_id", ("size",))], "y")
    assert one.load_df().columns == ["item_id", "y", "size"]
    with pytest.raises(ValueError, match="no label"):
        features.create_training_set(labelled, [], "absent")


def test_clashing_features_are_refused(spark, items):
    labelled = spark.createDataFrame([(1, 0.0)], "item_id bigint, size double")
    with pytest.raises(ValueError, match="already"):
        features.apply_lookups(labelled, [FeatureLookup(items)])
    with pytest.raises(ValueError, match="keys"):
        features.apply_lookups(labelled, [FeatureLookup(items, ("item_id", "size"))])


def test_crowded_keys_are_salted(spark):
    # A third of the rows share one key, another third has no key at all.
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id"))
    left = spark.range(9000).select(F.col("id").alias("row"), key.alias("k"))
    right = spark.range(0, 9000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    right = right.unionByName(spark.createDataFrame([(7, 14)], "k bigint, v bigint"))
    found = crowded_keys(left, [["k"], ["row"]], 500).collect()
    assert sorted((r["set"], r["n_rows"]) for r in found) == [(0, 3000), (0, 3000)]
    want = _rows(left.join(right, ["k"], "left").select("row", "k", "v"))
    joined = lookup_join(left, right, ["k"], small_bytes=0, rows_per_task=500)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "__salt" in plan and plan.count("Range (0, 9000, step=1") == 1
    assert _rows(joined) == want
    # No key reaches the default bound here, and the plain join gives the same.
    assert _rows(lookup_join(left, right, ["k"], small_bytes=0)) == want


@pytest.mark.parametrize("have", ["int", "bigint", "string", "double"])
@pytest.mark.parametrize("other", ["int", "bigint", "string", "double"])
def test_keys_of_different_types_meet(spark, have, other):
    left = spark.range(300).select(
        F.col("id").alias("row"), (F.col("id") % 3).cast(have).alias("k")
    )
    right = spark.range(2).select(F.col("id").cast(other).alias("k"), (F.col("id") + 10).alias("v"))
    want = _rows(left.join(right, left["k"] == right["k"], "left").select("row", left["k"], "v"))
    for rows_per_task in (20, 1000):
        joined = lookup_join(left, right, ["k"], small_bytes=0, rows_per_task=rows_per_task)
        assert _rows(joined) == want
        assert joined.where("v IS NULL").count() == 100


def test_keys_without_a_common_type_or_repeated_are_refused(spark):
    left = spark.createDataFrame([("x",), ("1",), (None,)], "k string")
    with pytest.raises(ValueError, match="do not compare"):
        lookup_join(left, spark.sql("SELECT DATE'2024-01-01' AS k, 1 AS v"), ["k"])
    twice = spark.createDataFrame([(1, 2), (1, 3), (None, 4), (None, 5)], "k int, v int")
    with pytest.raises(ValueError, match="repeated"):
        lookup_join(left, twice, ["k"])
    # Text that is no number matches nothing; null keys do not count as repeated.
    once = lookup_join(left, twice.where("v <> 3"), ["k"], small_bytes=0, rows_per_task=1)
    assert _rows(once) == sorted(map(repr, [("x", None), ("1", 2), (None, None)]))


@pytest.mark.parametrize(
    "asked,known",
    [
        (("k bigint", [7, 8]), ("k string", ["7", "07", "7.0", " 7", "x"])),
        (("k double", [7.0, 7.5]), ("k string", ["7", "07", "7.5", "7.50"])),
        (("k double", [9007199254740992.0, 3.0]), ("k bigint", [9007199254740992, 9007199254740993, 3])),
        (("k bigint", [9007199254740993, 3]), ("k double", [9007199254740992.0, 3.0, 3.5])),
        (("k float", [16777216.0, 0.5]), ("k int", [16777216, 16777217, 0])),
        (("k string", ["7", "1E10"]), ("k double", [7.0, 1e10])),
    ],
)
def test_keys_that_differ_in_their_own_type_never_multiply_rows(spark, schema, asked, known):
    left = spark.createDataFrame([(v,) for v in asked[1]], asked[0])
    right = spark.createDataFrame([(v, i) for i, v in enumerate(known[1])], f"{known[0]}, v int")
    name = f"{schema}.mixed_keys"
    features.create_feature_table(spark, name, "k", right)
    for small_bytes in (0, None):
        found = features.apply_lookups(left, [features.FeatureLookup(name)], small_bytes=small_bytes)
        assert found.count() == left.count()
        assert _rows(found) == _rows(lookup_join(left, right, ["k"], small_bytes=small_bytes))


def test_zeros_of_both_signs_are_one_key(spark):
    left = spark.createDataFrame([(-0.0,), (0.0,)], "k double")
    right = spark.createDataFrame([(0.0, 5)], "k double, v int")
    joined = lookup_join(left, right, ["k"], small_bytes=0, rows_per_task=1)
    assert [r["v"] for r in joined.collect()] == [5, 5]


def test_labelled_rows_are_read_once_however_many_lookups(spark, schema, sf_dir):
    labelled = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    )
    lookups = []
    for key in ("l_partkey", "l_suppkey", "l_linenumber"):
        name = f"{schema}.by_{key}"
        rows = labelled.groupBy(key).agg(F.count("*").alias(f"n_{key}"))
        features.create_feature_table(spark, name, key, rows)
        lookups.append(FeatureLookup(name))
    joined = features.apply_lookups(labelled, lookups, small_bytes=0, rows_per_task=100)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "l_orderkey" in line]
    assert len(scans) == 1 and "__salt" in plan
    plain = labelled
    for lookup in lookups:
        plain = plain.join(spark.read.table(lookup.table), lookup.table.split("by_")[1], "left")
    assert _rows(joined) == _rows(plain.select(*joined.columns))


def test_scoring_replays_the_recipe(spark, items):
    labelled = spark.range(10).select(
        F.col("id").alias("item_id"), (F.col("id") * 10.0).alias("y"), F.lit(0.5).alias("live")
    )
    training = features.create_training_set(labelled, [FeatureLookup(items, "item_id", ("size",))], "y", "item_id")
    rows = training.load_df()
    used = training.feature_names
    assert used == ["live", "size"]
    model = models.fit(rows, models.pipeline(used, models.tree_regressor("y", maxDepth=10), None))
    path = scratch_path(spark, "model")
    save_model(model, path, scoring.infer_signature(rows, used), training.recipe)
    batch = labelled.drop("y").unionByName(spark.createDataFrame([(123, 0.5)], "item_id bigint, live double"))
    scored = scoring.score_saved(batch, load_model(spark, path))
    assert scored.columns == ["item_id", "live", "size", "prediction"]
    got = {r["item_id"]: r["prediction"] for r in scored.collect()}
    assert len(got) == 11 and got[4] == 40.0 and got[123] is not None


def test_upsert_over_a_moved_table_is_refused(spark, items, monkeypatch):
    changed = spark.read.table(items).where("item_id = 1").withColumn("size", F.lit(7.0))
    other = spark.read.table(items).where("item_id = 2").withColumn("size", F.lit(8.0))
    store, names = features._store, []

    def store_slowly(spark, spec, df, check=True):
        stored = store(spark, spec, df, check)
        names.append(stored)
        if len(names) == 1:
            features.write_feature_table(spark, items, other, compact_share=1e9)
        return stored

    monkeypatch.setattr(features, "_store", store_slowly)
    with pytest.raises(RuntimeError, match="another job"):
        features.write_feature_table(spark, items, changed, compact_share=1e9)
    assert not spark.catalog.tableExists(names[0])
    got = {r["item_id"]: r["size"] for r in spark.read.table(items).collect()}
    assert got[1] == 1.5 and got[2] == 8.0
