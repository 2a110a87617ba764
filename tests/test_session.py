from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tabloom import session
from tabloom.operators.ordering import dense_row_id


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    found = session.shared_dir(spark)
    assert found == session.shared_dir(spark)
    if configured:
        assert found == configured.rstrip("/")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_staged_rows_are_read_once_and_dropped(spark):
    rows = spark.range(100).withColumn("r", F.rand())
    with session.staging(spark):
        staged = session.stage(rows, "test")
        assert sorted(staged.collect()) == sorted(staged.collect())
        path = staged.inputFiles()[0].removeprefix("file:")
        assert os.path.exists(path)
        assert dense_row_id(rows, "rid", ["id"]).count() == 100
    assert not os.path.exists(path)


def test_sizes(spark):
    small, big = spark.range(10), spark.range(10_000_000)
    assert session.plan_bytes(small) < session.plan_bytes(big)
    joined = big.join(big.withColumnRenamed("id", "id2"), F.col("id") == F.col("id2"))
    assert session.input_bytes(joined) == 2 * session.plan_bytes(big)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for text, want in (("10MB", 10 << 20), ("5k", 5 << 10), ("-1", -1), ("123b", 123)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert session.broadcast_limit(spark) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_settings_follow_the_input():
    small, large = session.scale_settings(1 << 20), session.scale_settings(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert large["spark.sql.shuffle.partitions"] == "819200"


def test_training_rows_have_one_layout(spark, monkeypatch):
    rows = spark.range(1000).selectExpr("id % 300 AS a", "IF(id % 3 = 0, 1.0, id) AS b")
    same = spark.range(400).selectExpr("7L AS a", "0.5D AS b")
    rows = rows.unionByName(same)
    monkeypatch.setattr(session, "_EQUAL_ROWS", 90)

    def layout(df):
        with session.iterated(df) as kept:
            assert kept.is_cached
            return kept.select("*", F.spark_partition_id().alias("part")).collect()

    one, other = layout(rows.repartition(2)), layout(rows.repartition(7))
    assert one == other
    assert sorted((r["a"], r["b"]) for r in one) == sorted(tuple(r) for r in rows.collect())
    # 400 equal rows in five chunks do not all meet.
    assert len({r["part"] for r in one if (r["a"], r["b"]) == (7, 0.5)}) > 1
    assert layout(rows.limit(0)) == []


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://elsewhere:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
