"""Queries on executors that know nothing of this repository, as a cluster's do."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path

import pyspark

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RUN = """
import datetime, json, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.config(map={{
    "spark.master": "local-cluster[1,1,1024]", "spark.executor.memory": "700m", "spark.ui.enabled": "false",
    "spark.driver.host": "127.0.0.1", "spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": "2",
    "spark.checkpoint.dir": "file://{work}/shared", "spark.sql.warehouse.dir": "{work}/warehouse",
}}).getOrCreate()
from tabloom.queries import all_queries
at = lambda i: datetime.datetime(2024, 1, 1, i % 24)
rows = [(i, at(i) if i % 50 else None, float(i % 97)) for i in range(2000)]
spark.createDataFrame(rows, "event_id long, ts timestamp, value double").write.parquet("{work}/events.parquet")
found = {{name: [r.asDict() for r in all_queries()[name](spark, "{work}").collect()]
         for name in ("boosted_regularized_rounds", "boosted_search_one_scan")}}
print("FOUND" + json.dumps(found))
"""


def test_boosting_takes_its_code_along(tmp_path):
    os.makedirs(tmp_path / "shared")
    # Workers write to a folder in Spark's home, and end the session if they cannot, as where Spark is installed read-only.
    os.makedirs(tmp_path / "home/work")
    for part in Path(pyspark.__file__).parent.iterdir():
        if part.name != "work":
            (tmp_path / "home" / part.name).symlink_to(part)
    plain = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")} | {"SPARK_HOME": f"{tmp_path}/home"}
    plain["PYTHONPATH"] = os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and not p.startswith(ROOT))
    done = subprocess.run(
        [sys.executable, "-c", RUN.format(root=ROOT, work=tmp_path)],
        cwd=tmp_path, env=plain, capture_output=True, text=True, timeout=300,
    )
    assert "FOUND" in done.stdout, done.stderr[-3000:]
    found = json.loads(done.stdout.rpartition("FOUND")[2])
    # Eight parts of the day and the rows without a time, under four settings.
    assert len(found["boosted_regularized_rounds"]) == 36
    assert all(0 < r["prediction"] < 1 for r in found["boosted_regularized_rounds"])
    assert [r["trial"] for r in sorted(found["boosted_search_one_scan"], key=lambda r: r["trial"])] == [0, 1, 2, 3]
