"""Where intermediate results live, and small session facts used by operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A temporary folder is made only when nothing is configured and the session
    is a local one; on a cluster a missing setting is an error, because a
    machine-local folder would vanish with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tabloom-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/tabloom/{label}-{uuid.uuid4().hex}"


@lru_cache(maxsize=1)
def _packed() -> str:
    """This package as a zip file on the driver, kept until the process ends."""
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tabloom-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/{package.name}-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as packed:
        for file in sorted(package.rglob("*.py")):
            packed.write(file, file.relative_to(package.parent))
    return path


# Applications whose executors have the package.
_shipped: set[str] = set()


def with_code(df: DataFrame) -> DataFrame:
    """``df``, for Python functions of this package over its rows.

    Functions and broadcast objects name the modules they come from, so executors on which
    the package is not installed get it from the driver, once an application.
    """
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        context.addPyFile(_packed())
        _shipped.add(context.applicationId)
    return df


# What the current scope has staged; each thread and context has its own scope.
_scope: ContextVar[list[str] | None] = ContextVar("tabloom_staged", default=None)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage so that later jobs see exactly one evaluation, even
    when executors are lost and their shuffle files with them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    if (paths := _scope.get()) is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, key: str, label: str) -> DataFrame:
    """As ``stage``, in files by a hash of ``key``, so that joins on it do not shuffle these rows again."""
    spark = df.sparkSession
    path, table = scratch_path(spark, label), f"tabloom_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = df.repartition(parts, key).write.bucketBy(parts, key).option("path", path).option("compression", "zstd")
    files.saveAsTable(table)
    if (paths := _scope.get()) is not None:
        paths.append(path)
    rows = spark.table(table)
    # The files stay, and the frame knows how they are laid out.
    spark.sql(f"DROP TABLE {table}")
    return rows


@contextmanager
def noting(paths: list[str]) -> Iterator[None]:
    """Add the path of everything staged inside to ``paths``, for a later ``discard``."""
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged data; frames that read it must have been written out."""
    for path in paths:
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
    paths.clear()


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what operators staged inside; write results out before."""
    paths: list[str] = []
    try:
        with noting(paths):
            yield
    finally:
        discard(spark, paths)


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame in memory, spilling to disk, while several jobs read it."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


# Training rows are dealt into parts of about this much input, and into this many at least.
_PART_BYTES = 128 << 20
_LEAST_PARTS = 16

# So many rows equal in all columns stay together at most.
_EQUAL_ROWS = 100_000


@contextmanager
def iterated(df: DataFrame) -> Iterator[DataFrame]:
    """A frame that an iterative fit is about to read many times.

    Row sampling in a fit goes by a row's partition and place in it.  Both follow
    from the row itself here (a hash of all columns), and the number of partitions
    from the size of the input, so that neither the cores nor the way the rows
    were laid out changes the model.  Equal rows are counted, combined before the
    shuffle, dealt in chunks of their count and repeated where they end up, so that
    many of them neither travel nor crowd a part.  Parts are kept, on disk beyond memory.
    """
    parts = max(_LEAST_PARTS, -(-input_bytes(df) // _PART_BYTES))
    columns = df.columns
    last_chunk = F.floor((F.col("__n") - 1) / _EQUAL_ROWS)
    dealt = (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*columns, "__n", F.explode(F.sequence(F.lit(0), last_chunk)).alias("__chunk"))
        .withColumn("__place", F.xxhash64(*columns, "__chunk"))
        .repartition(parts, "__place")
        .sortWithinPartitions("__place")
    )
    size = F.least(F.lit(_EQUAL_ROWS), F.col("__n") - F.col("__chunk") * _EQUAL_ROWS).cast("int")
    rows = dealt.select(*columns, F.explode(F.sequence(F.lit(1), size)).alias("__i"))
    with cached(rows.select(*columns)) as kept:
        yield kept


@contextmanager
def merged(df: DataFrame, weight: str) -> Iterator[DataFrame]:
    """Rows equal in all columns as one row with their number in ``weight``, kept in memory.

    For fits that take weights and sample no rows.  Partitions follow from the number of
    different rows, so that a fit of many short jobs over few of them has few tasks.
    """
    with cached(df.groupBy(*df.columns).agg(F.count(F.lit(1)).cast("double").alias(weight))) as rows:
        yield rows.coalesce(max(1, -(-rows.count() // _EQUAL_ROWS)))


def scale_settings(input_bytes: int, task_bytes: int = 128 << 20) -> dict[str, str]:
    """Session settings for an input of a given size.

    Shuffles start with about ``task_bytes`` of input per partition and adaptive
    execution merges what turns out smaller; skewed partitions are split.
    """
    partitions = max(8, -(-input_bytes // task_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes),
    }


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate for ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# What Spark assumes of a frame whose size it does not know, such as one made from Python rows.
_UNKNOWN_BYTES = 1 << 62


def input_bytes(df: DataFrame) -> int:
    """Size of everything ``df`` reads; unlike ``plan_bytes`` not inflated by joins.

    An input of unknown size counts as one split for each shuffle partition of the session.
    """
    unknown = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * _PART_BYTES
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        size = int(str(leaves.next().stats().sizeInBytes()))
        total += size if size < _UNKNOWN_BYTES else unknown
    return total


def broadcast_limit(spark: SparkSession) -> int:
    """Size in bytes up to which Spark itself chooses a broadcast join."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
