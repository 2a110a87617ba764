"""Five stages from raw documents to training shards; each stage's result is written and reread.

Toxic documents go, one document of each group of near copies stays, documents
with benchmark passages go, sources are mixed to target weights (repeating
documents, dropping none), and the rest is packed into shards.  The last stage
adds ``shard`` and ``slot`` to the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm.base import load
from tabloom.llm.decontamination import drop_contaminated
from tabloom.llm.mixing import mixed_documents
from tabloom.llm.near_dedup import drop_near_duplicates
from tabloom.llm.sharding import shard_documents
from tabloom.llm.toxicity import drop_toxic
from tabloom.session import discard, noting, scratch_path, staging

_intermediate: list[str] = []


def _freeing(step: Callable) -> Callable:
    """A stage that first deletes what the stage called before it left in the shared folder.

    Callers of ``STAGES`` write each result before they ask for the next one, so
    nothing reads from there any more.  ``run`` keeps a list of its own for each stage
    instead, so runs side by side leave each other's data alone.
    """

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _intermediate)
        with noting(_intermediate):
            return step(spark, docs, sf_dir)

    return run_step


@_freeing
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, load(spark, sf_dir, "labels"))


@_freeing
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


@_freeing
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


@_freeing
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


@_freeing
def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# A trained network and packing into bins are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    written = None
    for name, step in STAGES:
        path = scratch_path(spark, name)
        with staging(spark):
            step.__wrapped__(spark, docs, sf_dir).write.parquet(path)
        if written:
            discard(spark, [written])
        docs, written = spark.read.parquet(path), path
    return docs
