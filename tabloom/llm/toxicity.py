"""Toxicity of whole texts by a recurrent network that is trained here.

The network (``gru.py``) reads overlapping windows of words; a text's score is
that of its most toxic window, and every window of every text is scored.  It is
trained on a bounded sample: up to ``TOXIC_TEXTS`` and ``CLEAN_TEXTS`` labelled
rows with a text, first by a hash of their key.  Texts up to ``TRAINING_CHARS`` long come before
longer ones, which fill up where there are too few, as long as a class stays within
that many characters a text.  These bounds hold for the fit alone.

Null and empty texts get the score of an empty window.  Repeated rows score
alike.  Keys labelled more than once count as toxic if one label says so.  Without labels of both
kinds the score is the share of toxic labels (0 if there is none).  Text is
read per row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm import gru
from tabloom.llm.base import free_name, load, query
from tabloom.session import with_code

TOXIC_TEXTS = 600
CLEAN_TEXTS = 2400
TRAINING_CHARS = 6000
FOLDS = 5
ROWS_AT_ONCE = 512


def held_out(key):
    """Rows never trained on: crc32 of the key as text is divisible by five."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS == 0, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> list:
    """At most ``TOXIC_TEXTS + CLEAN_TEXTS`` rows of (text, label), in a fixed order."""
    known = (
        labels.where(F.col(label).isin(0, 1) & ~held_out(key))
        .groupBy(F.col(key).alias("k"))
        .agg(F.max(label).cast("int").alias("y"))
        .withColumn("h", F.xxhash64(F.col("k").cast("string")))
    )
    # A key that stands for many rows gives one text, a shortest one.
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t IS NOT NULL")
    sizes = texts.groupBy("k").agg(F.min(F.char_length("t")).alias("chars"))
    sized = known.join(sizes, "k").withColumn("long", F.col("chars") > TRAINING_CHARS)
    keys = []
    for y, n in ((1, TOXIC_TEXTS), (0, CLEAN_TEXTS)):
        room = n * TRAINING_CHARS
        for r in sized.where(F.col("y") == y).orderBy("long", "h", "k").limit(n).collect():
            if r["chars"] <= room:
                room -= r["chars"]
                keys.append((r["k"], r["y"], r["h"], r["chars"]))
    if not keys:
        return []
    kind = docs.schema[key].dataType.simpleString()
    # At most TOXIC_TEXTS + CLEAN_TEXTS keys, so they may be broadcast.
    chosen = F.broadcast(docs.sparkSession.createDataFrame(keys, f"k {kind}, y int, h long, chars int"))
    found = texts.join(chosen, "k").where(F.char_length("t") == F.col("chars"))
    found = found.groupBy("k", "h", "y").agg(F.min("t").alias("t"))
    return [(r["t"], r["y"]) for r in found.orderBy("h", "k").collect()]


def train_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> gru.Net | float:
    """The fitted network, or the share of toxic labels where a class is missing."""
    sample = training_sample(docs, labels, key, text, label)
    toxic = sum(y for _, y in sample)
    if not 0 < toxic < len(sample):
        return toxic / len(sample) if sample else 0.0
    return gru.train([t for t, _ in sample], [y for _, y in sample])


def score_toxicity(
    docs: DataFrame, model: gru.Net | float, text: str = "text", out: str = "score"
) -> DataFrame:
    """The input with the toxicity of each whole text added as ``out`` (with an underscore if it is taken)."""
    names = docs.columns
    out = free_name(names, out)
    at = [c.lower() for c in names].index(text.lower())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(k, ROWS_AT_ONCE)
                if isinstance(model, float):
                    values = np.full(part.num_rows, model)
                else:
                    values = model.score(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(values, pa.float64())], names=[*names, out]
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return with_code(docs).mapInArrow(score, f"{schema}, `{out}` double")


def drop_toxic(docs: DataFrame, labels: DataFrame, cut: float = 0.5) -> DataFrame:
    """Rows whose text scores below ``cut``; the columns stay as they are."""
    name = free_name(docs.columns, "toxicity")
    scored = score_toxicity(docs, train_toxicity(docs, labels), out=name)
    return scored.where(F.col(name) < cut).drop(name)


@query("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, load(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
