"""Saved models: the fitted pipeline, its input schema and its lookup recipe."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class SavedModel:
    """A fitted pipeline together with what is needed to score with it."""

    pipeline: PipelineModel
    signature: T.StructType
    recipe: list[dict] = field(default_factory=list)
    output: T.StructType = field(default_factory=T.StructType)


def save_model(
    model: MLWritable,
    path: str,
    signature: T.StructType,
    recipe: list[dict] | None = None,
    spark: SparkSession | None = None,
    output: T.StructType | None = None,
) -> None:
    """Write a fitted pipeline (or a single fitted stage) below ``path``.

    ``signature`` and ``output`` are the schemas of its inputs and its predictions.
    """
    spark = spark or SparkSession.getActiveSession()
    if not isinstance(model, PipelineModel):
        model = PipelineModel([model])
    model.write().overwrite().save(f"{path}/model")
    meta = {
        "signature": signature.jsonValue(),
        "recipe": recipe or [],
        "output": (output or T.StructType()).jsonValue(),
    }
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> SavedModel:
    meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
    return SavedModel(
        pipeline=PipelineModel.load(f"{path}/model"),
        signature=T.StructType.fromJson(meta["signature"]),
        recipe=meta["recipe"],
        output=T.StructType.fromJson(meta["output"]),
    )
