"""Feature stages between columns and a model's feature vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    IndexToString,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
    VectorIndexerModel,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assembler(
    features: Sequence[str], output: str = "rawFeatures", handle_invalid: str = "keep"
) -> VectorAssembler:
    """Columns to one vector.  ``keep`` turns nulls into NaN, ``error`` refuses them."""
    return VectorAssembler(
        inputCols=list(features), outputCol=output, handleInvalid=handle_invalid
    )


def category_indexer(
    max_categories: int = 4,
    input: str = "rawFeatures",
    output: str = "features",
    handle_invalid: str = "keep",
) -> VectorIndexer:
    """Re-index vector slots with few distinct values as categories."""
    return VectorIndexer(
        inputCol=input, outputCol=output, maxCategories=max_categories,
        handleInvalid=handle_invalid,
    )


def label_indexer(
    label: str, output: str = "label_index", handle_invalid: str = "error"
) -> StringIndexer:
    """Text classes to 0, 1, ... in alphabetical order."""
    return StringIndexer(
        inputCol=label, outputCol=output, stringOrderType="alphabetAsc",
        handleInvalid=handle_invalid,
    )


def label_decoder(
    indexer: StringIndexerModel, input: str = "prediction", output: str = "predicted_label"
) -> IndexToString:
    return IndexToString(inputCol=input, outputCol=output, labels=list(indexer.labels))


def category_map(
    df: DataFrame, model: VectorIndexerModel, features: Sequence[str]
) -> DataFrame:
    """The fitted indexer's map as rows: feature, original value, category index."""
    rows = [
        (features[int(slot)], float(value), int(index))
        for slot, values in model.categoryMaps.items()
        for value, index in values.items()
    ]
    return df.sparkSession.createDataFrame(
        rows, "feature string, original_value double, category_index int"
    )


def crossed(df: DataFrame, columns: Sequence[str], output: str) -> DataFrame:
    """One text category out of several columns, for ``label_indexer`` to index."""
    return df.withColumn(output, F.concat_ws("_x_", *(F.col(c).cast("string") for c in columns)))
