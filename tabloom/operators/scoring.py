"""Applying fitted models to rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.features import apply_lookups, lookups_from_recipe
from tabloom.sources.models import SavedModel

# Widenings of numeric inputs that keep every value exactly.
WIDENINGS = {
    "tinyint": ["smallint", "int", "bigint", "float", "double"],
    "smallint": ["int", "bigint", "float", "double"],
    "int": ["bigint", "double"],
    "float": ["double"],
}


def infer_signature(df: DataFrame, features: Iterable[str]) -> T.StructType:
    """Names and types of the features a model was trained on."""
    return T.StructType([T.StructField(c, df.schema[c].dataType) for c in features])


def infer_output_signature(df: DataFrame, scored: DataFrame) -> T.StructType:
    """Names and types of what scoring adds to ``df``: the model's output."""
    return T.StructType([f for f in scored.schema.fields if f.name not in df.columns])


def check_output(scored: DataFrame, output: T.StructType) -> DataFrame:
    """``scored``, if it has the output columns a model was saved with."""
    for expected in output.fields:
        if expected.name not in scored.columns:
            raise ValueError(f"output lacks column {expected.name}")
        have = scored.schema[expected.name].dataType
        if have != expected.dataType:
            raise ValueError(
                f"output {expected.name} is {have.simpleString()}, "
                f"the model was saved with {expected.dataType.simpleString()}"
            )
    return scored


def check_signature(df: DataFrame, signature: T.StructType) -> DataFrame:
    """Check ``df`` against a model's input schema.

    A missing column or an unsafe type is an error, a narrower number is
    widened, further columns pass through untouched.
    """
    widened = {}
    for expected in signature.fields:
        if expected.name not in df.columns:
            raise ValueError(f"input lacks column {expected.name}")
        have = df.schema[expected.name].dataType.simpleString()
        want = expected.dataType.simpleString()
        if have == want:
            continue
        if want not in WIDENINGS.get(have, []):
            raise ValueError(f"column {expected.name} is {have}, the model expects {want}")
        widened[expected.name] = F.col(expected.name).cast(expected.dataType)
    return df.withColumns(widened) if widened else df


def predict(df: DataFrame, model: PipelineModel, output: str = "prediction") -> DataFrame:
    """Input columns plus the prediction; stage columns are dropped.

    Spark ML stages are JVM expressions, so this adds no shuffle and no Python.
    """
    scored = model.transform(df)
    if output == "prediction":
        return scored.select(*df.columns, "prediction")
    return scored.select(*df.columns, F.col("prediction").alias(output))


def positive_probability(vector: Column | str = "probability") -> Column:
    """Probability of the class 1 out of a classifier's probability vector."""
    return vector_to_array(F.col(vector) if isinstance(vector, str) else vector)[1]


def predict_probability(
    df: DataFrame, model: PipelineModel, output: str = "prediction"
) -> DataFrame:
    scored = model.transform(df)
    return scored.select(*df.columns, positive_probability().alias(output))


def predict_class(
    df: DataFrame, model: PipelineModel, labels: Sequence[str], output: str = "predicted_label"
) -> DataFrame:
    """Predicted class by name; ``labels`` in index order."""
    names = F.array(*(F.lit(name) for name in labels))
    scored = model.transform(df)
    return scored.select(*df.columns, names[F.col("prediction").cast("int")].alias(output))


def python_scorer(
    load: Callable[[], Callable[[pd.DataFrame], pd.Series]],
) -> Callable[[Column], Column]:
    """Column function over a struct of features for a model living in Python.

    ``load`` runs once per task and returns the predictor, which then receives
    whole Arrow batches; use it only where no Spark ML model exists.
    """

    def batches(inputs: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        predictor = load()
        for batch in inputs:
            yield predictor(batch)

    # Set by hand: postponed annotations are strings, which Spark does not resolve here.
    batches.__annotations__ = {"inputs": Iterator[pd.DataFrame], "return": Iterator[pd.Series]}
    return F.pandas_udf(batches, T.DoubleType())


def score_saved(df: DataFrame, saved: SavedModel, output: str = "prediction") -> DataFrame:
    """Score rows that carry only keys and real-time columns.

    The lookups the model was trained with are replayed, the result is checked
    against the model's signature, and the output has the input columns, the
    fetched features and the prediction, whose type is checked if the model was
    saved with one.  Every input row gives one output row.
    """
    enriched = apply_lookups(df, lookups_from_recipe(saved.recipe))
    scored = predict(check_signature(enriched, saved.signature), saved.pipeline)
    scored = check_output(scored, saved.output)
    return scored if output == "prediction" else scored.withColumnRenamed("prediction", output)
