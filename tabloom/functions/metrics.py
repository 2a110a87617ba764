"""Model metrics as aggregate expressions over a label and a score column.

They are ordinary aggregates, so one pass scores every split and every model:
``df.groupBy("split", "model").agg(rmse("y", "p"), r2("y", "p"))``.  The
exception is the AUC, which needs the scores in order (see
``tabloom.operators.evaluation``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _num(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def _squared_error(label: Column | str, prediction: Column | str) -> Column:
    error = _num(label) - _num(prediction)
    return error * error


def mean_of(col: Column | str) -> Column:
    return F.avg(_num(col))


def mse(label: Column | str, prediction: Column | str) -> Column:
    return F.avg(_squared_error(label, prediction))


def rmse(label: Column | str, prediction: Column | str) -> Column:
    return F.sqrt(mse(label, prediction))


def r2(label: Column | str, prediction: Column | str) -> Column:
    """1 - SSE/SST over rows where both values are known; null for a constant label."""
    error = _squared_error(label, prediction)
    known = F.when(error.isNotNull(), _num(label))
    return F.lit(1.0) - F.try_divide(F.sum(error), F.var_pop(known) * F.count(known))


def accuracy(label: Column | str, prediction: Column | str) -> Column:
    """Share of rows where prediction equals label (any comparable type)."""
    label = F.col(label) if isinstance(label, str) else label
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.avg((label == prediction).cast("double"))


def logloss(label: Column | str, probability: Column | str, eps: float = 1e-15) -> Column:
    """Mean negative log likelihood of a 0/1 label, probabilities clipped to [eps, 1-eps]."""
    p = F.greatest(F.lit(eps), F.least(F.lit(1.0 - eps), _num(probability)))
    y = _num(label)
    return -F.avg(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
