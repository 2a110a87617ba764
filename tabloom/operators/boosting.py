"""Regularised second-order boosting: many fits at once, one scan a level.

A fit grows trees on the gradients and second derivatives of its loss.  A leaf with sums G
and H has the weight -soft(G, alpha) / (H + lambda), where ``soft`` draws G towards 0 by
``reg_alpha``; a split is worth what it adds to soft(G, alpha)**2 / (H + lambda), summed over
its two sides.  Both sides need ``min_child_weight`` of H.  Missing values go to the side
that gains more.

All fits, of every trial and fold, grow side by side: a pass over the binned rows adds up G
and H by (fit, node, feature, bin) for the level that each fit has come to, Spark merges the
tasks' sums and finds the best split of each node, and the driver gets one row a node.
So the number of scans follows from the longest fit and not from the number of fits.  Margins
of all fits travel with the rows: they are written out every ``KEEP_TREES`` trees, in between
the latest trees are walked.  The first pass of a round also measures the loss on each fit's
held-out rows, so patience takes no further fit: trees after the best round are cut.

Gradients are added as whole multiples of a small power of two, so sums and models do not
depend on the order of rows, on cores or on lost tasks.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.session import discard, noting, stage, with_code

KEEP_TREES = 16
MAX_BINS = 256
# Gradients and losses are counted in these fractions of the largest label (1 for the logistic loss).
_FINEST = 30
# Up to so many sums are held in arrays by a task; more are sorted and passed on chunk by chunk.
_DENSE = 1 << 18
# Rows that a task works on at once.
_CHUNK = 1 << 16


@dataclass(frozen=True)
class BoostParams:
    """Settings of one fit; ``objective`` is ``logistic`` (labels 0 and 1) or ``squared``."""

    rounds: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    objective: str = "logistic"


@dataclass
class Tree:
    """Nodes in arrays; a leaf has feature -1.  Bins up to ``bin`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def add(self, value: float) -> int:
        for column, v in zip(
            (self.feature, self.bin, self.missing_left, self.left, self.right, self.value),
            (-1, 0, True, 0, 0, value),
            strict=True,
        ):
            column.append(v)
        return len(self.value) - 1

    def nodes(self, bins: np.ndarray, missing: int) -> np.ndarray:
        """The leaf each row comes to."""
        at = np.zeros(len(bins), np.int64)
        feature, split = np.array(self.feature), np.array(self.bin)
        left, right, to_left = np.array(self.left), np.array(self.right), np.array(self.missing_left)
        rows = np.flatnonzero(feature[at] >= 0)
        while len(rows):
            node = at[rows]
            value = bins[rows, feature[node]]
            goes = np.where(value == missing, to_left[node], value <= split[node])
            at[rows] = np.where(goes, left[node], right[node])
            rows = rows[feature[at[rows]] >= 0]
        return at

    def values(self, bins: np.ndarray, missing: int) -> np.ndarray:
        return np.array(self.value)[self.nodes(bins, missing)]


@dataclass
class Boosted:
    """A fitted model: where bins end, the trees, and how the held-out loss went."""

    edges: list[list[float]]
    trees: list[Tree]
    objective: str
    losses: list[float] = field(default_factory=list)

    @property
    def best_round(self) -> int:
        return len(self.trees)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Boosted:
        d = json.loads(text)
        return Boosted(d["edges"], [Tree(**t) for t in d["trees"]], d["objective"], d["losses"])

    def margins(self, features: np.ndarray) -> np.ndarray:
        """The sum of the trees for rows of features."""
        bins = binned(features, self.edges)
        out, missing = np.zeros(len(bins)), missing_bin(self.edges)
        for tree in self.trees:
            out += tree.values(bins, missing)
        return out


def missing_bin(edges: Sequence[Sequence[float]]) -> int:
    return max((len(e) for e in edges), default=0) + 1


def binned(features: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """The bin of each value: the number of edges below it; missing values have a bin of their own."""
    out = np.empty(features.shape, np.int16)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(np.asarray(e, float), features[:, j], "left")
    out[np.isnan(features)] = missing_bin(edges)
    return out


def bin_edges(rows: DataFrame, features: str, max_bins: int = MAX_BINS) -> list[list[float]]:
    """Edges between bins for each slot of an array column, from mergeable quantile summaries."""
    size = rows.select(F.max(F.size(features))).first()[0] or 0
    shares = [k / max_bins for k in range(max_bins + 1)]
    slots = [
        F.percentile_approx(F.nanvl(F.get(features, F.lit(j)), F.lit(None)), shares, 20 * max_bins)
        for j in range(size)
    ]
    found = rows.agg(F.array(*slots).alias("e")).first()["e"] if size else []
    # The greatest value ends no bin.
    return [sorted({float(v) for v in e or [] if v == v})[:-1] for e in found]


@dataclass
class _Fit:
    """One fit under way: what it has grown so far."""

    params: BoostParams
    validation: int | None
    trees: list[Tree] = field(default_factory=list)
    tree: Tree | None = None
    frontier: list[int] = field(default_factory=lambda: [0])
    depth: int = 0
    kept: int = 0  # trees that are in the stored margins
    losses: list[float] = field(default_factory=list)
    done: bool = False

    def starts_round(self) -> bool:
        return self.tree is None

    def best(self) -> int:
        """The number of trees with the lowest held-out loss, of the first with it; all without held-out rows."""
        if not self.losses:
            return len(self.trees)
        return int(np.argmin(self.losses[1:])) + 1 if len(self.losses) > 1 else 0


def _derivatives(objective: str, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if objective == "squared":
        return margin - y, np.ones_like(margin)
    p = 1 / (1 + np.exp(-margin))
    return p - y, p * (1 - p)


def _loss(objective: str, y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    if objective == "squared":
        return (margin - y) ** 2
    return np.logaddexp(0, margin) - y * margin


def _counted(x: np.ndarray, scale: float) -> np.ndarray:
    """Whole multiples of 1 / scale: their sums do not depend on the order."""
    return np.rint(x * scale)


def _sums(rows: DataFrame, fits: list[_Fit], width: int, missing: int, scale: float) -> DataFrame:
    """(fit, node, feature, bin, g, h): sums of a task over the level each fit has come to.

    Feature -1 has the held-out loss in ``g`` and the number of held-out rows in ``h``.
    """
    known = rows.sparkSession.sparkContext.broadcast(
        [(i, f.params, f.validation, f.trees[f.kept :], f.tree, f.frontier, f.starts_round()) for i, f in enumerate(fits) if not f.done]
    )
    states = missing + 1

    def rows_of(i: int, j: int, key: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        columns = [np.full(len(key), i), key // states, np.full(len(key), j), key % states, sums[0], sums[1]]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["fit", "node", "feature", "bin", "g", "h"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(begin, _CHUNK)
                n = part.num_rows
                bins = part.column(0).flatten().to_numpy().reshape(n, width)
                y, own_part = part.column(1).to_numpy(), part.column(2).to_numpy()
                margins = part.column(3).flatten().to_numpy().reshape(n, -1)
                for i, params, validation, trees, tree, frontier, starts in known.value:
                    margin = margins[:, i].copy()
                    for t in trees:
                        margin += t.values(bins, missing)
                    out = own_part == validation if validation is not None else np.zeros(n, bool)
                    if starts and out.any():
                        loss = _counted(_loss(params.objective, y[out], margin[out]), scale).astype(np.int64)
                        held[i] = held.get(i, 0) + np.array([loss.sum(), out.sum()])
                    g, h = _derivatives(params.objective, y, margin)
                    slot = np.full(len(tree.value) if tree else 1, -1)
                    slot[frontier] = np.arange(len(frontier))
                    at = slot[tree.nodes(bins, missing)] if tree else np.zeros(n, np.int64)
                    use = np.flatnonzero((at >= 0) & ~out)
                    values = np.stack([_counted(g[use], scale), _counted(h[use], scale), np.ones(len(use))])
                    size = len(frontier) * states
                    for j in range(width):
                        key = at[use] * states + bins[use, j]
                        if size <= _DENSE:
                            sums = [np.bincount(key, v, size).astype(np.int64) for v in values]
                            totals[i, j] = totals.get((i, j), 0) + np.stack(sums)
                        elif len(key):
                            order = np.argsort(key, kind="stable")
                            found, first = np.unique(key[order], return_index=True)
                            yield rows_of(i, j, found, np.add.reduceat(values[:, order], first, axis=1))
        for (i, j), sums in totals.items():
            key = np.flatnonzero(sums[2])
            yield rows_of(i, j, key, sums[:, key])
        for i, sums in held.items():
            yield rows_of(i, -1, np.zeros(1, np.int64), sums[:, None])

    return with_code(rows).mapInArrow(add, "fit long, node long, feature long, bin long, g long, h long")


def _soft(g: Column, alpha: Column) -> Column:
    return F.signum(g) * F.greatest(F.abs(g) - alpha, F.lit(0.0))


def _best_splits(sums: DataFrame, fits: list[_Fit], missing: int, scale: float) -> list:
    """For each fit and node the best split, or none; for each fit the held-out loss.

    Rows are merged and the bins of a feature cumulated, ``missing`` + 1 bins at most in a group.
    """
    alpha, lambda_, least = (
        F.array(*[F.lit(float(getattr(f.params, name))) for f in fits])[F.col("fit").cast("int")]
        for name in ("reg_alpha", "reg_lambda", "min_child_weight")
    )
    total = [F.sum(F.col(c).cast("decimal(20,0)")).cast("double").alias(c) for c in ("g", "h")]
    merged = sums.groupBy("fit", "node", "feature", "bin").agg(*total)
    # Row numbers of held-out losses are counts already.
    merged = merged.withColumns({
        "g": F.col("g") / scale, "h": F.when(F.col("feature") < 0, F.col("h")).otherwise(F.col("h") / scale),
    })
    whole = Window.partitionBy("fit", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lost = F.col("bin") == missing
    placed = merged.withColumns({
        **{f"{c}_all": F.sum(c).over(whole) for c in ("g", "h")},
        **{f"{c}_upto": F.sum(c).over(upto) for c in ("g", "h")},
        **{f"{c}_lost": F.sum(F.when(lost, F.col(c)).otherwise(0.0)).over(whole) for c in ("g", "h")},
    })

    def worth(g: Column, h: Column) -> Column:
        soft = _soft(g, alpha)
        return F.when(h + lambda_ > 0, soft * soft / (h + lambda_)).otherwise(0.0)

    def split(left: bool) -> Column:
        g, h = [F.col(f"{c}_upto") + (F.col(f"{c}_lost") if left else 0.0) for c in ("g", "h")]
        rest_g, rest_h = F.col("g_all") - g, F.col("h_all") - h
        gain = worth(g, h) + worth(rest_g, rest_h) - worth(F.col("g_all"), F.col("h_all"))
        fits_ = (h > 0) & (rest_h > 0) & (h >= least) & (rest_h >= least) & ~lost
        # Equal gains: the first feature, its first bin, missing values to the left.
        return F.struct(
            F.when(fits_, gain).alias("gain"), (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"),
            F.lit(left).alias("missing_left"), g.alias("g"), h.alias("h"), rest_g.alias("rest_g"), rest_h.alias("rest_h"),
        )

    both = F.greatest(split(True), split(False))
    best = placed.groupBy("fit", "node").agg(
        F.max(F.when(F.col("feature") >= 0, both)).alias("split"),
        F.max(F.when(F.col("feature") == 0, F.struct("g_all", "h_all"))).alias("own"),
        F.max(F.when(F.col("feature") == -1, F.struct("g", "h"))).alias("held"),
    )
    return best.collect()


def _weight(params: BoostParams, g: float, h: float) -> float:
    soft = np.sign(g) * max(abs(g) - params.reg_alpha, 0.0)
    return float(-params.learning_rate * soft / (h + params.reg_lambda)) if h + params.reg_lambda > 0 else 0.0


def _advance(fit: _Fit, nodes: dict, loss: float | None, patience: int | None, least_gain: float) -> None:
    """Take the splits of one pass into a fit."""
    if fit.starts_round():
        if loss is not None:
            fit.losses.append(loss)
            if len(fit.losses) > 1 and patience is not None and _waited(fit.losses[1:], patience, least_gain):
                fit.done = True
                return
        if len(fit.trees) >= fit.params.rounds:
            fit.done = True
            return
        fit.tree, fit.frontier, fit.depth = Tree(), [0], 0
    tree, next_ = fit.tree, []
    for slot, node in enumerate(fit.frontier):
        row = nodes.get(slot)
        if row is None:
            continue
        if fit.depth == 0:
            tree.value[node] = _weight(fit.params, row["own"]["g_all"], row["own"]["h_all"])
        split = row["split"]
        if fit.depth < fit.params.max_depth and split is not None and split["gain"] is not None and split["gain"] > 0:
            tree.feature[node], tree.bin[node], tree.missing_left[node] = -split["feature"], -split["bin"], split["missing_left"]
            tree.left[node] = tree.add(_weight(fit.params, split["g"], split["h"]))
            tree.right[node] = tree.add(_weight(fit.params, split["rest_g"], split["rest_h"]))
            next_ += [tree.left[node], tree.right[node]]
    fit.depth += 1
    fit.frontier = next_
    if not next_ or fit.depth >= fit.params.max_depth:
        fit.trees.append(tree)
        fit.tree, fit.frontier = None, [0]


def _waited(losses: list[float], patience: int, least_gain: float) -> bool:
    best, lowest = 0, losses[0]
    for k, loss in enumerate(losses):
        if loss < lowest - least_gain:
            best, lowest = k, loss
    return len(losses) - 1 - best >= patience


def fit_boosted(
    rows: DataFrame,
    features: str,
    label: str,
    params: Sequence[BoostParams],
    part: str | None = None,
    validation: Sequence[int | None] | None = None,
    patience: int | None = None,
    least_gain: float = 1e-9,
    max_bins: int = MAX_BINS,
) -> list[Boosted]:
    """Fit every setting; all of them together take the scans of the longest one.

    ``features`` is a vector or an array of doubles, ``label`` a number.  Rows whose integer
    ``part`` equals a fit's ``validation`` are held out from it (null parts never are).  With
    ``patience`` a fit ends when so many rounds brought no gain on them; a model has the trees up
    to the round with the lowest held-out loss.  Rows with a null or NaN label take no part; an
    input without rows gives models without trees.
    """
    validation = list(validation or [None] * len(params))
    if len(validation) != len(params):
        raise ValueError("validation needs one part for each setting")
    kind = rows.schema[features].dataType
    array = vector_to_array(F.col(features)) if isinstance(kind, VectorUDT) else F.col(features).cast("array<double>")
    used = rows.select(
        array.alias("x"),
        F.col(label).cast("double").alias("y"),
        F.coalesce(F.col(part).cast("long"), F.lit(-1)).alias("part") if part else F.lit(-1).cast("long").alias("part"),
    ).where("y IS NOT NULL AND NOT isnan(y) AND x IS NOT NULL")
    spark = rows.sparkSession
    edges = bin_edges(used, "x", max_bins)
    width, missing = len(edges), missing_bin(edges)
    known = spark.sparkContext.broadcast(edges)
    fits = [_Fit(p, v) for p, v in zip(params, validation, strict=True)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0)
            flat = x.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, width)
            bins = pa.array(binned(flat, known.value).ravel())
            ends = pa.array(np.arange(batch.num_rows + 1) * width, pa.int32())
            zeros = pa.array(np.zeros(batch.num_rows * len(fits)))
            at = pa.array(np.arange(batch.num_rows + 1) * len(fits), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(ends, bins), batch.column(1), batch.column(2), pa.ListArray.from_arrays(at, zeros)],
                names=["bins", "y", "part", "margins"],
            )

    schema = "bins array<smallint>, y double, part long, margins array<double>"
    stored: list[list[str]] = [[]]
    with noting(stored[-1]):
        current = stage(with_code(used).mapInArrow(cut, schema), "boosting")
    largest = 1.0
    if any(f.params.objective == "squared" for f in fits):
        largest = max(1.0, current.agg(F.max(F.abs("y"))).first()[0] or 0.0)
    # Squared errors of a chunk must stay below 2 ** 63 when counted.
    scale = 2.0 ** (_FINEST - 2 * math.ceil(math.log2(largest)))
    try:
        while width and not all(f.done for f in fits):
            found = _best_splits(_sums(current, fits, width, missing, scale), fits, missing, scale)
            by_fit: dict[int, dict] = {}
            for r in found:
                by_fit.setdefault(r["fit"], {})[r["node"]] = r
            for i, f in enumerate(fits):
                if f.done:
                    continue
                nodes = by_fit.get(i, {})
                held = next((r["held"] for r in nodes.values() if r["held"]), None)
                loss = held["g"] / held["h"] if held else None
                if not nodes:
                    f.done = True  # no row to train on
                else:
                    _advance(f, nodes, loss, patience, least_gain)
            if max((len(f.trees) - f.kept for f in fits if not f.done), default=0) >= KEEP_TREES:
                stored.append([])
                with noting(stored[-1]):
                    current = stage(_with_margins(current, fits, width, missing, schema), "boosting")
                discard(spark, stored.pop(0))
                for f in fits:
                    f.kept = len(f.trees)
    finally:
        for paths in stored:
            discard(spark, paths)
    return [Boosted(edges, f.trees[: f.best()], f.params.objective, f.losses) for f in fits]


def _with_margins(rows: DataFrame, fits: list[_Fit], width: int, missing: int, schema: str) -> DataFrame:
    """The rows with the latest trees added to their margins."""
    known = rows.sparkSession.sparkContext.broadcast([f.trees[f.kept :] for f in fits])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, width)
            margins = batch.column(3).flatten().to_numpy().reshape(batch.num_rows, -1).copy()
            for i, trees in enumerate(known.value):
                for t in trees:
                    margins[:, i] += t.values(bins, missing)
            ends = pa.array(np.arange(batch.num_rows + 1) * margins.shape[1], pa.int32())
            new = pa.ListArray.from_arrays(ends, pa.array(margins.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], new], names=["bins", "y", "part", "margins"])

    return with_code(rows).mapInArrow(add, schema)


@lru_cache(maxsize=16)
def _read(text: str) -> Boosted:
    return Boosted.from_json(text)


class RegularizedBoosterModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted booster as a pipeline stage: probability (logistic) and prediction of feature vectors."""

    boosted = Param(Params._dummy(), "boosted", "the model as JSON", typeConverter=TypeConverters.toString)

    def __init__(self, boosted: Boosted | None = None, features: str = "features"):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction", probabilityCol="probability")
        self._set(featuresCol=features)
        if boosted is not None:
            self._set(boosted=boosted.to_json())

    @property
    def model(self) -> Boosted:
        return _read(self.getOrDefault(self.boosted))

    @property
    def getNumTrees(self) -> int:
        return len(self.model.trees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        dataset = with_code(dataset)
        known = dataset.sparkSession.sparkContext.broadcast(self.getOrDefault(self.boosted))

        def margin(features: pd.Series) -> pd.Series:
            rows = np.stack([np.asarray(v, float) for v in features]) if len(features) else np.zeros((0, 0))
            return pd.Series(_read(known.value).margins(rows) if len(features) else np.zeros(0))

        margin.__annotations__ = {"features": pd.Series, "return": pd.Series}
        column = F.pandas_udf(margin, "double")(vector_to_array(F.col(self.getFeaturesCol())))
        if self.model.objective == "squared":
            return dataset.withColumn(self.getPredictionCol(), column)
        scored = dataset.withColumn("__margin", column)
        positive = 1 / (1 + F.exp(-F.col("__margin")))
        return scored.withColumns({
            self.getProbabilityCol(): array_to_vector(F.array(1 - positive, positive)),
            self.getPredictionCol(): (F.col("__margin") > 0).cast("double"),
        }).drop("__margin")


class RegularizedBooster(Estimator, HasFeaturesCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """One booster as the last stage of a pipeline; ``settings`` are those of ``BoostParams``.

    ``validationCol``, if set, is a boolean column of held-out rows, on which ``patience`` waits.
    """

    settings = Param(Params._dummy(), "settings", "BoostParams as JSON", typeConverter=TypeConverters.toString)
    validationIndicatorCol = Param(Params._dummy(), "validationIndicatorCol", "held-out rows", typeConverter=TypeConverters.toString)
    patience = Param(Params._dummy(), "patience", "rounds without a gain", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, params: BoostParams | None = None, featuresCol: str = "features", labelCol: str = "label",
                 held_out: str | None = None, patience: int | None = None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label")
        self._set(featuresCol=featuresCol, labelCol=labelCol, settings=json.dumps(asdict(params or BoostParams())))
        if held_out is not None:
            self._set(validationIndicatorCol=held_out)
        if patience is not None:
            self._set(patience=patience)

    def _fit(self, dataset: DataFrame) -> RegularizedBoosterModel:
        params = BoostParams(**json.loads(self.getOrDefault(self.settings)))
        held = self.getOrDefault(self.validationIndicatorCol) if self.isSet(self.validationIndicatorCol) else None
        rows = dataset.withColumn("__part", F.coalesce(F.col(held), F.lit(False)).cast("int")) if held else dataset
        [found] = fit_boosted(
            rows, self.getFeaturesCol(), self.getLabelCol(), [params], "__part" if held else None,
            [1 if held else None], self.getOrDefault(self.patience) if self.isSet(self.patience) else None,
        )
        return RegularizedBoosterModel(found, self.getFeaturesCol())
