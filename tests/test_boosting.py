"""Second-order boosting against a plain implementation, and its number of scans."""

from __future__ import annotations

import datetime
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tabloom.operators import boosting, models, scoring
from tabloom.operators.boosting import Boosted, BoostParams, RegularizedBooster, fit_boosted
from tabloom.queries import all_queries
from tabloom.sources.models import load_model, save_model

KIND = "x array<double>, y double, part int"


def soft(g, alpha):
    return math.copysign(max(abs(g) - alpha, 0.0), g)


def plain_tree(x, g, h, rows, p, depth):
    """(weight) of a leaf or (feature, edge, missing_left, left, right) by exhaustive search."""

    def worth(rs):
        total, weight = g[rs].sum(), h[rs].sum()
        return soft(total, p.reg_alpha) ** 2 / (weight + p.reg_lambda)

    best = None
    if depth < p.max_depth:
        for j in range(x.shape[1]):
            own = x[rows, j]
            for edge in sorted(set(own[~np.isnan(own)]))[:-1] or []:
                for missing_left in (True, False):
                    left = rows[np.where(np.isnan(own), missing_left, own <= edge)]
                    right = np.setdiff1d(rows, left)
                    if min(h[left].sum(), h[right].sum()) < max(p.min_child_weight, 1e-12):
                        continue
                    gain = worth(left) + worth(right) - worth(rows)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = gain, left, right
    if best is None:
        return {int(r): -p.learning_rate * soft(g[rows].sum(), p.reg_alpha) / (h[rows].sum() + p.reg_lambda) for r in rows}
    return plain_tree(x, g, h, best[1], p, depth + 1) | plain_tree(x, g, h, best[2], p, depth + 1)


def plain(x, y, train, p):
    """Margins of the training rows after all rounds."""
    margin = np.zeros(len(y))
    for _ in range(p.rounds):
        if p.objective == "squared":
            g, h = margin - y, np.ones(len(y))
        else:
            q = 1 / (1 + np.exp(-margin))
            g, h = q - y, q * (1 - q)
        for r, w in plain_tree(x, g, h, np.flatnonzero(train), p, 0).items():
            margin[r] += w
    return margin


def data(n=240, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, n), rng.normal(size=n).round(1), rng.integers(0, 2, n)]).astype(float)
    x[rng.random(n) < 0.1, 0] = np.nan
    y = (np.nan_to_num(x[:, 0], nan=8) + 3 * x[:, 1] + rng.normal(size=n) > 4).astype(float)
    return x, y, rng.integers(0, 3, n)


def frame(spark, x, y, part, parts=3):
    return spark.createDataFrame([(r.tolist(), float(v), int(k)) for r, v, k in zip(x, y, part, strict=True)], KIND).repartition(parts)


SETTINGS = [
    BoostParams(3, 3, 0.5, 0.0, 1.0, 1.0),
    BoostParams(2, 4, 0.3, 2.0, 0.1, 0.0),
    BoostParams(4, 1, 1.0, 0.5, 5.0, 3.0),
    BoostParams(2, 2, 0.7, 0.3, 1.0, 5.0, "squared"),
]


def test_all_fits_equal_a_plain_implementation(spark):
    x, y, part = data()
    held = [None, 0, 1, 2]
    found = fit_boosted(frame(spark, x, y, part), "x", "y", SETTINGS, "part", held)
    for p, v, model in zip(SETTINGS, held, found, strict=True):
        train = part != v if v is not None else np.ones(len(y), bool)
        # Trees after the lowest held-out loss are cut, so as many rounds are compared.
        want = plain(x, y, train, BoostParams(**{**vars(p), "rounds": len(model.trees)}))
        assert np.abs(model.margins(x)[train] - want[train]).max() < 1e-6
        assert len(model.losses) == (p.rounds + 1 if v is not None else 0)
        if v is not None:
            assert len(model.trees) == 1 + int(np.argmin(model.losses[1:]))


def test_models_do_not_depend_on_the_layout(spark):
    x, y, part = data(seed=2)
    first = fit_boosted(frame(spark, x, y, part, 1), "x", "y", SETTINGS, "part", [0] * 4)
    again = fit_boosted(frame(spark, x[::-1], y[::-1], part[::-1], 7), "x", "y", SETTINGS, "part", [0] * 4)
    assert [m.to_json() for m in first] == [m.to_json() for m in again]
    assert Boosted.from_json(first[0].to_json()) == first[0]


def test_strengths_move_the_predictions(spark):
    x, y, part = data()
    base, alpha, lambda_ = fit_boosted(
        frame(spark, x, y, part), "x", "y",
        [BoostParams(3), BoostParams(3, reg_alpha=3.0), BoostParams(3, reg_lambda=30.0)],
    )
    assert np.abs(alpha.margins(x)).mean() < np.abs(base.margins(x)).mean()
    assert np.abs(lambda_.margins(x)).mean() < np.abs(base.margins(x)).mean()


def test_scans_follow_the_longest_fit_not_the_number_of_fits(spark, monkeypatch):
    x, y, part = data(seed=3)
    rows, scans = frame(spark, x, y, part), []
    real = boosting._sums
    monkeypatch.setattr(boosting, "_sums", lambda *a: scans.append(1) or real(*a))

    def count(settings, held):
        scans.clear()
        fit_boosted(rows, "x", "y", settings, "part", held)
        return len(scans)

    grid = [BoostParams(3, 2, rate, alpha) for rate in (0.1, 0.5) for alpha in (0.0, 1.0)]
    each = [count([p], [v]) for p in grid for v in (0, 1)]
    assert count([p for p in grid for _ in (0, 1)], [0, 1] * 4) == max(each) < sum(each)


def test_patience_needs_no_further_fit(spark, monkeypatch):
    x, y, part = data(seed=4)
    monkeypatch.setattr(boosting, "KEEP_TREES", 3)
    [model] = fit_boosted(frame(spark, x, y, part), "x", "y", [BoostParams(60, 4, 0.9, reg_lambda=0.0, min_child_weight=0.0)], "part", [0], patience=4)
    best = 1 + int(np.argmin(model.losses[1:]))
    assert len(model.trees) == best and len(model.losses) - 1 == best + 4 < 60


def test_many_nodes_are_passed_on_sorted(spark, monkeypatch):
    x, y, part = data(seed=5)
    want = fit_boosted(frame(spark, x, y, part), "x", "y", SETTINGS)
    monkeypatch.setattr(boosting, "_DENSE", 0)
    assert [m.to_json() for m in fit_boosted(frame(spark, x, y, part), "x", "y", SETTINGS)] == [m.to_json() for m in want]


def test_pipeline_stage_is_stored_and_scores(spark, tmp_path):
    x, y, part = data()
    rows = frame(spark, x, y, part).select(F.col("x")[0].alias("a"), F.col("x")[1].alias("b"), F.col("x")[2].alias("c"), "y", (F.col("part") == 0).alias("held"))
    booster = RegularizedBooster(params=BoostParams(5), labelCol="y", held_out="held", patience=3)
    model = models.fit(rows, models.pipeline(["a", "b", "c"], booster, None))
    scored = scoring.predict_probability(rows, model)
    assert scored.where("prediction BETWEEN 0 AND 1").count() == len(y)
    save_model(model, f"{tmp_path}/m", scoring.infer_signature(rows, ["a", "b", "c"]))
    again = scoring.predict_probability(rows, load_model(spark, f"{tmp_path}/m").pipeline)
    assert sorted(map(str, scored.collect())) == sorted(map(str, again.collect()))
    [direct] = fit_boosted(frame(spark, x, y, (part != 0).astype(int)), "x", "y", [BoostParams(5)], "part", [0], 3)
    assert model.stages[-1].getNumTrees == len(direct.trees)
    accuracy = scored.where((F.col("prediction") > 0.5) == (F.col("y") == 1)).count() / len(y)
    assert accuracy > 0.8


@pytest.mark.parametrize("rows", [[], [([1.0], None, 0), ([2.0], float("nan"), 0)]])
def test_without_rows_there_are_no_trees(spark, rows):
    [model] = fit_boosted(spark.createDataFrame(rows, KIND), "x", "y", [BoostParams(3)])
    assert model.trees == [] and Pipeline is not None


def test_batches_that_hold_different_bins_add_up(spark):
    """The first scan of a task whose batches end at different bins, as those of long tables do."""
    rows = [([float(v)], float(v % 3 == 0), v % 2) for k in range(6) for v in range(k + 2)]
    settings = [BoostParams(3, 2, 0.3, min_child_weight=0.0)] * 2
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = []
    try:
        for batch in ("3", "1000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            df = spark.createDataFrame(rows, KIND).coalesce(1)
            found.append([m.to_json() for m in fit_boosted(df, "x", "y", settings, "part", [0, None])])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert found[0] == found[1]


def test_search_over_tasks_that_hold_different_parts_of_the_day(spark, tmp_path):
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    at = lambda i: datetime.datetime(2024, 1, 1, i * i % 24)
    rows = [(i, at(i % 90), float(i * 37 % 100)) for i in range(900)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = []
    try:
        for batch in ("7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            found.append(sorted(map(tuple, all_queries()["boosted_search_one_scan"](spark, str(tmp_path)).collect())))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert len(found[0]) == 4 and found[0] == found[1]
