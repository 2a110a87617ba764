"""Train/validation/test splits and folds as a column of one frame."""

from __future__ import annotations

from collections.abc import Sequence
from math import floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.hashing import hash01, key_digest
from tabloom.operators.ordering import dense_row_id
from tabloom.operators.selection import keys_at_ranks


def _cut_points(weights: dict[str, float]) -> list[tuple[str, float]]:
    """Upper bound of each split's share of [0, 1), last one excluded."""
    total = float(sum(weights.values()))
    running, cuts = 0.0, []
    for name, weight in weights.items():
        running += weight
        # Rounded so that 0.6 + 0.2 cuts at 0.8 and not a hair beside it.
        cuts.append((name, round(running / total, 12)))
    return cuts


def _choose(position: Column, cuts: Sequence[tuple[str, float | int]]) -> Column:
    chosen = F.lit(cuts[-1][0])
    for name, upper in reversed(cuts[:-1]):
        chosen = F.when(position < F.lit(upper), F.lit(name)).otherwise(chosen)
    return chosen


def hash_split(
    df: DataFrame,
    key: Sequence[str],
    weights: dict[str, float],
    seed: int,
    output: str = "split",
) -> DataFrame:
    """Assign each row to a split by its key: no shuffle, no dependence on layout.

    Sizes are approximate, as with any independent draw; see ``exact_split``.
    """
    return df.withColumn(output, _choose(hash01(seed, *key), _cut_points(weights)))


def exact_split(
    df: DataFrame,
    key: Sequence[str],
    weights: dict[str, float],
    seed: int,
    output: str = "split",
) -> DataFrame:
    """Split with exact sizes: rows in the order of their key's digest, cut at whole-row counts.

    The digests at the cuts are selected by their leading bits, so rows are only compared
    with a few numbers and never shuffled.  Rows that share those bits with a cut (all rows of
    one key, if keys repeat) are put in order by digest, key and the other columns.
    """
    head, digest, rank = "__head", "__digest", "__rank"
    headed = df.withColumn(digest, key_digest(seed, *key)).withColumn(
        head, F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    )
    cuts = _cut_points(weights)

    def at_cuts(n: Column) -> list[Column]:
        # A cut at the very end has no row behind it; its last row is in front then.
        places = [F.floor(n * F.lit(upper) + F.lit(1e-9)).cast("long") for _, upper in cuts[:-1]]
        return [F.least(p, n - 1) for p in places]

    found = keys_at_ranks(headed, head, [], at_cuts).orderBy("rank").collect() if len(cuts) > 1 else []
    if not found:
        return df.withColumn(output, F.lit(cuts[-1][0]))
    n = found[0]["n_rows"]
    places = [(name, floor(n * upper + 1e-9)) for name, upper in cuts]
    by_rank = {r["rank"]: r for r in found}

    def side(position: Column) -> Column:
        """The split of rows whose head differs from all heads at the cuts."""
        chosen = F.lit(cuts[-1][0])
        for name, place in reversed(places[:-1]):
            at = by_rank[min(place, n - 1)]
            before = position <= at["key"] if place >= n else position < at["key"]
            chosen = F.when(before, F.lit(name)).otherwise(chosen)
        return chosen

    at_cut = {r["key"]: r for r in found}
    crowded = [k for k, r in at_cut.items() if r["n"] > 1]
    single = [k for k, r in at_cut.items() if r["n"] == 1]
    plain = side(F.col(head))
    for k in single:
        plain = F.when(F.col(head) == k, _choose(F.lit(at_cut[k]["before"]), places)).otherwise(plain)
    alone = headed.where(~F.col(head).isin(crowded)) if crowded else headed
    out = alone.withColumn(output, plain).drop(digest, head)
    for k in crowded:
        shared = dense_row_id(headed.where(F.col(head) == k), rank, [digest, *key])
        placed = _choose(F.col(rank) + F.lit(at_cut[k]["before"]), places)
        out = out.unionByName(shared.withColumn(output, placed).drop(digest, head, rank))
    return out


def kfold(df: DataFrame, key: Sequence[str], k: int, seed: int, output: str = "fold") -> DataFrame:
    """Fold number 0..k-1 by key, usable as ``CrossValidator(foldCol=...)``."""
    return df.withColumn(output, F.floor(hash01(seed, *key) * F.lit(k)).cast("int"))


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows per split in one pass."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"))
