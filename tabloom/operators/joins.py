"""Key lookup joins that stay balanced when a few keys hold much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.session import broadcast_limit, plan_bytes, stage

# Rows of one key that one task may receive; a key with more is spread over several tasks.
ROWS_PER_TASK = 4_000_000

# Crowded keys are at most rows / ROWS_PER_TASK in number; up to this many are broadcast.
_MOST_BROADCAST = 1_000_000

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


# Up to this size every whole double stands for one integer only.
_EXACT_DOUBLE = 1 << 53


def common_key_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type in which keys of two types are compared; an error if there is none.

    Keys that differ in their own type differ in the common one, so unique keys stay
    unique.  Integers take the wider type, fractions double.  An integer and a
    fraction compare as 64-bit integers: only whole fractions below 2 ** 53 in size
    match.  Text and a number compare as text, whole numbers below that size without a
    point: ``'7'`` is 7 and 7.0, but ``'07'`` is neither.
    """
    if left == right:
        return left
    both = (left, right)
    if all(isinstance(t, _INTEGERS) for t in both):
        return max(both, key=lambda t: _INTEGERS.index(type(t)))
    if all(isinstance(t, _FLOATS) for t in both):
        return T.DoubleType()
    numbers = [t for t in both if isinstance(t, (*_INTEGERS, *_FLOATS))]
    if len(numbers) == 2:
        return T.LongType()
    if len(numbers) == 1 and any(isinstance(t, T.StringType) for t in both):
        return T.StringType()
    raise ValueError(f"keys of type {left.simpleString()} and {right.simpleString()} do not compare")


def _as_type(key: str, have: T.DataType, want: T.DataType) -> Column:
    value = F.col(key)
    if not isinstance(have, _FLOATS):
        return value if have == want else value.cast(want)
    # One zero: -0.0 and 0.0 are equal keys and must have equal hashes.
    double = value.cast("double") + F.lit(0.0)
    whole = F.when((F.floor(double) == double) & (F.abs(double) < _EXACT_DOUBLE), double.cast("long"))
    if isinstance(want, T.LongType):
        return whole
    if isinstance(want, T.StringType):
        return F.coalesce(whole.cast("string"), value.cast("string"))
    return double


def crowded_keys(
    df: DataFrame, key_sets: Sequence[Sequence[Column | str]], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Hashes of keys with more than ``rows_per_task`` rows, per key set, staged.

    One pass over the key columns, exact, combined before the shuffle.  Columns:
    ``set`` (position in ``key_sets``), ``h`` and ``n_rows``.
    """
    hashes = [
        F.struct(F.lit(i).alias("set"), F.xxhash64(*keys).alias("h"))
        for i, keys in enumerate(key_sets)
    ]
    counted = (
        df.select(F.inline(F.array(*hashes)))
        .groupBy("set", "h")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > rows_per_task)
    )
    return stage(counted, "crowded-keys")


def lookup_keys(
    df: DataFrame, features: DataFrame, keys: Sequence[str]
) -> tuple[list[Column], list[Column]]:
    """Both sides' key expressions, cast to the types in which they compare."""
    left, right = [], []
    for k in keys:
        have, other = df.schema[k].dataType, features.schema[k].dataType
        want = common_key_type(have, other)
        left.append(_as_type(k, have, want))
        right.append(_as_type(k, other, want))
    return left, right


def is_large(features: DataFrame, small_bytes: int | None = None) -> bool:
    """Whether a side is too large for Spark to broadcast by its own size rule."""
    limit = broadcast_limit(features.sparkSession) if small_bytes is None else small_bytes
    return plan_bytes(features) > limit


def lookup_join(
    df: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    small_bytes: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    unique: bool = False,
    crowded: DataFrame | None = None,
) -> DataFrame:
    """Left join to a frame with unique ``keys``; every row of ``df`` comes out once.

    Repeated feature keys are an error, found by a pass over the features; with
    ``unique`` the caller vouches for them.  Null keys match nothing.  Keys of
    different types compare as ``common_key_type`` says.

    A small feature side is left to Spark, whose own size rule (the default of
    ``small_bytes``) broadcasts it.  Beside a large one, keys with more than
    ``rows_per_task`` rows are salted: their rows are dealt over several tasks by
    a hash of the whole row, and their one feature row is repeated for each.
    ``df`` is read once in the join, and once more to count its keys unless
    ``crowded`` (columns ``h`` and ``n_rows``) brings those counts.
    """
    keys = list(keys)
    on_left, on_right = lookup_keys(df, features, keys)
    if not unique:
        repeated = features.groupBy(*(k.alias(f"k{i}") for i, k in enumerate(on_right))).count()
        known = [F.col(f"k{i}").isNotNull() for i in range(len(keys))]
        for condition in known:
            repeated = repeated.where(condition)
        if not repeated.where(F.col("count") > 1).isEmpty():
            raise ValueError(f"features have repeated keys in {keys}")
    values = [c for c in features.columns if c not in keys]
    looked_up = features.select(*(k.alias(f"__key{i}") for i, k in enumerate(on_right)), *values)
    same = F.lit(True)
    for i, k in enumerate(on_left):
        same = same & (k == F.col(f"__key{i}"))
    if not is_large(features, small_bytes):
        return df.join(looked_up, same, "left").select(*df.columns, *values)
    if crowded is None:
        crowded = crowded_keys(df, [on_left], rows_per_task)
    n_crowded = crowded.count()
    if n_crowded:
        parts = F.ceil(F.col("n_rows") / rows_per_task).cast("int").alias("__parts")
        spread = crowded.select(F.col("h").alias("__hash"), parts)
        if n_crowded <= _MOST_BROADCAST:
            spread = F.broadcast(spread)
        whole_row = F.xxhash64(*(f.name for f in df.schema.fields if _hashable(f.dataType)))
        df_columns = df.columns
        df = (
            df.withColumn("__hash", F.xxhash64(*on_left))
            .join(spread, "__hash", "left")
            .withColumn("__salt", F.coalesce(F.pmod(whole_row, "__parts"), F.lit(0)).cast("int"))
            .select(*df_columns, "__salt")
        )
        salts = F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)
        key_columns = [f"__key{i}" for i in range(len(keys))]
        looked_up = (
            looked_up.withColumn("__hash", F.xxhash64(*key_columns))
            .join(spread, "__hash", "left")
            .select(*key_columns, *values, F.explode(salts).alias("__dealt"))
        )
        joined = df.join(looked_up, same & (F.col("__salt") == F.col("__dealt")), "left")
        return joined.select(*df_columns, *values)
    return df.join(looked_up, same, "left").select(*df.columns, *values)


def _hashable(kind: T.DataType) -> bool:
    """Spark hashes neither maps nor variants, at any depth."""
    return not any(word in kind.simpleString() for word in ("map<", "variant"))
