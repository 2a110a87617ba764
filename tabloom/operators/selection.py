"""Order statistics by radix: histograms over the ordered bits of a value, narrowed to the wanted ranks.

Sorting a table to read a few ranks off it moves every row.  Here a pass counts rows by the
leading ``DIGIT`` bits of their value, a running sum over these counts tells which bins hold
the wanted ranks, and the next pass counts the following bits inside those bins only.  Counts are
combined before their shuffle and bounded by the number of bins, so the rows themselves never
move.  A bin whose least and greatest value agree is done, which coarse values are after a pass or two;
64 bits take four at most.  The input is read once a pass and must give the same rows each time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.ordering import BROADCAST_ROWS
from tabloom.session import stage

DIGIT = 16
_KEY = "__key"


def _two_to(power: Column) -> Column:
    """2 ** ``power`` for whole powers, by a shift where that will do."""
    one, whole = F.lit(1).cast("long"), power.cast("int")
    up = F.call_function("shiftleft", one, whole).cast("double")
    down = F.lit(1.0) / F.call_function("shiftleft", one, -whole).cast("double")
    return F.when(power.between(0, 62), up).when(power.between(-62, -1), down).otherwise(F.pow(F.lit(2.0), power))


def with_ordered_bits(df: DataFrame, value: str, bits: str) -> DataFrame:
    """``df`` with a 64-bit integer in the order of a double, one for each value; null for null and NaN.

    It is the number IEEE 754 stores, taken apart by exact arithmetic, with its sign; both zeros
    are 0.  Steps are columns of their own, so that none is worked out twice.
    """
    columns = df.columns
    size = df.withColumn("__size", F.abs(F.col(value).cast("double")))
    finite = (F.col("__size") > 0) & (F.col("__size") < float("inf"))
    guess = size.withColumn("__guess", F.when(finite, F.floor(F.log2("__size")).cast("double")))
    # The logarithm may be off next to powers of two.
    ends = guess.withColumns({"__low": _two_to(F.col("__guess")), "__high": _two_to(F.col("__guess") + 1)})
    off = F.when(F.col("__size") < F.col("__low"), -1.0).when(F.col("__size") >= F.col("__high"), 1.0).otherwise(0.0)
    power = ends.withColumn("__power", F.greatest(F.col("__guess") + off, F.lit(-1022.0)))
    # Halved exponents keep the powers within range.
    halved = power.withColumn("__half", F.floor(F.col("__power") / 2))
    halved = halved.withColumns({"__one": _two_to(F.col("__half")), "__other": _two_to(F.col("__power") - F.col("__half"))})
    part = F.col("__size") / F.col("__one") / F.col("__other")
    fraction = F.lit(float(1 << 52))
    number = ((F.col("__power") + 1022) * fraction).cast("long") + (part * fraction).cast("long")
    stored = halved.withColumn(
        "__bits",
        F.when(F.col("__size") == 0, F.lit(0).cast("long"))
        .when(F.col("__size") == float("inf"), F.lit(0x7FF << 52).cast("long"))
        .when(F.col("__size") < float("inf"), number),
    )
    return stored.select(*columns, F.when(F.col(value) < 0, -F.col("__bits")).otherwise(F.col("__bits")).alias(bits))


def value_from_bits(bits: Column) -> Column:
    """The double that ``with_ordered_bits`` gives a number."""
    size = F.abs(bits)
    field = F.shiftright(size, 52)
    fraction = (size.bitwiseAND(F.lit((1 << 52) - 1))).cast("double") / F.lit(float(1 << 52))
    power = F.greatest(field, F.lit(1)).cast("double") - 1023
    half = F.floor(power / 2)
    two = F.lit(2.0)
    value = (fraction + F.when(field > 0, 1.0).otherwise(0.0)) * F.pow(two, half) * F.pow(two, power - half)
    value = F.when(field == 0x7FF, F.lit(float("inf"))).otherwise(value)
    return F.when(bits < 0, -value).otherwise(value)


def _same(groups: Sequence[str], left: str, right: str) -> Column:
    condition = F.lit(True)
    for g in groups:
        condition = condition & F.col(f"{left}.{g}").eqNullSafe(F.col(f"{right}.{g}"))
    return condition


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def keys_at_ranks(
    rows: DataFrame, key: str, group_by: Sequence[str], ranks: Callable[[Column], list[Column]], digit: int = DIGIT
) -> DataFrame:
    """(groups, n_rows, rank, key, before, n): the 64-bit ``key`` at 0-based ranks of each group.

    ``ranks`` gives the wanted ranks in terms of the group's number of rows; ``before`` rows have
    a smaller key, and ``n`` the same one.  Rows with a null key are left out; a key that is worked out
    at length should not be nullable, as the test for nulls would work it out once more.
    """
    groups = list(group_by)
    held = rows.select(*groups, F.col(key).alias(_KEY))
    if rows.schema[key].nullable:
        held = held.where(F.col(_KEY).isNotNull())
    shift = 64 - digit

    def cells(part: DataFrame, *columns: str) -> DataFrame:
        place = F.shiftright(_KEY, shift) if shift else F.col(_KEY)
        return stage(
            part.groupBy(*groups, *columns, place.alias("place")).agg(
                F.count(F.lit(1)).alias("n"), F.min(_KEY).alias("low"), F.max(_KEY).alias("high")
            ),
            "radix",
        )

    first = cells(held)
    whole = Window.partitionBy(*groups)
    upto = whole.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = first.withColumns({
        "before": F.coalesce(F.sum("n").over(upto), F.lit(0)), "n_rows": F.sum("n").over(whole)
    })
    wanted = F.array_distinct(F.filter(
        F.array(*ranks(F.col("n_rows"))), lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n"))
    ))
    columns = [*groups, "n_rows", "rank", "place", "before", "n", "low", "high"]
    state = stage(placed.withColumn("rank", F.explode(wanted)).select(*columns), "ranks")
    done = [state.where("low = high")]
    state = state.where("low < high")
    while shift and not state.isEmpty():
        last, shift = shift, max(0, shift - digit)
        open_ = state.select(*groups, F.col("place").alias("above")).distinct()
        here = F.shiftright(f"r.{_KEY}", last) == F.col("o.above")
        inside = held.alias("r").join(_few(open_).alias("o"), _same(groups, "r", "o") & here)
        counted = cells(inside.select("r.*", "o.above"), "above")
        upto = Window.partitionBy(*groups, "above").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("start", F.coalesce(F.sum("n").over(upto), F.lit(0)))
        own = state.select(*groups, "n_rows", "rank", F.col("place").alias("above"), "before")
        at = F.col("s.before") + F.col("c.start")
        holds = (F.col("s.rank") >= at) & (F.col("s.rank") < at + F.col("c.n"))
        found = counted.alias("c").join(
            _few(own).alias("s"), _same(groups, "c", "s") & (F.col("c.above") == F.col("s.above")) & holds
        )
        state = stage(
            found.select(
                *(F.col(f"s.{g}") for g in groups), "s.n_rows", "s.rank", "c.place", at.alias("before"), "c.n", "c.low", "c.high"
            ),
            "ranks",
        )
        done.append(state.where("low = high"))
        state = state.where("low < high")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(*groups, "n_rows", "rank", F.col("low").alias("key"), "before", "n")
