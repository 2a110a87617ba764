"""Dense ids and running sums over data that must not meet in one task.

A window without a partition key sorts everything in a single task.  Here rows
are range partitioned, each partition numbers or sums its own rows, and small
per-partition totals give the offsets.  Range boundaries are sampled anew on
each evaluation, so the partitioned rows are staged once in the shared folder
and every later job reads that one copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tabloom.operators.joins import ROWS_PER_TASK, crowded_keys
from tabloom.session import stage

# monotonically_increasing_id keeps the row's position in its task in the low 33 bits.
_POSITION_BITS = 33
_PART, _POS, _OFFSET = "__part", "__pos", "__offset"

# Up to this many rows, one task may sort a whole group.
SMALL_GROUP_ROWS = 1_000_000

# Up to this many rows of a few numbers each, a side is broadcast.
BROADCAST_ROWS = 10_000


def _partition_offsets(totals: DataFrame, groups: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Sum of each total over all earlier partitions (exclusive prefix sum)."""
    earlier = (
        Window.partitionBy(*groups)
        .orderBy(_PART)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return totals.select(
        *groups,
        _PART,
        *(F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{_OFFSET}_{s}") for s in sums),
    )


def dense_row_id(
    df: DataFrame, id_col: str, order_by: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Ids 0..n-1 in the order of ``order_by``, the same for any partitioning.

    Rows with equal keys are ordered by a hash of their other columns, which
    also lets a key shared by very many rows span partitions.  Where such a key
    exists, rows are numbered and stored first, so that even rows equal in every
    column (which may trade places) need not meet in one task; the number is
    stored because one drawn anew on a retry could lose or repeat rows.
    """
    columns = df.columns
    rest = [c for c in columns if c not in set(order_by)]
    order = list(order_by)
    if rest:
        df = df.withColumn("__tie", F.xxhash64(*rest))
        order.append("__tie")
    # The tie-breaker is part of the key: only rows equal in all columns can crowd a partition.
    if not crowded_keys(df, [order], rows_per_task).isEmpty():
        df = stage(df.withColumn("__spread", F.monotonically_increasing_id()), "row-id-input")
        order.append("__spread")
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*columns, F.monotonically_increasing_id().alias("__mid"))
    )
    staged = stage(placed, "row-id").select(
        *columns,
        F.shiftright("__mid", _POSITION_BITS).alias(_PART),
        F.col("__mid").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias(_POS),
    )
    counts = staged.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    # One row per shuffle partition: bounded by configuration, not by the data.
    offsets = F.broadcast(_partition_offsets(counts, [], ["n"]))
    return staged.join(offsets, _PART).select(
        *columns, (F.col(_POS) + F.col(f"{_OFFSET}_n")).alias(id_col)
    )


def stage_in_order(
    df: DataFrame, order_by: Sequence[str], group_by: Sequence[str] = ()
) -> DataFrame:
    """Range-partition by group and order, remember each row's partition, store once.

    ``df`` should already be aggregated to distinct (group, order) rows: equal
    keys cannot be split over partitions.
    """
    ranged = df.repartitionByRange(*group_by, *order_by)
    return stage(ranged.withColumn(_PART, F.spark_partition_id()), "ordered")


def running_sums(
    staged: DataFrame,
    order_by: Sequence[str],
    sums: dict[str, str],
    group_by: Sequence[str] = (),
    small_rows: int = SMALL_GROUP_ROWS,
) -> DataFrame:
    """Add inclusive running sums ``{output: input}`` in ``order_by`` order per group.

    ``staged`` comes from ``stage_in_order`` with the same order and groups.  Up
    to ``small_rows`` rows in all, a plain window per group does.
    """
    groups = list(group_by)
    columns = [c for c in staged.columns if c != _PART]

    def upto(*keys: str) -> WindowSpec:
        window = Window.partitionBy(*keys).orderBy(*order_by)
        return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    if staged.count() <= small_rows:
        return staged.select(
            *columns, *(F.sum(c).over(upto(*groups)).alias(out) for out, c in sums.items())
        )
    inputs = list(dict.fromkeys(sums.values()))
    totals = staged.groupBy(*groups, _PART).agg(*(F.sum(c).alias(c) for c in inputs))
    offsets = _partition_offsets(totals, groups, inputs)
    within = staged.select(
        "*", *(F.sum(c).over(upto(_PART, *groups)).alias(f"__run_{c}") for c in inputs)
    )
    # Groups come from the data and may be null: join on null-safe equality.
    condition = F.col(f"w.{_PART}") == F.col(f"o.{_PART}")
    for g in groups:
        condition = condition & F.col(f"w.{g}").eqNullSafe(F.col(f"o.{g}"))
    joined = within.alias("w").join(offsets.alias("o"), condition)
    return joined.select(
        *(F.col(f"w.{c}") for c in columns),
        *(
            (F.col(f"w.__run_{c}") + F.col(f"o.{_OFFSET}_{c}")).alias(out)
            for out, c in sums.items()
        ),
    )
