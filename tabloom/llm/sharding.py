"""Shards of equal bytes by best-fit-decreasing packing of indivisible groups.

Groups (here: equal texts) go whole into bins of a fixed capacity: largest
first, each into the bin with the tightest remaining capacity that holds it.
The remaining capacities stand in a balanced tree (a treap), so each placement costs
the logarithm of the number of bins.

A corpus has too many groups for one task, so packing runs on levels.  Groups
are dealt by a hash into blocks; each task packs its block into parcels of a
capacity that is a small fraction of a shard; parcels are dealt and packed
again while there are more than ``LAST_ITEMS``; the last level packs the rest, a
bounded number of items, into the shards.  There the capacity is the smallest,
found by bisection, for which best-fit-decreasing needs no more bins than there
are shards.  Groups above a parcel's capacity are few and go directly to the
last level.  A group larger than a whole shard cannot stay whole at that
capacity: its rows are dealt into pieces by a hash of the row, and pieces are
packed like groups.

The law that holds is ``bytes``: shards differ by about a parcel at most, under
1/100 of a shard.  Null and empty texts are groups like others (size 1 a row).
An empty table gives no rows.  Repeated rows lie in one group.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloom.llm.base import free_name, load, partitions_for, query, text_bytes, with_row_id
from tabloom.session import stage, with_code

SHARDS = 8
PARCELS_PER_SHARD = 256
PIECES = 64
BLOCK_ITEMS = 50_000
LAST_ITEMS = 20_000
SLOT_ROWS = 100_000


class Capacities:
    """Remaining capacities of bins as a treap ordered by (capacity, bin)."""

    def __init__(self, seed: int = 11):
        self._root: list | None = None
        self._random = random.Random(seed)

    # A node is [key, priority, left, right].
    def _split(self, node, key):
        """Nodes below ``key``, and the rest."""
        low = high = None
        low_end = high_end = None
        while node is not None:
            if node[0] < key:
                if low_end is None:
                    low = node
                else:
                    low_end[3] = node
                low_end, node = node, node[3]
            else:
                if high_end is None:
                    high = node
                else:
                    high_end[2] = node
                high_end, node = node, node[2]
        if low_end is not None:
            low_end[3] = None
        if high_end is not None:
            high_end[2] = None
        return low, high

    def _merge(self, low, high):
        top = [None, 0, None, None]
        end, side = top, 3
        while low is not None and high is not None:
            if low[1] > high[1]:
                end[side] = low
                end, side, low = low, 3, low[3]
            else:
                end[side] = high
                end, side, high = high, 2, high[2]
        end[side] = low if low is not None else high
        return top[3]

    def add(self, room: int, number: int) -> None:
        low, high = self._split(self._root, (room, number))
        node = [(room, number), self._random.random(), None, None]
        self._root = self._merge(self._merge(low, node), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the tightest (room, bin) with room for ``size``."""
        low, high = self._split(self._root, (size, -1))
        if high is None:
            self._root = low
            return None
        up, node = None, high
        while node[2] is not None:
            up, node = node, node[2]
        if up is None:
            high = node[3]
        else:
            up[2] = node[3]
        self._root = self._merge(low, high)
        return node[0]


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each item; None if an item is too large or more than ``most`` bins are needed.

    Ties among items go by position.
    """
    room, bins, placed = Capacities(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        if sizes[i] > capacity:
            return None
        found = room.take(sizes[i])
        if found is None:
            if bins == most:
                return None
            found, bins = (capacity, bins), bins + 1
        placed[i] = found[1]
        room.add(found[0] - sizes[i], found[1])
    return placed


def fill_shards(sizes: list[int], shards: int) -> list[int]:
    """Pack items into at most ``shards`` bins of the smallest capacity that bisection finds."""
    if not sizes:
        return []
    total = sum(sizes)
    low = max(max(sizes), -(-total // shards))
    high, best = low, best_fit_decreasing(sizes, low, shards)
    while best is None:
        high = high + max(1, high // 16)
        best = best_fit_decreasing(sizes, high, shards)
    low -= 1
    while high - low > max(1, total // (shards * 4096)):
        middle = (low + high) // 2
        found = best_fit_decreasing(sizes, middle, shards)
        if found is None:
            low = middle
        else:
            high, best = middle, found
    return best


def _parcels(items: DataFrame, capacity: int, level: int) -> DataFrame:
    """(item, parcel) for (item, size): each block packed by itself."""
    blocks = partitions_for(items.count(), BLOCK_ITEMS)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, block = [], [], []
        for b in batches:
            block += b.column(0).to_pylist()
            ids += b.column(1).to_pylist()
            sizes += b.column(2).to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (block[i], ids[i]))
        at = 0
        while at < len(order):
            end, own = at, block[order[at]]
            while end < len(order) and block[order[end]] == own:
                end += 1
            some = order[at:end]
            placed = best_fit_decreasing([sizes[i] for i in some], capacity)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[i] for i in some], pa.string()),
                    pa.array([f"{level}.{own}.{p}" for p in placed], pa.string()),
                    pa.array([sizes[i] for i in some], pa.int64()),
                ],
                names=["item", "parcel", "size"],
            )
            at = end

    dealt = items.select(
        F.pmod(F.xxhash64(F.lit(level), "item"), F.lit(blocks)).cast("int").alias("block"), "item", "size"
    ).repartition(blocks, "block")
    return stage(with_code(dealt).mapInArrow(pack, "item string, parcel string, size long"), "parcels")


def _to_shards(spark: SparkSession, items: DataFrame, shards: int) -> DataFrame:
    """(item, shard): the last level, over a bounded number of items."""
    rows = items.orderBy("item").collect()
    placed = fill_shards([r["size"] for r in rows], shards)
    pairs = pa.table({"item": pa.array([r["item"] for r in rows], pa.string()), "shard": pa.array(placed, pa.int32())})
    return spark.createDataFrame(pairs)


def pack_groups(items: DataFrame, total: int, shards: int) -> DataFrame:
    """(item, shard) for (item, size), sizes adding up to ``total``."""
    capacity = max(1, total // (shards * PARCELS_PER_SHARD))
    large = items.where(F.col("size") > capacity).select("item", "size")
    rest = items.where(F.col("size") <= capacity).select("item", "size")
    levels = []
    # A block of BLOCK_ITEMS leaves its full parcels, of which there are few, and at most
    # one less than half full, so the number of items falls by a large factor each time.
    while rest.count() > LAST_ITEMS:
        packed = _parcels(rest, capacity, len(levels))
        levels.append(packed)
        rest = packed.groupBy(F.col("parcel").alias("item")).agg(F.sum("size").alias("size"))
    # Fewer than shards * PARCELS_PER_SHARD large items, and at most LAST_ITEMS others.
    placed = _to_shards(items.sparkSession, large.unionByName(rest), shards)
    for packed in reversed(levels):
        inner = packed.join(placed.withColumnRenamed("item", "parcel"), "parcel")
        placed = placed.unionByName(inner.select("item", "shard"))
    return placed


def assign_shards(rows: DataFrame, rid: str, group: str, size: str, shards: int = SHARDS) -> DataFrame:
    """(rid, shard, slot): where each row goes; slots are gapless from 0 in each shard.

    ``rows`` carries a unique number ``rid``, as written down by ``with_row_id``.
    """
    narrow = rows.select(F.col(rid).alias("rid"), F.col(group).alias("g"), F.col(size).alias("size"))
    piece = F.pmod(F.xxhash64("rid"), F.lit(PIECES)).cast("string")
    pieces = stage(
        narrow.groupBy("g", piece.alias("piece")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")),
        "pieces",
    )
    groups = pieces.groupBy("g").agg(F.sum("size").alias("size"))
    n, total = pieces.agg(F.sum("n"), F.sum("size")).first()
    total = int(total or 0)
    # Fewer groups than shards can be larger than one shard.
    over = [r["g"] for r in groups.where(F.col("size") > -(-total // shards)).collect()]
    whole = ~F.col("g").isin(over) if over else F.lit(True)
    items = groups.where(whole).select(F.col("g").alias("item"), "size").unionByName(
        pieces.where(~whole).select(F.concat_ws("#", "g", "piece").alias("item"), "size")
    )
    placed = pack_groups(stage(items, "items"), total, shards)
    item = F.when(whole, F.col("g")).otherwise(F.concat_ws("#", F.col("g"), piece))
    shard_of = stage(
        narrow.select("rid", item.alias("item")).join(placed, "item").select("rid", "shard"), "shards"
    )
    buckets = partitions_for(int(n or 0), SLOT_ROWS)
    dealt = shard_of.withColumn("bucket", F.pmod(F.xxhash64("rid"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    up_to = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "bucket").orderBy("rid")
    return dealt.join(offsets, ["shard", "bucket"]).select(
        F.col("rid").alias(rid), "shard", (F.col("offset") + F.row_number().over(within) - 1).alias("slot")
    )


def _group_of(text: str):
    """Equal texts share a digest; null is a text of its own."""
    return F.coalesce(F.md5(F.col(text)), F.lit("null"))


def shard_documents(docs: DataFrame, text: str = "text", shards: int = SHARDS) -> DataFrame:
    """The rows with their ``shard`` and ``slot`` added (underscores appended on a clash)."""
    names = docs.columns
    rid, group, size = (free_name(names, c) for c in ("rid", "text_digest", "text_size"))
    rows = with_row_id(
        docs.withColumns({group: _group_of(text), size: text_bytes(F.col(text)) + 1}), rid, "texts"
    )
    found = assign_shards(rows, rid, group, size, shards)
    out = {c: free_name(names, c) for c in ("shard", "slot")}
    return rows.join(found.withColumnsRenamed(out), rid).select(
        *(F.col(f"`{c}`") for c in names), *out.values()
    )


@query("op2_shard_packing")
def op2_shard_packing(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    narrow = docs.select(
        "doc_id",
        (text_bytes(F.col("text")) + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        _group_of("text").alias("group"),
    )
    rows = with_row_id(narrow, "rid", "sizes")
    found = assign_shards(rows, "rid", "group", "size")
    return rows.join(found, "rid").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
