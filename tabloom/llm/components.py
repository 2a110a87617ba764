"""Connected components of a graph held as a frame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.session import stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges``.

    Alternates two steps until nothing changes: every node sends its larger
    neighbours to its smallest one, then its smaller neighbours.  The number of
    rounds grows with the logarithm of the longest path.  Minima are combined
    before they are shuffled, so a node with very many neighbours is no burden,
    and each round is written down, so lost executors cost one round.
    """
    pairs = edges.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).where("u <> v").distinct()
    pairs = stage(pairs, "components")
    before = None
    while True:
        # Larger neighbours to the smallest of the neighbourhood.
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Then, among what lies below each node, the rest to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.*")
        pairs = stage(small.where("u <> v").distinct(), "components")
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = pairs.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    own = roots.select(F.col("root").alias("node"), "root").distinct()
    return roots.unionByName(own)
