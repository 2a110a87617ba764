"""Nearest vectors by multi-index hashing of learned binary codes.

Codes of ``BITS`` bits come from rotations learned on a bounded sample
(``SAMPLE_ROWS`` vectors, first by a hash of their id): starting from a random
rotation, signs and rotation are fitted to each other in turns, which keeps the
vectors close to the corners of the cube.  Codes are cut into ``PARTS``
substrings of 16 bits, each with its own index of buckets.  Two codes within
Hamming radius ``PARTS * r + a`` agree within r in one of the first a + 1
substrings or within r - 1 in another, so looking into all buckets that near
finds every code within the radius.  Those are ranked by exact distances in
double precision.  The radius is set on the sample, such that ``TARGET`` of the
true neighbours there lie within it; neighbours in the whole table are nearer.

Every vector is indexed.  Vectors are dealt into blocks by a hash, queries visit
all blocks in chunks (a stated query set against all rows), and a block that has
too few codes within the radius widens it for that query.  Of equal vectors only the
``k + 1`` smallest ids can be among the nearest, so larger ones are cut before the
search by a rank that is limited ahead of its shuffle.

Vectors that are null, empty, zero, or hold null or non-finite components take no
part.  Vectors of different length never meet.  Equal rows count once.  Ties go to
the smaller id.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.base import load, partitions_for, query
from tabloom.session import stage, with_code

BITS = 128
PARTS = 8
SAMPLE_ROWS = 20_000
SAMPLE_QUERIES = 300
TARGET = 0.98
BLOCK_ROWS = 16_384
CHUNK_QUERIES = 4096

_ONES = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def usable(vector: Column) -> Column:
    """Whether a vector can take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Codes:
    """Binary codes of vectors of one length."""

    def __init__(self, mean: np.ndarray, rotation: np.ndarray, radius: int):
        self.mean, self.rotation, self.radius = mean, rotation, radius

    def of(self, x: np.ndarray) -> np.ndarray:
        """(rows, PARTS) substrings of 16 bits."""
        bits = (x - self.mean) @ self.rotation >= 0
        return np.packbits(bits, axis=1).view(np.uint16)


def fit_codes(x: np.ndarray, k: int, seed: int = 5, rounds: int = 15) -> Codes:
    """Rotations, and the radius that holds ``TARGET`` of the sample's own neighbours."""
    rng = np.random.default_rng(seed)
    mean, d = x.mean(axis=0), x.shape[1]
    centred, parts, have = x - mean, [], 0
    while have < BITS:
        width = min(d, BITS - have)
        r = np.linalg.qr(rng.normal(size=(d, d)))[0][:, :width]
        for _ in range(rounds):
            signs = np.where(centred @ r >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(centred.T @ signs, full_matrices=False)
            r = u @ v
        parts.append(r)
        have += width
    codes = Codes(mean, np.hstack(parts), BITS)
    own = codes.of(x)
    asked = rng.permutation(len(x))[:SAMPLE_QUERIES]
    far = []
    for q in asked:
        d2 = ((x - x[q]) ** 2).sum(axis=1)
        d2[q] = np.inf
        near = np.argsort(d2, kind="stable")[: min(k, len(x) - 1)]
        far.append(_ONES[own[near] ^ own[q]].sum(axis=1))
    if far and sum(map(len, far)):
        codes.radius = int(np.quantile(np.concatenate(far), TARGET, method="higher"))
    return codes


@lru_cache(maxsize=4)
def _layout(radius: int) -> tuple[int, ...]:
    """The radius to look within in each substring; -1 for not at all."""
    r, a = divmod(radius, PARTS)
    return tuple(r if j <= a else r - 1 for j in range(PARTS))


class MultiIndex:
    """A bucket directory for each substring of a block of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for j in range(PARTS):
            order = np.argsort(codes[:, j], kind="stable")
            values, begin = np.unique(codes[order, j], return_index=True)
            self.tables.append((order, values, begin, np.append(begin[1:], len(order))))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code lies within the radius."""
        hit = np.zeros(len(self.codes), bool)
        for j, r in enumerate(_layout(radius)):
            if r < 0:
                continue
            order, values, begin, end = self.tables[j]
            near = np.flatnonzero(_ONES[values ^ code[j]] <= r)
            sizes = end[near] - begin[near]
            at = np.repeat(begin[near] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            hit[order[at]] = True
        found = np.flatnonzero(hit)
        return found[_ONES[self.codes[found] ^ code].sum(axis=1, dtype=np.int64) <= radius]


def search_block(model: Codes, ids, vectors, query_ids, queries, k: int) -> pd.DataFrame:
    """The k nearest of a block to each query."""
    index, asked = MultiIndex(model.of(vectors)), model.of(queries)
    out_q, out_v, out_s = [], [], []
    for i, q in enumerate(query_ids):
        radius = model.radius
        while True:
            found = index.within(asked[i], radius)
            found = found[ids[found] != q]
            if len(found) >= k or radius >= BITS:
                break
            radius = min(BITS, radius + PARTS)
        distance = np.sqrt(((vectors[found] - queries[i]) ** 2).sum(axis=1))
        best = np.lexsort((ids[found], distance))[:k]
        out_q += [i] * len(best)
        out_v.append(ids[found[best]])
        out_s.append(distance[best])
    return pd.DataFrame({
        "q": np.array(out_q, np.int64),
        "vec_id": np.concatenate(out_v) if out_v else np.zeros(0, np.int64),
        "score": np.concatenate(out_s) if out_s else np.zeros(0),
    })


def nearest(rows: DataFrame, asked: Callable[[Column], Column], k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each row whose key ``asked`` accepts."""
    spark = rows.sparkSession
    clean = (
        rows.where(usable(F.col(vector)) & F.col(key).isNotNull())
        .select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        .withColumn("digest", F.md5(F.array_join("v", ",")))
        .groupBy("id", "digest")
        .agg(F.first("v").alias("v"))
    )
    clean = stage(clean.withColumn("size", F.size("v")), "vectors")
    first = Window.partitionBy("digest").orderBy("id")
    held = stage(clean.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).drop("n"), "held")
    # A bounded sample for the fit alone.
    sample = held.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("size", "v").toPandas()
    models = {int(d): fit_codes(np.vstack(g["v"].to_numpy()), k) for d, g in sample.groupby("size")}
    known = spark.sparkContext.broadcast(models)
    n = clean.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(asked(F.col("id")), F.lit(False))).alias("queries"))
    totals = n.agg(F.max("n"), F.max("queries")).first()
    blocks = partitions_for(int(totals[0] or 0), BLOCK_ROWS)
    chunks = partitions_for(int(totals[1] or 0), CHUNK_QUERIES)

    def spread(df: DataFrame, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(own_n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1)))
        ).select("size", "block", "chunk", "id", "v")

    left = spread(held, "block", blocks, "chunk", chunks)
    right = spread(clean.where(F.coalesce(asked(F.col("id")), F.lit(False))), "chunk", chunks, "block", blocks).withColumnsRenamed(
        {"id": "qid", "v": "qv"}
    )

    def search(keys, ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if ours.empty or theirs.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x, y = np.vstack(ours["v"].to_numpy()), np.vstack(theirs["qv"].to_numpy())
        d = x.shape[1]
        model = known.value.get(d) or fit_codes(x, k)
        qids = theirs["qid"].to_numpy()
        found = search_block(model, ours["id"].to_numpy(), x, qids, y, k)
        return pd.DataFrame({"query_id": qids[found["q"].to_numpy()], "vec_id": found["vec_id"], "score": found["score"]})

    keys = ["size", "block", "chunk"]
    found = with_code(left).groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        search, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


@query("op9_nearest_vectors")
def op9_nearest_vectors(spark, sf_dir):
    return nearest(load(spark, sf_dir, "embeddings"), lambda key: key % 100 == 0)
