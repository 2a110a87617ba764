"""Near duplicates by MinHash bands, odd sketches and a check on full shingle sets.

1. Each text becomes its set of five-word shingles, 128 MinHash values, 32 bands
   of four values, and an odd sketch: its MinHash sample (the shingles of smallest
   hash, about 512, or all of a smaller set) folded into 1024 parity bits.  The
   XOR of two sketches never has more bits than the samples differ in, and few
   less where they are similar.  Sets of similarity 0.75 differ in at most a
   seventh of the sum of their sizes; a pair with more bits than that (for sampled
   sets: plus five standard deviations) cannot be linked.
2. Texts with equal sets are one class; everything below works on classes.  Two
   sets of similarity 0.75 miss each other in all bands with probability
   (1 - 0.75^4)^32, about 5 in a million.
3. The weight of a class is the number of classes in all its bands.  The original
   of many copies shares bands with more of them than they do with each other, so
   it weighs most.  Each class is compared with the weightiest and the first class
   of each of its bands; the best of either kind, by sketch, is checked on the
   full sets.  Links found join most groups of copies at once.
4. Bands whose classes still belong to several components are compared in full,
   except within a component: classes outside the band's largest component meet
   all others, in blocks, so no task holds an unbounded band.  The sketches
   filter within the join; the pairs they leave are checked.
5. Components of the confirmed links give the classes their smallest key.

The work of step 4 for one band is the product of what lies outside its largest
component with all of it.  No partner is dropped.

Null, empty and wordless texts have no shingles and are linked with nothing,
not even each other.  Repeated rows fall into one class.  Null keys never name a
component unless it has no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm import shingles as S
from tabloom.llm.base import free_name, load, query, with_row_id
from tabloom.llm.components import connected_components
from tabloom.session import stage, with_code

BLOCK = 2048
LONGS = S.SKETCH_BITS // 64


def fingerprints(rows: DataFrame, rid: str, key: str, text: str) -> DataFrame:
    """(rid, key, n, digest, bands, sketch) of each row; digest and on are null for empty sets."""
    kind = rows.schema[key].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                n, digests, bands, sketches = [], [], [], []
                for t in part.column(2).to_pylist():
                    found = S.shingles(t)
                    n.append(len(found))
                    if not len(found):
                        digests.append(None), bands.append(None), sketches.append(None)
                        continue
                    low = S.samples(found)
                    digests.append(blake2b(found.tobytes(), digest_size=16).digest())
                    bands.append(S.bands(low))
                    sketches.append(S.odd_sketches(found))
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(bands, longs), pa.array(sketches, longs)],
                    names=["rid", "key", "n", "digest", "bands", "sketch"],
                )

    narrow = rows.select(F.col(rid).alias("rid"), F.col(key).alias("key"), F.col(text).alias("text"))
    return with_code(narrow).mapInArrow(
        sign, f"rid long, key {kind}, n long, digest binary, bands array<long>, sketch array<long>"
    )


def _sketch(cid: str, name: str) -> list[Column]:
    """What a comparison needs of one class, under names that end in ``name``."""
    return [F.col("cid").alias(cid), F.col("sketch").alias(f"s{name}"), F.col("n").alias(f"n{name}"), F.col("level").alias(f"l{name}")]


def _differing(percent: int) -> tuple[Column, Column]:
    """Differing bits of two classes at their common level, and the most that a link allows.

    Null where the sizes alone rule a link out.
    """
    level = F.greatest("l_a", "l_b")
    at = {s: F.when(F.col(f"l_{s}") < level, F.lit(LONGS)).otherwise(F.lit(0)) for s in "ab"}
    bits = sum(
        (F.bit_count(F.get(F.col("s_a"), at["a"] + i).bitwiseXOR(F.get(F.col("s_b"), at["b"] + i))) for i in range(LONGS)),
        F.lit(0),
    )
    # |A xor B| <= (1 - t) / (1 + t) * (|A| + |B|) for similarity t.
    mean = (F.col("n_a") + F.col("n_b")) * F.lit((100 - percent) / (100 + percent)) / F.pow(F.lit(2.0), level)
    most = F.when(level == 0, mean).otherwise(mean + 5 * F.sqrt(mean))
    alike = F.abs(F.col("l_a") - F.col("l_b")) <= 1
    sized = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return F.when(alike & sized, bits), most


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts are linked, by their full sets.

    ``texts`` is (rid, text).  Texts of both sides are fetched by shuffled joins;
    a class with many partners is split by the engine's skew handling.
    """
    with_a = pairs.join(texts.select(F.col("rid").alias("a"), F.col("text").alias("ta")), "a")
    both = with_a.join(texts.select(F.col("rid").alias("b"), F.col("text").alias("tb")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                keep = []
                for b, ta, tb in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    if last[0] != b:
                        last = (b, S.shingles(tb))
                    keep.append(S.linked(S.shingles(ta), last[1], percent))
                part = pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"])
                yield part.filter(pa.array(keep, pa.bool_()))

    return with_code(both.select("a", "b", "ta", "tb")).mapInArrow(check, "a long, b long")


def _ends(classes: DataFrame, members: DataFrame, bands: DataFrame, percent: int) -> DataFrame:
    """Each class with its best partner among the weightiest and the first of its bands."""
    bits, most = _differing(percent)
    found = None
    for end in ("heaviest", "first"):
        met = (
            members.select("band", "cid").join(bands, "band")
            .select(F.col("cid").alias("a"), F.col(end).alias("b"))
            .where("a <> b")
            .distinct()
            .join(classes.select(*_sketch("a", "_a")), "a")
            .join(classes.select(*_sketch("b", "_b")), "b")
            .where(bits <= most)
            .select("a", "b", (bits / most).alias("d"))
        )
        best = met.groupBy("a").agg(F.min_by("b", F.struct("d", "b")).alias("b"))
        found = best if found is None else found.unionByName(best)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _crossing(classes: DataFrame, members: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes that share a band, lie in different components, and may be linked."""
    placed = members.select("band", "cid").join(roots.withColumnRenamed("node", "cid"), "cid", "left").select(
        "band", "cid", F.coalesce("root", "cid").alias("root")
    )
    counted = placed.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    open_ = (
        counted.groupBy("band")
        .agg(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("roots"),
            F.max_by("root", F.struct("n", "root")).alias("largest"),
        )
        .where("roots > 1")
        .select("band", "largest", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    rows = placed.join(open_, "band").join(classes.select("cid", "sketch", "n", "level"), "cid")
    rows = stage(rows, "bands")
    right = rows.select(
        "band",
        F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int").alias("block"),
        *_sketch("b", "_b"), F.col("root").alias("rb"),
        (F.col("root") == F.col("largest")).alias("main"),
    )
    left = rows.where("root <> largest").select(
        "band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        *_sketch("a", "_a"), F.col("root").alias("ra"),
    )
    bits, most = _differing(percent)
    near = (
        (F.col("ra") != F.col("rb"))
        & (F.col("main") | (F.col("a") < F.col("b")))
        & (bits <= most)
    )
    met = left.join(right, ["band", "block"]).where(near)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    rows: DataFrame, rid: str, key: str = "doc_id", text: str = "text", percent: int = 75
) -> DataFrame:
    """(rid, key, n_shingles, component_id, keeper): each row's component and the row that stays.

    ``rows`` carries a unique number ``rid`` and must give the same rows each
    time it is read (``with_row_id`` sees to both).  ``component_id`` is the
    smallest key of the component, ``keeper`` the number of the one row that
    stays: that with the smallest key, then number.
    """
    signed = stage(fingerprints(rows, rid, key, text), "fingerprints")
    order = F.struct(F.col("key").isNull().alias("none"), "key", "rid")
    classes = stage(
        signed.where("digest is not null")
        .groupBy("digest")
        .agg(
            F.min("rid").alias("cid"), F.min(order).alias("least"), F.count(F.lit(1)).alias("rows"),
            F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("n").alias("n"),
        )
        .withColumn("level", F.length(F.bin(F.floor((F.col("n") - 1) / S.SKETCH_SAMPLE))) - (F.col("n") <= S.SKETCH_SAMPLE).cast("int")),
        "classes",
    )
    placed = classes.select("cid", F.explode("bands").alias("band"))
    shared = placed.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stage(placed.join(shared, "band"), "members")
    weights = members.groupBy("cid").agg(F.sum("size").alias("weight"))
    ends = members.join(weights, "cid").groupBy("band").agg(
        F.max_by("cid", F.struct("weight", -F.col("cid"))).alias("heaviest"),
        F.min("cid").alias("first"),
    )
    texts = rows.select(F.col(rid).alias("rid"), F.col(text).alias("text"))
    links = stage(confirmed(stage(_ends(classes, members, ends, percent), "ends"), texts, percent), "links")
    roots = stage(connected_components(links), "roots")
    rest = stage(_crossing(classes, members, roots, percent), "crossing")
    more = stage(confirmed(rest, texts, percent), "links")
    if not more.isEmpty():
        roots = stage(connected_components(links.unionByName(more)), "roots")
    linked = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").select(
        "digest", "least", "rows", F.coalesce("root", "cid").alias("root"), F.col("root").isNotNull().alias("linked")
    )
    # Only classes with company need anything looked up.
    least = linked.where("linked").groupBy("root").agg(F.min("least").alias("least"))
    company = (
        linked.where("linked").select("digest", "root").join(least, "root").select("digest", "least")
        .unionByName(linked.where("not linked and rows > 1").select("digest", "least"))
    )
    found = signed.select("rid", "key", "n", "digest").join(company, "digest", "left")
    alone = F.col("least").isNull()
    return found.select(
        F.col("rid"),
        F.col("key"),
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("key")).otherwise(F.col("least.key")).alias("component_id"),
        F.when(alone, F.col("rid")).otherwise(F.col("least.rid")).alias("keeper"),
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near copies; the columns stay as they are."""
    rid = free_name(docs.columns, "rid")
    rows = with_row_id(docs, rid, "texts")
    gone = near_duplicates(rows, rid, key, text).where("rid <> keeper")
    return rows.join(gone.select(F.col("rid").alias(rid)), rid, "left_anti").drop(rid)


@query("op5_near_dedup")
def op5_near_dedup(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(with_row_id(docs, "rid", "texts"), "rid")
    return found.select(
        F.col("key").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
