"""Product quantisation of integer vectors, with exact assignment by range masks.

Components x become the integers floor(``SCALE`` * x).  Vectors are cut into ``PARTS``
equal parts, each position with a codebook of ``ENTRIES`` entries that starts from the
vectors of the smallest keys and moves to the mean (floored) of its parts for ``ROUNDS``
rounds; entries without parts stay.

The nearest entry of a part is found on bitmasks.  For each dimension the entries'
coordinates are sorted, and each place in that order carries the mask of all entries
before it.  The distance to a guessed entry is the initial radius: no nearer entry, nor
one as near, can lie outside [x - radius, x + radius] in any dimension.  Two lookups in
a dimension's order give the mask of that range, and the AND over all dimensions the
candidates, among which integer distances decide; ties go to the lower index.

A round is one pass over the vectors: tasks add up parts by entry, Spark adds up the tasks,
and the driver gets one row for each entry, whatever the number of vectors.  All sums are
exact, so neither the layout nor lost executors change a code.

Vectors that are null or hold null or non-finite components are dropped.  Vectors of
different lengths have codebooks of their own; a length that is not a multiple of
``PARTS`` is filled up with zeros.  With fewer vectors than ``ENTRIES`` there are
as many entries.  Null keys come last, equal keys by their vectors, so repeated rows fill
several entries and all go to the lowest.  Scaled components beyond 10 ** 50 count
as that; an error above the largest 64-bit integer is given as that one.  An empty table
gives an empty result.  If the input has columns named like the results, the results get an
underscore.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.llm.base import free_name, load, query
from tabloom.session import stage, with_code

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096

CHUNK = 4096
# Below this, squared distances of any length up to 2 ** 11 fit into 64 bits.
_SMALL = 1 << 25
_LARGEST = 10**50
_LONG = (1 << 63) - 1
_LIMB = 10**30
# Equal labels that hold this share of the rows are joined by broadcast; there are 10,000 of them at most.
_HOT_SHARE = 10_000

Codebooks = dict[int, list[np.ndarray]]


def finite(vector: Column) -> Column:
    """Whether a vector is there, with all of its components."""
    plain = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(plain, F.lit(False))


def _whole(x: float) -> int:
    """floor(SCALE * x), also where the product passes the range of a double."""
    scaled = math.floor(SCALE * x) if abs(x) < 1 << 52 else SCALE * int(x)
    return max(-_LARGEST, min(_LARGEST, scaled))


def integer_parts(x: np.ndarray) -> np.ndarray:
    """(rows, PARTS, width) integers of float vectors, filled up with zeros."""
    n, d = x.shape
    if d and n and np.abs(x).max() >= _SMALL / SCALE:
        whole = np.array([_whole(v) for v in x.ravel().tolist()], object).reshape(n, d)
    else:
        whole = np.floor(SCALE * x).astype(np.int64)
    width = -(-d // PARTS)
    padded = np.zeros((n, PARTS * width), whole.dtype)
    padded[:, :d] = whole
    return padded.reshape(n, PARTS, width)


def narrowed(entries: np.ndarray) -> np.ndarray:
    """Python integers as 64-bit ones where all are small."""
    if entries.dtype == object and all(abs(v) < _SMALL for v in entries.ravel()):
        return entries.astype(np.int64)
    return entries


class RangeMasks:
    """A codebook's entries, sorted in each dimension, with the masks of the entries before each place."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        k, d = entries.shape
        order = np.argsort(self.entries, axis=0, kind="stable")
        self.coordinates = np.take_along_axis(self.entries, order, axis=0).T.copy()
        own = np.zeros((k, -(-k // 64)), np.uint64)
        own[np.arange(k), np.arange(k) // 64] = np.uint64(1) << (np.arange(k) % 64).astype(np.uint64)
        self.order, self.before = order.T, np.zeros((d, k + 1, own.shape[1]), np.uint64)
        for j in range(d):
            np.bitwise_or.accumulate(own[order[:, j]], axis=0, out=self.before[j, 1:])
        spread = self.coordinates[:, -1] - self.coordinates[:, 0] if d else np.zeros(0, np.int64)
        # Guesses come from the dimensions that tell entries apart best.
        self.telling = sorted(range(d), key=lambda j: -spread[j])[:3]

    def _squares(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        step = x - self.entries[entry]
        return (step * step).sum(axis=1)

    def radius(self, x: np.ndarray) -> np.ndarray:
        """A bound on the distance to the nearest entry: that to the best of a few guesses, rounded up."""
        least = None
        for j in self.telling:
            line = self.coordinates[j]
            at = np.searchsorted(line, x[:, j])
            low, high = np.maximum(at - 1, 0), np.minimum(at, len(line) - 1)
            near = np.where(x[:, j] - line[low] <= line[high] - x[:, j], low, high)
            found = self._squares(x, self.order[j][near])
            least = found if least is None else np.minimum(least, found)
        if least.dtype == object:
            return np.array([math.isqrt(v) + 1 for v in least], object)
        return np.sqrt(least.astype(np.float64)).astype(np.int64) + 1

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """Masks of the entries within the radius in every dimension."""
        masks = np.broadcast_to(self.before[0, -1], (len(x), self.before.shape[2])).copy()
        r = self.radius(x)
        for j, line in enumerate(self.coordinates):
            begin = np.searchsorted(line, x[:, j] - r, "left")
            end = np.searchsorted(line, x[:, j] + r, "right")
            masks &= self.before[j][end] ^ self.before[j][begin]
        return masks

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row, and its squared distance."""
        n, k = len(x), len(self.entries)
        if not n or not x.shape[1]:
            return np.zeros(n, np.int64), np.zeros(n, np.int64)
        bits = np.unpackbits(self.candidates(x).view(np.uint8), axis=1, bitorder="little")[:, :k]
        row, entry = np.nonzero(bits)
        squares = self._squares(x[row], entry)
        begin = np.searchsorted(row, np.arange(n))
        least = np.minimum.reduceat(squares, begin)
        # The first candidate of a row that is as near as its best one.
        hit = np.flatnonzero(squares == least[row])
        first = hit[np.searchsorted(row[hit], np.arange(n))]
        return entry[first], least


class Codes:
    """The codebooks of vectors of one length, and the sums of what falls to their entries."""

    def __init__(self, entries: list[np.ndarray]):
        self._entries = [narrowed(e) for e in entries]
        self._masks: dict[tuple[int, bool], RangeMasks] = {}

    def _part(self, j: int, wide: bool) -> RangeMasks:
        if (j, wide) not in self._masks:
            entries = self._entries[j]
            self._masks[j, wide] = RangeMasks(entries.astype(object) if wide else entries)
        return self._masks[j, wide]

    def assign(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, PARTS) entries, and their squared distances."""
        found = []
        for j, entries in enumerate(self._entries):
            wide = object in (parts.dtype, entries.dtype)
            found.append(self._part(j, wide).nearest(parts[:, j].astype(object) if wide else parts[:, j]))
        return np.stack([e for e, _ in found], axis=1), np.stack([s for _, s in found], axis=1)

    def sums(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of parts at each entry, and their sums as Python integers."""
        width, k = parts.shape[2], len(self._entries[0])
        counts, sums = np.zeros((PARTS, k), np.int64), np.zeros((PARTS, k, width), object)
        entry, _ = self.assign(parts)
        for j in range(PARTS):
            counts[j] = np.bincount(entry[:, j], minlength=k)
            own = np.zeros((k, width), parts.dtype)
            np.add.at(own, entry[:, j], parts[:, j])
            sums[j] = own
        return counts, sums


def _chunks(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, integer parts) of the vectors in a batch, a bounded number at once."""
    vectors = batch.column(at)
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        for begin in range(0, len(rows), CHUNK):
            own = rows[begin : begin + CHUNK]
            flat = vectors.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            yield d, own, integer_parts(flat.reshape(len(own), d))


def _first_entries(rows: DataFrame, key: str, vector: str, entries: int) -> Codebooks:
    size = F.size(vector)
    first = Window.partitionBy("size").orderBy(F.col("key").asc_nulls_last(), "v")
    held = (
        rows.select(size.alias("size"), F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
        .withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= entries)
        .collect()
    )
    books: Codebooks = {}
    for d in {r["size"] for r in held}:
        own = sorted((r["n"], r["v"]) for r in held if r["size"] == d)
        parts = integer_parts(np.array([v for _, v in own], np.float64).reshape(len(own), d))
        books[d] = [parts[:, j] for j in range(PARTS)]
    return books


def _moved(books: Codebooks, sums: list) -> Codebooks:
    """Each entry at the floored mean of its parts; entries without parts stay."""
    new = {d: [e.astype(object) for e in entries] for d, entries in books.items()}
    for r in sums:
        total = [int(h) * _LIMB + int(low) for h, low in zip(r["high"], r["low"], strict=True)]
        new[r["size"]][r["part"]][r["entry"]] = [t // r["n"] for t in total]
    return {d: [narrowed(e) for e in entries] for d, entries in new.items()}


def _partial_sums(rows: DataFrame, vector: str, books: Codebooks) -> DataFrame:
    """(size, part, entry, n, high, low): what a task adds up, as two limbs of 30 digits."""
    known = rows.sparkSession.sparkContext.broadcast(books)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = {d: Codes(entries) for d, entries in known.value.items()}
        counts: dict[int, np.ndarray] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, parts in _chunks(batch, 0):
                n, own = codes[d].sums(parts)
                counts[d], sums[d] = counts.get(d, 0) + n, sums.get(d, 0) + own
        out = []
        for d, n in counts.items():
            for j, e in zip(*np.nonzero(n), strict=True):
                limbs = [divmod(int(v), _LIMB) for v in sums[d][j, e]]
                out.append({
                    "size": d, "part": int(j), "entry": int(e), "n": int(n[j, e]),
                    "high": [str(h) for h, _ in limbs], "low": [str(low) for _, low in limbs],
                })
        kind = pa.list_(pa.string())
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
            ("size", pa.int32()), ("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("high", kind), ("low", kind),
        ]))

    return with_code(rows.select(vector)).mapInArrow(
        add, "size int, part int, entry int, n long, high array<string>, low array<string>"
    )


def fit_codebooks(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """The codebooks of finite vectors, for each length: an array (entries, width) for each part."""
    books = _first_entries(rows, key, vector, entries)
    for _ in range(rounds):
        at = ["size", "part", "entry"]
        limbs = [F.posexplode(F.arrays_zip("high", "low")).alias("place", "limb")]
        merged = (
            _partial_sums(rows, vector, books)
            .select(*at, "n", *limbs)
            .groupBy(*at, "place")
            .agg(F.sum("n").alias("n"), *[F.sum(F.col(f"limb.{c}").cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
            .groupBy(*at)
            .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", "high", "low"))).alias("s"))
            .select(*at, "n", F.col("s.high").alias("high"), F.col("s.low").alias("low"))
        )
        books = _moved(books, merged.collect())
    return books


def with_codes(rows: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """``rows`` (finite vectors only) with ``code``, two hex digits a part, and ``error``."""
    names = list(rows.columns)
    for name in ("code", "error"):
        names.append(free_name(names, name))
    at, known = rows.columns.index(vector), rows.sparkSession.sparkContext.broadcast(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = {d: Codes(entries) for d, entries in known.value.items()}
        for batch in batches:
            for d, own, parts in _chunks(batch, at):
                entry, squares = codes[d].assign(parts)
                digits = entry.astype(np.uint8).tobytes().hex()
                code = [digits[i : i + 2 * PARTS] for i in range(0, len(digits), 2 * PARTS)]
                error = [min(v, _LONG) for v in squares.sum(axis=1).tolist()]
                part = batch.take(pa.array(own))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(code, pa.string()), pa.array(error, pa.int64())], names=names)

    fields = [T.StructField(names[-2], T.StringType()), T.StructField(names[-1], T.LongType())]
    return with_code(rows).mapInArrow(encode, T.StructType([*rows.schema.fields, *fields]))


def codebook_digest(entries: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, with commas between."""
    return sha256(",".join(str(v) for e in entries for v in e.ravel().tolist()).encode()).hexdigest()


def with_group_sum(rows: DataFrame, by: str, value: str, into: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over equal ``by``, nulls together.

    Sums are combined before they are shuffled.  Groups that hold a ten-thousandth of the
    rows or more meet their sum by broadcast, the others by a shuffle that no group crowds.
    """
    total = F.least(F.sum(F.col(value).cast("decimal(38,0)")), F.lit(_LONG)).cast("long")
    sums = rows.groupBy(F.col(by).alias("__by")).agg(total.alias(into), F.count(F.lit(1)).alias("__n"))
    hot_from = max(1, -(-rows.count() // _HOT_SHARE))
    hot = F.broadcast(sums.where(F.col("__n") >= hot_from).drop("__n"))
    rest = sums.where(F.col("__n") < hot_from).drop("__n")
    same = F.col(by).eqNullSafe(F.col("__by"))
    found = rows.join(hot, same).drop("__by")
    other = rows.join(hot, same, "left_anti").join(rest, same).drop("__by")
    return found.unionByName(other)


@query("op11_product_codes")
def op11_product_codes(spark, sf_dir):
    rows = load(spark, sf_dir, "embeddings").where(finite(F.col("embedding"))).select("vec_id", "embedding", "label")
    books = fit_codebooks(rows)
    coded = with_codes(rows, books).select("vec_id", "code", "error", "label", F.size("embedding").alias("size"))
    scored = with_group_sum(stage(coded, "codes"), "label", "error", "label_error")
    digests = F.create_map(*[F.lit(x) for d, e in books.items() for x in (d, codebook_digest(e))]) if books else F.lit(None)
    return scored.select(
        "vec_id", "code", "error", "label_error",
        (digests[F.col("size")] if books else digests.cast("string")).alias("codebooks_sha256"),
    )
