"""Byte-level BPE: encoding by replaying merges over the words of a corpus, and decoding.

Texts are cut into words by the tokenizer's pattern.  A word's tokens depend on the
word alone, so the corpus is worked off in slices of whole texts wherever they lie:
nothing is shuffled, and no dictionary that grows with the corpus is gathered.  The
distinct words of a slice that are not known yet stand side by side as one chain of
symbols.  An inverted index leads from the rank of a pair of neighbours to the places
where it stands; ranks are taken from the smallest up, every place of a rank is merged,
and only the pairs with the two touched neighbours are looked up and indexed anew.
Should a merge make a pair of lower rank, that one comes first, as it would in its word.

A word that is a token as a whole is that token, whether merges lead there or not.
Strings of special tokens are ordinary text.  Null and empty texts have no tokens.
Texts of any length are whole; a very long word is one chain.  Repeated rows get the
same tokens each, an empty table gives an empty one.  If the input has a column of the
result's name already, the new one gets an underscore.  In decoding, a null list and
an empty one give no bytes; null and unknown ids in a list are an error.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.llm.base import free_name, load, query
from tabloom.session import with_code

# Texts are taken in slices of so many characters (a longer text is a slice by itself).
SLICE_CHARS = 1 << 22
# So many words are remembered by a task from slice to slice.
KEPT_WORDS = 300_000
# The lowest ranks stand in very many places; they are merged by numpy, the others one by one.
FREQUENT = 3000

# Letters and numbers that Unicode has added since version 16.  The tables of the
# tiktoken library end there, so they are signs like any other in its pattern.
LATE = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD),
    (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959),
    (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9),
    (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
)
_LATE_CLASS = "[" + "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in LATE) + "]"


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file (base64 of the bytes, and the rank) with their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Words:
    """Cuts texts into words by a tokenizer's pattern, with its library's letters and numbers."""

    def __init__(self, pattern: str):
        self._plain = regex.compile(pattern)
        self._late = regex.compile(_LATE_CLASS)
        kinds = {kind: rf"\p{{{kind}}}" for kind in "LN"}
        # In a set of its own a kind loses the late ones; in a negated set they are added back.
        exact = pattern
        for kind in kinds.values():
            exact = regex.sub(rf"(?<!\[\^[^\]]*){regex.escape(kind)}", lambda _, k=kind: f"[{k}--{_LATE_CLASS}]", exact)
        exact = regex.sub(r"\[\^([^\]\[]*)\]", lambda m: f"(?:[^{m[1]}]|{_LATE_CLASS})", exact)
        self._exact = regex.compile(exact, regex.V1)

    def __call__(self, text: str) -> list[str]:
        highest = 0 if text.isascii() else int(np.frombuffer(text.encode("utf-32-le"), np.uint32).max())
        late = highest >= LATE[0][0] and self._late.search(text)
        return (self._exact if late else self._plain).findall(text)


class MergeReplay:
    """Encodes words by the ranks of a vocabulary that holds all single bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1

    @cached_property
    def tokens(self) -> dict[int, bytes]:
        return {rank: token for token, rank in self.ranks.items()}

    @cached_property
    def _bytes(self) -> np.ndarray:
        return np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)

    @cached_property
    def _byte_pairs(self) -> np.ndarray:
        """The rank of each pair of bytes, -1 for none."""
        return np.array([self.ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)], np.int64)

    @cached_property
    def _pairs(self) -> dict[int, int]:
        """The rank of each pair (a, b) of tokens that make a token, by a * size + b."""
        ranks = self.ranks
        return {
            ranks[token[:k]] * self.size + ranks[token[k:]]: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The tokens of each of some non-empty words, as 32-bit integers."""
        whole = [self.ranks.get(w) for w in words]
        rest = iter(self._replay([w for w, t in zip(words, whole, strict=True) if t is None]))
        return [next(rest) if t is None else t.to_bytes(4, sys.byteorder) for t in whole]

    def _replay(self, words: list[bytes]) -> list[bytes]:
        if not words:
            return []
        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        begins = np.concatenate(([0], ends[:-1]))
        after = np.arange(1, len(flat) + 1)
        after[ends - 1] = -1
        before = np.arange(-1, len(flat) - 1)
        before[begins] = -1
        pair = np.full(len(flat), -1, np.int64)
        pair[:-1] = self._byte_pairs[flat[:-1].astype(np.int64) * 256 + flat[1:]]
        pair[ends - 1] = -1
        # The index: where the pairs of each rank stand.
        index: list[list] = [[] for _ in range(self.size)]
        self._enter(index, pair, np.arange(len(flat)))
        symbol, gone = self._bytes[flat], np.zeros(len(flat), np.uint8)
        self._merge_frequent(index, symbol, after, before, pair, gone)
        lists = [np.concatenate(places).tolist() if places else places for places in index]
        symbol, gone = symbol.tolist(), bytearray(gone.tobytes())
        self._merge(lists, symbol, after.tolist(), before.tolist(), pair.tolist(), gone)
        stays = np.frombuffer(gone, np.uint8) == 0
        tokens = np.array(symbol, np.int32)[stays].tobytes()
        edges = [0, *(4 * np.cumsum(np.add.reduceat(stays, begins, dtype=np.int64))).tolist()]
        return [tokens[i:j] for i, j in zip(edges, edges[1:], strict=False)]

    @cached_property
    def _sorted_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.array(sorted(self._pairs), np.int64)
        return keys, np.array([self._pairs[k] for k in keys.tolist()], np.int64)

    def _ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens, -1 for none."""
        keys, ranks = self._sorted_pairs
        key = a * self.size + b
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, ranks[at], -1)

    @staticmethod
    def _enter(index: list[list], ranks: np.ndarray, places: np.ndarray) -> None:
        ranks, places = ranks[ranks >= 0], places[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        found, first = np.unique(ranks[order], return_index=True)
        ends = [*first[1:].tolist(), len(order)]
        for rank, i, j in zip(found.tolist(), first.tolist(), ends, strict=False):
            index[rank].append(places[order[i:j]])

    def _merge_frequent(self, index: list[list], symbol, after, before, pair, gone) -> None:
        """Apply the first ``FREQUENT`` merges, which have most places, to all places at once.

        Stops early at a rank whose merges would make a pair of lower rank.
        """
        for rank in range(min(FREQUENT, self.size)):
            if not index[rank]:
                continue
            at = np.sort(np.concatenate(index[rank]))
            at = at[pair[at] == rank]
            # Of pairs that overlap in a row every second one is merged.
            overlaps = np.concatenate(([False], after[at[:-1]] == at[1:])) if len(at) else np.zeros(0, bool)
            if overlaps.any():
                place = np.arange(len(at))
                at = at[(place - np.maximum.accumulate(np.where(overlaps, 0, place))) % 2 == 0]
            other = after[at]
            right, left = after[other], before[at]
            r, l = right >= 0, left >= 0
            token = np.full(len(at), rank)
            # Pairs that stand for a moment while a word is merged from left to right count too.
            passing = np.concatenate([
                self._ranks_of(token[r], symbol[right[r]]), self._ranks_of(symbol[left[l]], token[l])
            ])
            if ((passing >= 0) & (passing < rank)).any():
                index[rank] = [at]
                return
            symbol[at], after[at], gone[other], pair[other], pair[at] = rank, right, 1, -1, -1
            before[right[r]] = at[r]
            # A neighbour may have been merged as well, so pairs are looked up only now.
            places = np.concatenate([at[r], before[at[before[at] >= 0]]])
            places = np.unique(places)
            new = self._ranks_of(symbol[places], symbol[after[places]])
            pair[places] = new
            index[rank] = []
            if ((new >= 0) & (new < rank)).any():
                self._enter(index, new, places)
                return
            self._enter(index, new, places)

    def _merge(self, index: list[list[int]], symbol: list, after: list, before: list, pair: list, gone: bytearray) -> None:
        """Apply every merge in the order of ranks, on chains linked by ``after`` and ``before``."""
        size, known = self.size, self._pairs.get
        rank = 0
        while rank < size:
            places = index[rank]
            if not places:
                rank += 1
                continue
            index[rank] = []
            places.sort()  # from left to right, as pairs may overlap
            least, own = rank, rank * size
            for k, at in enumerate(places):
                if pair[at] != rank:  # taken by another merge meanwhile
                    continue
                other = after[at]
                right, left = after[other], before[at]
                symbol[at], after[at], gone[other], pair[other] = rank, right, 1, -1
                new = -1
                if right >= 0:
                    before[right] = at
                    new = known(own + symbol[right], -1)
                    if new >= 0:
                        index[new].append(at)
                        if new < least:
                            least = new
                pair[at] = new
                if left >= 0:
                    new = pair[left] = known(symbol[left] * size + rank, -1)
                    if new >= 0:
                        index[new].append(left)
                        if new < least:
                            least = new
                if least < rank:
                    # A word now holds a pair of lower rank, which comes before the rest.
                    index[rank] = places[k + 1 :]
                    break
            rank = least if least < rank else rank + 1


def slices(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs [begin, end) of rows with at most ``most`` in all, or of one row that is larger."""
    begin, total = 0, 0
    for i, n in enumerate(lengths):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if lengths:
        yield begin, len(lengths)


def _with_column(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def encode_texts(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with the token ids of each text."""
    into, at = free_name(df.columns, into), df.columns.index(text)
    names = [*df.columns, into]
    known = df.sparkSession.sparkContext.broadcast(ranks)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, cut, kept = MergeReplay(known.value), Words(pattern), {}
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for begin, end in slices([len(t or "") for t in texts], SLICE_CHARS):
                words = [cut(t) if t else [] for t in texts[begin:end]]
                new = [w for w in set(chain.from_iterable(words)) if w not in kept]
                if len(kept) + len(new) > KEPT_WORDS:
                    kept.clear()
                    new = list(set(chain.from_iterable(words)))
                kept.update(zip(new, replay.encode([w.encode() for w in new]), strict=True))
                found = [b"".join(map(kept.__getitem__, w)) for w in words]
                ends = pa.array(np.cumsum([0, *map(len, found)]) // 4, pa.int32())
                ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(found), np.int32)))
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=names)

    return with_code(df).mapInArrow(encode, _with_column(df, into, T.ArrayType(T.IntegerType())))


def decode_ids(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its token ids stand for."""
    into, at = free_name(df.columns, into), df.columns.index(ids)
    names = [*df.columns, into]
    known = df.sparkSession.sparkContext.broadcast(ranks)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = MergeReplay(known.value).tokens
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                own = part.column(at)
                flat = own.flatten().to_numpy(zero_copy_only=False).tolist()
                ends = np.cumsum([0, *own.value_lengths().fill_null(0).to_pylist()]).tolist()
                texts = [b"".join(map(tokens.__getitem__, flat[i:j])) for i, j in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=names)

    return with_code(df).mapInArrow(decode, _with_column(df, into, T.BinaryType()))


@query("op13_byte_bpe")
def op13_byte_bpe(spark, sf_dir):
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_texts(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "ids")
    return decode_ids(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
