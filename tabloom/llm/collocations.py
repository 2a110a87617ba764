"""Collocations: frequent phrases whose words stand together more often than by chance.

Texts are cut at punctuation and line ends into pieces, pieces into words; ``A``-``Z`` are
lower-cased; everything is counted for each language apart (null: ``und``).  A phrase
of 2 to ``LONGEST`` words is a candidate if it occurs ``LEAST`` times within pieces,
overlaps included.

Counting goes level by level.  Words are counted first, and the texts written down once
as numbers of frequent words, with breaks between pieces and at all other words.  A
phrase can be frequent only if both phrases one word shorter inside it are.  So a level starts
from the frequent phrases of the level before, held in a double-array trie that is broadcast; numpy
walks all places of a text down that trie at once; where the phrases at a place and at the next
have both been accepted, the phrase and the word after it are a state of the new
level.  Each task counts its states (a bincount over them), and Spark adds up the tasks.

Nothing that grows without bound is broadcast or collected.  A trie holds at most
``TRIE_PHRASES`` phrases or so, the words looked up at once are ``VOCABULARY``; beyond that
there are several tries and several vocabularies, each with a pass of its own over the
texts.  The counts are the same, as a phrase stands in exactly one trie.

Cutting a candidate in two gives l and r, the counts of its parts, and the score
floor(1000 * a * n / (l * r)), n being the language's number of words; the lowest-scoring
cut counts, the one after fewest words among equals.  Products are decimals of 38
digits.  A candidate goes if a longer one with the same count holds it (the counts can
but fall, so the next longer ones tell).  The first ``TOP`` by score, count and bytes are
the report of a language.

Null and empty texts have no words.  Long texts are worked off in slices cut at breaks between words.
Repeated rows count each.  An empty table gives an empty report.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.base import load, partitions_for, query
from tabloom.llm.tries import DoubleArray
from tabloom.operators.ordering import dense_row_id
from tabloom.session import stage, with_code

LEAST = 100
LONGEST = 5
TOP = 2000

TRIE_PHRASES = 400_000
VOCABULARY = 1_000_000
# Texts are worked off in slices of so many bytes, numbers in slices of so many places.
SLICE_BYTES = 1 << 19
SLICE_PLACES = 1 << 19
# Rows of a batch that goes back to Spark.
BATCH_ROWS = 1 << 15
# So many different words are counted by a task before it passes them on.
KEPT_WORDS = 100_000

BREAK = -1
_PLAIN = bytes(
    10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c in b" \t" else c + 32 if 65 <= c <= 90 else c for c in range(256)
)


def words_and_breaks(text: str) -> list[bytes]:
    """The words of a text, and a line end at each break between pieces."""
    return list(filter(None, text.encode().translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")))


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, words and breaks) of (lang, text) rows, texts of a language together."""
    waiting: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()
    for lang, text in zip(batch.column(0), batch.column(1), strict=True):
        lang, text = lang.as_py(), text.as_py()
        if not text:
            continue
        words = waiting.setdefault(lang, [])
        words += words_and_breaks(text)
        words.append(b"\n")
        sizes[lang] += len(text)
        if sizes[lang] >= SLICE_BYTES:
            yield lang, waiting.pop(lang)
            sizes[lang] = 0
    yield from waiting.items()


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for begin in range(0, batch.num_rows, BATCH_ROWS):
        yield batch.slice(begin, BATCH_ROWS)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of (lang, text) rows; a null word has the number of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, words in _slices(batch):
                counts.setdefault(lang, Counter()).update(words)
                if sum(map(len, counts.values())) > KEPT_WORDS:
                    yield from found(counts)
                    counts = {}
        yield from found(counts)

    def found(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, own in counts.items():
            own.pop(b"\n", None)
            words = [None, *own]
            n = [sum(own.values()), *own.values()]
            yield from _pieces(pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int64())],
                names=["lang", "word", "n"],
            ))

    partial = with_code(docs).mapInArrow(count, "lang string, word string, n long")
    return partial.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Numbers of words, for each language."""

    def __init__(self, known: pa.Table):
        self._words = {}
        for lang in pc.unique(known["lang"]).to_pylist():
            own = known.filter(pc.equal(known["lang"], lang))
            self._words[lang] = own["word"].combine_chunks(), own["id"].to_numpy()

    def numbers(self, lang: str, words: pa.Array) -> np.ndarray:
        """The number of each word, ``BREAK`` for words that are not known."""
        if lang not in self._words or not len(words):
            return np.full(len(words), BREAK, np.int64)
        known, ids = self._words[lang]
        at = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy()
        return np.where(at >= 0, ids[at], BREAK)


def _renumbered(vocabulary: Vocabulary, lang: str, numbers: np.ndarray, rest: pa.Array, last: bool) -> tuple[np.ndarray, pa.Array]:
    """Put numbers to the words in ``rest``, which ``numbers`` below ``BREAK`` point at.

    What is not found stays in ``rest``; in the last vocabulary it becomes a break.
    """
    found = vocabulary.numbers(lang, rest)
    missing = np.flatnonzero(found == BREAK)
    if not last:
        found[missing] = -2 - np.arange(len(missing))
    open_ = numbers < BREAK
    numbers = numbers.copy()
    numbers[open_] = found[-2 - numbers[open_]]
    if last:  # several breaks are one
        numbers = numbers[(numbers != BREAK) | np.concatenate(([True], numbers[:-1] != BREAK))] if len(numbers) else numbers
        return numbers, rest.slice(0, 0)
    return numbers, rest.take(pa.array(missing))


def _numbered(docs: DataFrame, vocabularies: list) -> DataFrame:
    """(lang, numbers, rest): slices of texts as numbers of words and breaks, 4 bytes each."""
    kind = "lang string, numbers binary, rest array<string>"

    def row(lang: str, numbers: np.ndarray, rest: pa.Array) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array([0, len(rest)], pa.int32()), rest.cast(pa.string()))
        return pa.RecordBatch.from_arrays(
            [pa.array([lang], pa.string()), pa.array([numbers.astype(np.int32).tobytes()], pa.binary()), lists],
            names=["lang", "numbers", "rest"],
        )

    def first(known, last: bool):
        def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary = Vocabulary(known.value)
            for batch in batches:
                for lang, words in _slices(batch):
                    coded = pa.array(words, pa.string()).dictionary_encode()
                    at = coded.indices.to_numpy().astype(np.int64)
                    is_break = pc.equal(coded.dictionary, "\n").to_numpy(zero_copy_only=False)
                    numbers = np.where(is_break[at], BREAK, -2 - at)
                    yield row(lang, *_renumbered(vocabulary, lang, numbers, coded.dictionary, last))

        return number

    def later(known, last: bool):
        def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary = Vocabulary(known.value)
            for batch in batches:
                for lang, numbers, rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    numbers = np.frombuffer(numbers, np.int32).astype(np.int64)
                    yield row(lang, *_renumbered(vocabulary, lang, numbers, pa.array(rest, pa.string()), last))

        return number

    numbered = docs
    for i, known in enumerate(vocabularies):
        step = (later if i else first)(known, i == len(vocabularies) - 1)
        numbered = stage(with_code(numbered).mapInArrow(step, kind), "numbers")
    return numbered


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The numbers in (numbers) rows, some rows at once, with a break after each row."""
    parts, size = [], 0
    for batch in batches:
        for value in batch.column(0):
            own = np.frombuffer(value.as_buffer(), np.int32)
            parts += [own, np.array([BREAK], np.int32)]
            size += len(own) + 1
            if size >= SLICE_PLACES:
                yield np.concatenate(parts)
                parts, size = [], 0
    if parts:
        yield np.concatenate(parts)


def _states(numbered: DataFrame, trie, length: int, vocabulary: int, whole: bool) -> DataFrame:
    """(state, n): a phrase of the trie and a word after it, as ``phrase * vocabulary + word``.

    ``trie`` is None for single words, which are their own numbers.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = trie.value if trie is not None else None
        for numbers in _places(batches):
            stem = held.walk(numbers) if held is not None else numbers
            n = len(numbers) - length
            accepted = (stem[:n] >= 0) & (numbers[length:] >= 0)
            if whole and length > 1:  # the phrase one place further on
                accepted &= stem[1 : n + 1] >= 0
            at = np.flatnonzero(accepted)
            key = stem[at].astype(np.int64) * vocabulary + numbers[at + length]
            key.sort()
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            n = np.bincount(np.cumsum(first) - 1) if len(key) else np.zeros(0, np.int64)
            yield from _pieces(pa.RecordBatch.from_arrays([pa.array(key[first]), pa.array(n)], names=["state", "n"]))

    return with_code(numbered.select("numbers")).mapInArrow(count, "state long, n long")


def _with_stems(states: DataFrame, stems, vocabulary: int) -> DataFrame:
    """(ids, n): the numbers of the words of each state."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stem, word = np.divmod(batch.column(0).to_numpy(), vocabulary)
            ids = np.hstack([stems.value[stem], word[:, None]]).astype(np.int32)
            flat = pa.array(ids.ravel())
            ends = pa.array(np.arange(0, len(flat) + 1, ids.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, flat), batch.column(1)], names=["ids", "n"])

    return with_code(states).mapInArrow(spell, "ids array<int>, n long")


def frequent_phrases(numbered: DataFrame, vocabulary: int, least: int = LEAST, longest: int = LONGEST, most: int = TRIE_PHRASES) -> DataFrame:
    """(ids, n): phrases of 2 to ``longest`` words that occur ``least`` times."""
    context = numbered.sparkSession.sparkContext
    enough = F.col("n") >= least

    def summed(states: DataFrame) -> DataFrame:
        return states.groupBy("state").agg(F.sum("n").alias("n")).where(enough)

    pairs = summed(_states(numbered, None, 1, vocabulary, True))
    v = F.lit(vocabulary).cast("long")
    ids = F.array(F.expr(f"state div {vocabulary}"), F.col("state") % v).cast("array<int>")
    levels = [stage(pairs.select(ids.alias("ids"), "n"), "phrases")]
    for length in range(2, longest):
        held = levels[-1]
        # Phrases are dealt by a hash: half of the limit each on average.
        count = held.count()
        if not count:
            break
        tries = partitions_for(count, most if count <= most else max(1, most // 2))
        parts = []
        for i in range(tries):
            own = held.where(F.pmod(F.xxhash64("ids"), F.lit(tries)) == i).select("ids").toArrow()["ids"].combine_chunks()
            if not len(own):
                continue
            trie = DoubleArray(own.flatten().to_numpy().reshape(len(own), length))
            states = summed(_states(numbered, context.broadcast(trie), length, vocabulary, tries == 1))
            parts.append(stage(_with_stems(states, context.broadcast(trie.phrases.astype(np.int32)), vocabulary), "phrases"))
        level = parts[0]
        for part in parts[1:]:
            level = level.unionByName(part)
        levels.append(level)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def _decimal(c: str) -> Column:
    return F.col(c).cast("decimal(19,0)")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, top: int | None = TOP,
                 vocabulary: int = VOCABULARY, trie_phrases: int = TRIE_PHRASES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases; all for None."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    counted = stage(word_counts(rows).where((F.col("n") >= least) | F.col("word").isNull()), "words")
    totals = counted.where("word IS NULL").select(F.col("lang").alias("l_lang"), F.col("n").alias("total"))
    words = counted.where("word IS NOT NULL").withColumn("rarity", -F.col("n"))
    # Frequent words have small numbers, so that most of a text is found in the first vocabulary.
    words = stage(dense_row_id(words, "id", ["rarity", "lang", "word"]).drop("rarity"), "vocabulary")
    size = words.count()
    chunks = [
        context.broadcast(words.where(F.floor(F.col("id") / vocabulary) == i).select("lang", "word", "id").toArrow())
        for i in range(partitions_for(size, vocabulary, 1))
    ]
    numbered = _numbered(rows, chunks)
    phrases = stage(frequent_phrases(numbered, max(size, 1), least, longest, trie_phrases), "phrases")

    # A phrase inside one that is a word longer and as frequent goes.
    m = F.size("ids")
    inside = phrases.where(m > 2).select(
        F.explode(F.array(F.slice("ids", 1, m - 1), F.slice("ids", F.lit(2), m - 1))).alias("ids"), "n"
    )
    kept = phrases.join(inside.distinct(), ["ids", "n"], "left_anti")

    # Every part of a frequent phrase is a frequent phrase or word itself.
    known = words.select("id", "lang", "word", F.col("n").alias("f"))
    if size <= vocabulary:
        known = F.broadcast(known)
    one = known.select("id", "f")
    cuts = kept.select("ids", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), m - 1)).alias("k")).select(
        "ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("first"), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("rest")
    )
    for part, f in (("first", "l"), ("rest", "r")):
        # Single words come from the vocabulary, longer parts from the phrases.
        single, several = cuts.where(F.size(part) == 1), cuts.where(F.size(part) > 1)
        cuts = single.join(one.select("id", F.col("f").alias(f)), F.col(part)[0] == F.col("id")).drop("id").unionByName(
            several.join(phrases.select(F.col("ids").alias(part), F.col("n").alias(f)), part)
        )
    spelled = (
        kept.select("ids", F.posexplode("ids").alias("place", "id"))
        .join(known.select("id", "lang", "word"), "id")
        .groupBy("ids")
        .agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("w"), F.min("lang").alias("lang"))
        .select("ids", "lang", F.array_join("w.word", " ").alias("phrase"))
    )
    # As many rows as languages; their number is small beside the words.
    ready = cuts.join(spelled, "ids").join(totals, F.col("lang") == F.col("l_lang")).drop("l_lang")
    product = (_decimal("a") * _decimal("total")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    scored = ready.withColumns({"up": product, "down": _decimal("l") * _decimal("r")}).withColumn("score", F.expr("up div down"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    lowest = scored.groupBy("ids", "lang", "phrase", "a", "total").agg(best)
    out = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = out.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP12_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces
), totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), starts AS (
  SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
  FROM words, (SELECT unnest(range(1, {LONGEST + 1})) AS m) lengths
), grams AS (
  SELECT lang, w[i:i + m - 1] AS p, count(*) AS f FROM starts GROUP BY ALL HAVING count(*) >= {LEAST}
), cuts AS (
  SELECT g.lang, g.p, g.f, k, l.f AS l, r.f AS r, (1000::HUGEINT * g.f * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM grams WHERE len(p) > 1) g
  JOIN grams l ON l.lang = g.lang AND l.p = g.p[1:k]
  JOIN grams r ON r.lang = g.lang AND r.p = g.p[k + 1:]
  JOIN totals t ON t.lang = g.lang
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), held AS (
  SELECT DISTINCT b.lang, b.p[i:i + m - 1] AS p
  FROM (SELECT *, unnest(range(2, len(p))) AS m FROM grams WHERE len(p) > 2) b,
       LATERAL (SELECT unnest(range(1, len(b.p) - b.m + 2)) AS i) s
  JOIN grams g ON g.lang = b.lang AND g.p = b.p[i:i + m - 1] AND 100 * b.f >= 100 * g.f
), kept AS (
  SELECT l.lang, array_to_string(l.p, ' ') AS phrase, l.f AS a, l.l, l.r, t.n, l.score::BIGINT AS score
  FROM lowest l JOIN totals t USING (lang)
  WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.lang = l.lang AND h.p = l.p)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {TOP}
"""


@query("op12_collocations", OP12_SQL)
def op12_collocations(spark, sf_dir):
    return collocations(load(spark, sf_dir, "documents"))
