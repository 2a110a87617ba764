"""Benchmark passages in documents, also with other numbers, names or units.

Texts become sequences of tokens: words and numbers, and single characters of
scripts without spaces.  In canonical form they are words in lower case, numbers as
``#n``, capitalised words that do not begin a sentence as ``#p`` (names), and
unit words right after a number as ``#u``.  Windows of ``WINDOW`` canonical
tokens with at least ``LITERALS`` plain words are hashed, and those of documents
are joined with those of the benchmark.  Two more forms find what this one cannot:

* plain words in lower case, for windows with fewer plain words and for windows with names, which a
  copy without capitals would break; items shorter than a window are one window as a whole;
* ``#p`` for capitalised words that begin a sentence as well, for items in which such words occur
  again, never without their capital, and so often that no run of tokens between them is long enough
  to count.

Documents are taken in a form only if the benchmark has windows that need it.  Matches of one item
on one diagonal (place in the document less place in the item) are one occurrence; its coverage
is the number of item tokens inside matched windows.

An occurrence counts if it covers ``LONG_RUN`` tokens, or half of the item, and
its slots are consistent: every value of the item that stands in a slot (the
number 12, say) is replaced by one and the same value of the document wherever it
recurs.  Windows that match by chance fill slots with whatever stands there.
A run of ``LONG_RUN`` item tokens (or the whole item) that stands there literally, in any
case of letters, counts whatever the slots hold elsewhere.

All steps are column expressions; the item side of the join is broadcast by the
engine if its size allows and shuffled otherwise.

Null and empty texts hold nothing.  Items with fewer than ``SHORTEST`` tokens cannot be told from
chance and never match.  Texts of any length are taken whole.  Repeated rows and items are
each judged by themselves.  An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.base import free_name, load, query, with_row_id
from tabloom.session import stage

WINDOW = 8
LITERALS = 4
SHORTEST = 4
LONG_RUN = 13

# Unit words.
UNITS = (
    "kg g mg lb lbs oz t tons km m cm mm mi miles mile feet foot ft inch inches yards l ml litres "
    "liters gallons h hr hrs hour hours min mins minute minutes s sec secs second seconds day days week "
    "weeks month months year years percent dollars dollar cents euros euro pounds pound degrees kmh mph"
).split()

MARK = "¶"
_SENTENCE = "[.!?]+[ \n\t\r]+|\n+"
_TOKEN = f"{MARK}?[\\p{{L}}\\p{{N}}]+([.,][0-9]+)*"
_NUMBER = "^[0-9]+([.,][0-9]+)*$"
_NAME = "^\\p{Lu}"
# Scripts written without spaces; each of their characters is a token.
_SCRIPTS = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")


def raw_tokens(text: Column) -> Column:
    """Words of a text; those that begin a sentence keep a mark in front."""
    single = "([" + "".join(f"\\p{{Is{s}}}" for s in _SCRIPTS) + "])"
    apart = F.when(F.octet_length(text) == F.char_length(text), text).otherwise(F.regexp_replace(text, single, " $1 "))
    marked = F.regexp_replace(F.concat(F.lit("\n"), apart), _SENTENCE, f" {MARK}")
    return F.coalesce(F.regexp_extract_all(marked, F.lit(_TOKEN), F.lit(0)), F.array().cast("array<string>"))


def canonical(tokens: Column, words: Column | None = None) -> Column:
    """Tokens with numbers, names and units as typed placeholders.

    ``words`` is a column with the tokens in lower case and without marks, if there is one.
    """
    units = F.array(*[F.lit(u) for u in UNITS])

    def word_at(i):
        return _word(F.get(tokens, i)) if words is None else F.get(words, i)

    def digit_first(x):
        return (x < ":") & (x >= "0")

    def one(x, i):
        # Patterns are tried only where the first sign, or a change by lower-casing, allows.
        word, before = word_at(i), word_at(i - 1)
        after_number = digit_first(before) & before.rlike(_NUMBER)
        return (
            F.when(digit_first(word) & word.rlike(_NUMBER), F.lit("#n"))
            .when(after_number & F.array_contains(units, word), F.lit("#u"))
            .when((word != x) & x.rlike(_NAME), F.lit("#p"))
            .otherwise(word)
        )

    return F.transform(tokens, one)


def _word(x: Column) -> Column:
    # A token has one mark at most.
    return F.lower(F.when(x.startswith(MARK), F.substr(x, F.lit(2))).otherwise(x))


def _forms(raw: Column, words: Column | None = None) -> dict[str, Column]:
    """The tokens in their three forms."""
    canon = canonical(raw, words)

    def named(c, i):
        first = F.get(raw, i)
        begins = (F.substring(first, 1, 1) == MARK) & F.ltrim(first, F.lit(MARK)).rlike(_NAME) & (c.substr(1, 1) != "#")
        return F.when(begins, F.lit("#p")).otherwise(c)

    return {"canon": canon, "plain": F.transform(raw, _word) if words is None else words, "named": F.transform(canon, named)}


def _window(h: str, width: int) -> Column:
    # Elements are taken one by one: a slice would copy the whole array for each window.
    return F.when(F.col("p").isNotNull(), F.xxhash64(*[F.get(F.col(h), F.col("p") + j) for j in range(width)]))


def _starts(h: str, width: int) -> Column:
    n = F.size(h)
    return F.when(n >= width, F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))))


def _spread(df: DataFrame, key: str, text: str, forms: list[str], widths: list[int]) -> DataFrame:
    """(key, p, hash) for every window of ``WINDOW`` tokens in some forms, and of plain words in more widths.

    Places are spread first, so that windows are hashed row by row in compiled code.  The outer
    generators keep the optimizer from testing the arrays before they are taken apart, which would
    compute everything below once more.
    """
    raw = df.select(key, raw_tokens(F.col(text)).alias("raw"))
    raw = raw.select(key, "raw", F.transform("raw", _word).alias("words"))
    made = _forms(F.col("raw"), F.col("words"))
    hashes = raw.select(key, *[F.transform(made[f], lambda x: F.xxhash64(x)).alias(f) for f in made if f in forms or (f == "plain" and widths)])

    def windows(of: list[str], width: int) -> DataFrame:
        spread = hashes.select(key, *of, F.explode_outer(_starts(of[0], width)).alias("p"))
        if len(of) == 1:
            return spread.select(key, "p", _window(of[0], width).alias("hash"))
        each = F.array_distinct(F.array(*[_window(f, width) for f in of]))
        return spread.select(key, "p", F.explode_outer(each).alias("hash"))

    found = windows(forms, WINDOW) if forms else None
    for width in widths:
        found = windows(["plain"], width) if found is None else found.unionByName(windows(["plain"], width))
    return found


def benchmark_windows(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, q, hash, length, form, width) for the windows of the benchmark that documents are asked for."""
    narrow = items.select(F.col(item).alias("item"), F.col(text).alias("text")).where("text is not null")
    raw = narrow.select("item", raw_tokens(F.col("text")).alias("raw"))
    tokens = raw.select("item", "raw", *[c.alias(f) for f, c in _forms(F.col("raw")).items()])
    slots = F.array(*[F.lit(s) for s in ("#n", "#p", "#u")])
    # Words that begin a sentence with a capital, occur twice and never in lower case.
    words = F.transform("raw", lambda x: F.ltrim(x, F.lit(MARK)))
    initial = F.transform(F.filter("raw", lambda x: x.startswith(MARK) & F.ltrim(x, F.lit(MARK)).rlike(_NAME)), lambda x: F.ltrim(x, F.lit(MARK)))
    names = F.filter(initial, lambda x: (F.size(F.filter(words, lambda w: w == x)) > 1) & ~F.array_contains(words, F.lower(x)))
    length = F.size("raw")
    tokens = tokens.withColumns({"length": length, "names": names})
    none = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(state, x):
        named = x.startswith(MARK) & F.array_contains("names", F.ltrim(x, F.lit(MARK)))
        run = F.when(named, F.lit(0)).otherwise(state["run"] + 1)
        return F.struct(run.alias("run"), F.greatest(state["best"], run).alias("best"))

    between = F.aggregate("raw", none, step, lambda state: state["best"])
    enough = F.least(F.lit(LONG_RUN), F.ceil(F.col("length") / 2).cast("int"))
    tokens = tokens.withColumn("has_names", (F.size("names") > 0) & (between < enough))
    starts = F.when(length >= WINDOW, F.sequence(F.lit(0), F.greatest(length - WINDOW, F.lit(0))))
    spread = tokens.select("*", F.explode(starts).alias("q"))
    own = {f: F.slice(f, F.col("q") + 1, WINDOW) for f in ("canon", "plain", "named")}
    count = {f: F.size(F.filter(own[f], lambda x: ~F.array_contains(slots, x))) for f in ("canon", "named")}
    poor = (count["canon"] < LITERALS) | F.array_contains(own["canon"], "#p")
    asked = {"canon": count["canon"] >= LITERALS, "plain": poor, "named": (count["named"] >= LITERALS) & F.col("has_names")}
    hashed = F.array(*[
        F.when(asked[f], F.struct(F.lit(f).alias("form"), F.lit(WINDOW).alias("width"),
                                  F.xxhash64(*[F.xxhash64(own[f][j]) for j in range(WINDOW)]).alias("hash")))
        for f in ("canon", "plain", "named")
    ])
    windows = spread.select("item", "q", "length", F.explode(F.filter(hashed, lambda x: x.isNotNull())).alias("w")).select("item", "q", "length", "w.*")
    for width in range(SHORTEST, WINDOW):
        short = tokens.where(F.col("length") == width).select(
            "item", F.lit(0).alias("q"), "length", F.lit("whole").alias("form"), F.lit(width).alias("width"),
            F.xxhash64(*[F.xxhash64(F.col("plain")[j]) for j in range(width)]).alias("hash"),
        )
        windows = windows.unionByName(short)
    longest = windows.groupBy("item").agg(F.max("length").alias("length"))
    return windows.drop("length").distinct().join(longest, "item")


def _literal_run() -> Column:
    """The longest run of ``item_words`` that stands literally in ``tokens`` on the ``diagonal``."""
    none = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(state, q):
        place = (q + F.col("diagonal")).cast("int")
        ours = F.when(place >= 0, F.lower(F.translate(F.get("tokens", place), MARK, "")))
        run = F.when(ours == F.get("item_words", q), state["run"] + 1).otherwise(0)
        return F.struct(run.alias("run"), F.greatest(state["best"], run).alias("best"))

    places = F.sequence(F.lit(0), F.size("item_words") - 1)
    return F.aggregate(places, none, step, lambda state: state["best"])


def occurrences(
    rows: DataFrame, items: DataFrame, rid: str, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(rid, item, diagonal, covered, length, consistent) for each occurrence that is long enough.

    ``rows`` carries a unique number ``rid``, as written down by ``with_row_id``.
    """
    bench = stage(benchmark_windows(items, item, item_text), "benchmark")
    docs = rows.select(F.col(rid).alias("rid"), F.col(text).alias("text")).where("text is not null")
    needed = {(r["form"], r["width"]) for r in bench.select("form", "width").distinct().collect()}
    forms = [f for f in ("canon", "plain", "named") if (f, WINDOW) in needed] or ["canon"]
    spread = _spread(docs, "rid", "text", forms, sorted(w for f, w in needed if f == "whole"))
    met = (
        spread.join(bench.select("item", "q", "hash", "width", "length").distinct(), "hash")
        .groupBy("rid", "item", (F.col("p") - F.col("q")).alias("diagonal"), "length")
        # At most one place for each token of the item.
        .agg(F.sort_array(F.collect_set(F.struct("q", "width"))).alias("qs"))
    )
    covered = F.array_distinct(
        F.flatten(F.transform("qs", lambda m: F.sequence(m["q"], m["q"] + m["width"] - 1)))
    )
    long_enough = (F.size("at") >= LONG_RUN) | (2 * F.size("at") >= F.col("length"))
    found = stage(met.withColumn("at", covered).where(long_enough).drop("qs"), "occurrences")
    # Slots need the words themselves, of the texts with occurrences only.
    asked = items.select(F.col(item).alias("item"), F.col(item_text).alias("item_text")).where("item_text is not null")
    asked = asked.select("item", raw_tokens(F.col("item_text")).alias("raw"))
    asked = asked.select("item", "raw", _forms(F.col("raw"))["named"].alias("c")).groupBy("item").agg(
        F.min_by("raw", F.array_join("raw", " ")).alias("raw"), F.min_by("c", F.array_join("raw", " ")).alias("c")
    )
    slotted = found.join(asked, "item").withColumn(
        "slots", F.filter("at", lambda q: F.get("c", q).isin("#n", "#p", "#u"))
    )
    slotted = stage(slotted.where(F.size("slots") > 0).select(
        "rid", "item", "diagonal", "slots",
        F.transform("slots", lambda q: F.lower(F.translate(F.get("raw", q), MARK, ""))).alias("theirs"),
        F.transform("raw", lambda x: F.lower(F.translate(x, MARK, ""))).alias("item_words"),
    ), "slots")
    if slotted.isEmpty():
        return found.select("rid", "item", "diagonal", F.size("at").alias("covered"), "length", F.lit(True).alias("consistent"))
    texts = docs.join(slotted.select("rid").distinct(), "rid", "left_semi")
    own = texts.select("rid", raw_tokens(F.col("text")).alias("tokens"))
    checked = slotted.join(own, "rid").select(
        "rid", "item", "diagonal", "theirs", "item_words", _literal_run().alias("literal"),
        F.transform("slots", lambda q: F.lower(F.translate(F.get("tokens", (q + F.col("diagonal")).cast("int")), MARK, ""))).alias("ours"),
    )
    pairs = F.array_distinct(F.arrays_zip("theirs", "ours"))
    checked = checked.select(
        "rid", "item", "diagonal",
        ((F.size(pairs) == F.size(F.array_distinct("theirs")))
         | (F.col("literal") >= F.least(F.lit(LONG_RUN), F.size("item_words")))).alias("consistent"),
    )
    return found.join(checked, ["rid", "item", "diagonal"], "left").select(
        "rid", "item", "diagonal", F.size("at").alias("covered"), "length",
        F.coalesce("consistent", F.lit(True)).alias("consistent"),
    )


def contaminated(rows: DataFrame, items: DataFrame, rid: str, text: str = "text") -> DataFrame:
    """(rid, items, occurrences, covered) of the rows that hold benchmark passages."""
    return (
        occurrences(rows, items, rid, text)
        .where("consistent")
        .groupBy("rid")
        .agg(
            F.sort_array(F.collect_set("item")).alias("items"),
            F.count(F.lit(1)).alias("occurrences"),
            F.max("covered").alias("covered"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """Rows without benchmark passages; the columns stay as they are."""
    rid = free_name(docs.columns, "rid")
    rows = with_row_id(docs, rid, "texts")
    found = contaminated(rows, items, rid, text).select(F.col("rid").alias(rid))
    return rows.join(found, rid, "left_anti").drop(rid)


_APART = "regexp_replace(text, '([" + "".join(f"\\p{{{s}}}" for s in _SCRIPTS) + "])', ' \\1 ', 'g')"
_MARKED = f"regexp_replace(chr(10) || {_APART}, '[.!?]+[ \\n\\t\\r]+|\\n+', ' ¶', 'g')"
_RAW = f"regexp_extract_all({_MARKED}, '¶?[\\p{{L}}\\p{{N}}]+(?:[.,][0-9]+)*')"


def _tokens_sql(table: str, key: str) -> str:
    units = ", ".join(f"'{u}'" for u in UNITS)
    return f"""
  SELECT *, CASE WHEN c NOT LIKE '#%' AND x LIKE '¶%' AND regexp_matches(bare, '^\\p{{Lu}}') THEN '#p' ELSE c END AS v
  FROM (
  SELECT {key}, place, x, bare, word,
         CASE WHEN regexp_matches(word, '^[0-9]+([.,][0-9]+)*$') THEN '#n'
              WHEN word IN ({units}) AND regexp_matches(lag(word) OVER w, '^[0-9]+([.,][0-9]+)*$') THEN '#u'
              WHEN regexp_matches(x, '^\\p{{Lu}}') THEN '#p'
              ELSE word END AS c
  FROM (SELECT {key}, x, place, replace(x, '¶', '') AS bare, lower(replace(x, '¶', '')) AS word
        FROM (SELECT {key}, unnest({_RAW}) AS x, generate_subscripts({_RAW}, 1) - 1 AS place
              FROM {table} WHERE text IS NOT NULL))
  WINDOW w AS (PARTITION BY {key} ORDER BY place))"""


def _windows_sql(tokens: str, key: str) -> str:
    """(key, place, form, w, slots): all windows in all forms."""

    def ahead(c: str) -> list[str]:
        return [c if j == 0 else f"lead({c}, {j}) OVER w" for j in range(WINDOW)]

    forms = " UNION ALL ".join(
        f"""SELECT {key}, place, '{form}' AS form, {" || ' ' || ".join(ahead(c))} AS w,
                   {" + ".join(f"CAST({x} IN ('#n', '#p', '#u') AS INTEGER)" for x in ahead(c))} AS slots,
                   {" + ".join(f"CAST({x} = '#p' AS INTEGER)" for x in ahead('c'))} AS names,
                   {" + ".join(f"CAST({x} IN ('#n', '#p', '#u') AS INTEGER)" for x in ahead('c'))} AS canon_slots
            FROM {tokens} WINDOW w AS (PARTITION BY {key} ORDER BY place)"""
        for form, c in (("canon", "c"), ("plain", "word"), ("named", "v"))
    )
    return f"SELECT * FROM ({forms}) WHERE w IS NOT NULL"


def _short_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT doc_id, place, {" || ' ' || ".join("word" if j == 0 else f"lead(word, {j}) OVER w" for j in range(n))} AS w
            FROM dt WINDOW w AS (PARTITION BY doc_id ORDER BY place)"""
        for n in range(SHORTEST, WINDOW)
    )


OP7_SQL = f"""
WITH dt AS ({_tokens_sql("documents", "doc_id")}),
bt AS ({_tokens_sql("benchmark", "item_id")}),
ln AS (SELECT item_id, count(*) AS length FROM bt GROUP BY 1),
nw AS (SELECT DISTINCT i.item_id, i.bare FROM bt i
       WHERE i.x LIKE '¶%' AND regexp_matches(i.bare, '^\\p{{Lu}}')
         AND (SELECT count(*) FROM bt o WHERE o.item_id = i.item_id AND o.bare = i.bare) > 1
         AND NOT EXISTS (SELECT 1 FROM bt o WHERE o.item_id = i.item_id AND o.bare = lower(i.bare))),
tn AS (SELECT b.item_id, b.place, b.x LIKE '¶%' AND nw.bare IS NOT NULL AS named FROM bt b LEFT JOIN nw USING (item_id, bare)),
bn AS (SELECT item_id, part, count(*) FILTER (NOT named) AS run
       FROM (SELECT *, sum(CAST(named AS INTEGER)) OVER (PARTITION BY item_id ORDER BY place) AS part FROM tn) GROUP BY 1, 2),
nm AS (SELECT item_id FROM bn JOIN ln USING (item_id) WHERE item_id IN (SELECT item_id FROM nw)
       GROUP BY item_id HAVING max(run) < max(least({LONG_RUN}, ceil(length / 2.0)))),
bw AS (SELECT item_id, place, w, {WINDOW} AS width, form FROM ({_windows_sql("bt", "item_id")})
       WHERE (form = 'canon' AND slots <= {WINDOW - LITERALS})
          OR (form = 'plain' AND (canon_slots > {WINDOW - LITERALS} OR names > 0))
          OR (form = 'named' AND slots <= {WINDOW - LITERALS} AND item_id IN (SELECT item_id FROM nm))
       UNION
       SELECT item_id, 0, string_agg(word, ' ' ORDER BY place), count(*), 'whole' FROM bt GROUP BY item_id
       HAVING count(*) BETWEEN {SHORTEST} AND {WINDOW - 1}),
dw AS (SELECT doc_id, place, w FROM ({_windows_sql("dt", "doc_id")}) WHERE form IN (SELECT form FROM bw)
       UNION SELECT doc_id, place, w FROM ({_short_sql()}) WHERE w IS NOT NULL),
m AS (SELECT doc_id, item_id, dw.place - bw.place AS diagonal, bw.place AS q, width FROM dw JOIN bw USING (w)),
v AS (SELECT DISTINCT doc_id, item_id, diagonal, unnest(range(q, q + width)) AS q FROM m),
o AS (SELECT doc_id, item_id, diagonal, count(*) AS covered, max(length) AS length
      FROM v JOIN ln USING (item_id) GROUP BY 1, 2, 3),
f AS (SELECT * FROM o WHERE covered >= {LONG_RUN} OR 2 * covered >= length),
s AS (SELECT v.doc_id, v.item_id, v.diagonal, bt.word AS theirs, dt.word AS ours
      FROM f JOIN v USING (doc_id, item_id, diagonal)
      JOIN bt ON bt.item_id = v.item_id AND bt.place = v.q AND bt.v IN ('#n', '#p', '#u')
      LEFT JOIN dt ON dt.doc_id = v.doc_id AND dt.place = v.q + v.diagonal),
x AS (SELECT doc_id, item_id, diagonal FROM s GROUP BY ALL
      HAVING count(DISTINCT (theirs, ours)) > count(DISTINCT theirs)),
equal AS (SELECT x.doc_id, x.item_id, x.diagonal, bt.place - row_number() OVER (PARTITION BY x.doc_id, x.item_id, x.diagonal ORDER BY bt.place) AS run
          FROM x JOIN bt USING (item_id) JOIN dt ON dt.doc_id = x.doc_id AND dt.place = bt.place + x.diagonal AND dt.word = bt.word),
literal AS (SELECT doc_id, item_id, diagonal, max(n) AS longest
            FROM (SELECT doc_id, item_id, diagonal, run, count(*) AS n FROM equal GROUP BY ALL) GROUP BY 1, 2, 3),
out AS (SELECT x.* FROM x LEFT JOIN literal USING (doc_id, item_id, diagonal) JOIN ln USING (item_id)
        WHERE coalesce(longest, 0) < least({LONG_RUN}, length)),
g AS (SELECT doc_id, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items,
             count(*) AS occurrences, max(covered) AS covered
      FROM f ANTI JOIN out USING (doc_id, item_id, diagonal) GROUP BY 1)
SELECT doc_id, items IS NOT NULL AS contaminated, coalesce(items, '') AS items,
       CAST(coalesce(occurrences, 0) AS BIGINT) AS occurrences,
       CAST(coalesce(covered, 0) AS INTEGER) AS covered
FROM documents LEFT JOIN g USING (doc_id)
"""


@query("op7_decontamination", OP7_SQL)
def op7_decontamination(spark, sf_dir):
    docs = with_row_id(load(spark, sf_dir, "documents").select("doc_id", "text"), "rid", "texts")
    found = contaminated(docs, load(spark, sf_dir, "benchmark"), "rid")
    listed = F.array_join(F.sort_array(F.transform("items", lambda i: i.cast("string"))), ",")
    return docs.select("rid", "doc_id").join(found, "rid", "left").select(
        "doc_id",
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce(listed, F.lit("")).alias("items"),
        F.coalesce("occurrences", F.lit(0)).cast("long").alias("occurrences"),
        F.coalesce("covered", F.lit(0)).cast("int").alias("covered"),
    )
