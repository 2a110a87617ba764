"""Mixing sources to target weights by temperature, realised as block permutations.

With ``t`` tokens in a source, its weight is ``t ** exponent`` over the sum for
all sources.  The exponent lies between 0 (all alike) and 1 (as they are) in
steps of a millionth; the smallest is sought at which

* the entropy of the weights is at most ``evenness`` times that of equal weights, and
* no source is repeated more than ``most_epochs`` times.

Both hold from some exponent on, so the interval is cut again and again.  Each
cut tries ``CUTS`` exponents at once (several bisections in one pass), so three
small aggregates over the per-source table settle it, and the table never comes
to the driver.  If entropy is too high even at 1, the exponent is 1.

The budget is the smallest that uses every row at least once: the source with
the fewest repetitions makes one full pass, the others ``weight * budget / tokens``
passes, so nothing is dropped.  A pass goes through a source in the order of a
keyed digest, another one for each pass; the last, partial pass takes rows while
their running tokens stay within what is left.  A row's place in its source's
stream, as a share of that stream, names its block, so every block holds the
sources in the target weights; rows within a block are permuted by another digest.

Tokens are counted in words.  Rows without words (null or empty texts) appear
once for each full pass of their source.  A null source counts as the source
with the empty name.  A source without any tokens makes one pass, dealt over all blocks.  Rows with
equal keys are ordered by their number.  An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.hashing import key_digest
from tabloom.llm.base import free_name, load, query, with_row_id
from tabloom.session import stage

EVENNESS = 0.97
MOST_EPOCHS = 3.0
BLOCK_TOKENS = 65_536
SEED = 17
STEPS = 1_000_000
CUTS = 100
BUCKET_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \t\n\r]+")), F.lit(0)).cast("long")


def fitted_exponent(sources: DataFrame, evenness: float, most_epochs: float) -> float:
    """The smallest exponent that keeps both limits, for (source, tokens) with tokens above 0."""
    base = sources.agg(F.count(F.lit(1)).alias("n"), F.max("tokens").alias("most"), F.min("tokens").alias("least")).first()
    if base["n"] < 2:
        return 1.0
    target = evenness * math.log(base["n"])
    # Shares of the largest source keep the powers within range.
    x = F.ln(F.col("tokens") / F.lit(float(base["most"])))
    low, high = -1, STEPS
    while high - low > 1:
        step = max(1, (high - low) // CUTS)
        tried = list(range(low + step, high, step))
        k = F.explode(F.sequence(F.lit(tried[0]), F.lit(tried[-1]), F.lit(step)))
        power = F.exp(F.col("k") / F.lit(float(STEPS)) * F.col("x"))
        sums = (
            sources.select(k.alias("k"), x.alias("x"))
            .groupBy("k")
            .agg(F.sum(power).alias("z"), F.sum(power * F.col("x")).alias("zx"))
        )
        entropy = F.ln("z") - F.col("k") / F.lit(float(STEPS)) * F.col("zx") / F.col("z")
        epochs = F.exp((F.lit(1.0) - F.col("k") / F.lit(float(STEPS))) * F.lit(math.log(base["most"] / base["least"])))
        kept = sums.where((entropy <= F.lit(target)) & (epochs <= F.lit(most_epochs))).agg(F.min("k")).first()[0]
        high = high if kept is None else kept
        low = max([v for v in tried if v < high], default=low)
    return high / STEPS


def source_plan(rows: DataFrame, source: str, tokens: str, evenness: float, most_epochs: float) -> DataFrame:
    """(source, tokens, epochs): passes of each source under the smallest covering budget."""
    sources = stage(
        rows.groupBy(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")).agg(
            F.sum(tokens).alias("tokens"), F.count(F.lit(1)).alias("rows")
        ),
        "sources",
    )
    full = sources.where("tokens > 0")
    exponent = fitted_exponent(full, evenness, most_epochs)
    most = full.agg(F.max("tokens")).first()[0] or 1
    passes = F.pow(F.lit(float(most)) / F.col("tokens"), F.lit(1.0 - exponent))
    return stage(
        sources.withColumn("epochs", F.when(F.col("tokens") > 0, F.round(passes, 9)).otherwise(1.0)), "plan"
    )


def mix_sources(
    rows: DataFrame,
    rid: str,
    key: str = "doc_id",
    source: str = "source",
    tokens: str = "tokens",
    evenness: float = EVENNESS,
    most_epochs: float = MOST_EPOCHS,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = SEED,
) -> DataFrame:
    """(rid, key, source, tokens, epoch, block, position): one row for each use of a row.

    ``rows`` carries a unique number ``rid``, as written down by ``with_row_id``.
    """
    narrow = rows.select(
        F.col(rid).alias("rid"), F.col(key).alias("key"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(tokens).alias("n"),
    )
    plan = source_plan(narrow, "source", "n", evenness, most_epochs)
    whole = F.floor("epochs")
    quotas = plan.select(
        "source", F.col("tokens").alias("total"), "rows", whole.alias("whole"),
        F.floor((F.col("epochs") - whole) * F.col("tokens")).alias("rest"),
    )
    budget, count = quotas.agg(F.sum(F.col("whole") * F.col("total") + F.col("rest")), F.sum("rows")).first()
    budget, count = budget or 0, count or 0
    blocks = max(1, -(-int(budget) // block_tokens))
    digits = max(1, math.ceil(math.log(max(count / BUCKET_ROWS, 1), 16)))
    used = narrow.join(quotas.drop("rows"), "source").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - F.when(F.col("rest") > 0, 0).otherwise(1)))
    )
    used = used.withColumn("digest", key_digest(seed, F.col("epoch"), F.col("key")))
    used = used.withColumn("head", F.substring("digest", 1, digits))
    heads = used.groupBy("source", "epoch", "head").agg(F.sum("n").alias("sum"))
    up_to = Window.partitionBy("source", "epoch").orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select("source", "epoch", "head", F.coalesce(F.sum("sum").over(up_to), F.lit(0)).alias("before"))
    inner = Window.partitionBy("source", "epoch", "head").orderBy("digest", "rid").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        used.join(heads, ["source", "epoch", "head"])
        .withColumn("upto", F.col("before") + F.sum("n").over(inner))
        .where((F.col("epoch") < F.col("whole")) | ((F.col("n") > 0) & (F.col("upto") <= F.col("rest"))))
    )
    stream = F.greatest(F.col("whole") * F.col("total") + F.col("rest"), F.lit(1))
    at = F.col("epoch") * F.col("total") + F.col("upto") - F.col("n")
    # A source without any tokens has no places in a stream; its rows are dealt by their digest.
    dealt = F.pmod(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), F.lit(blocks))
    block = F.when(F.col("total") == 0, dealt).otherwise(F.least(F.floor(at / stream * F.lit(blocks)), F.lit(blocks - 1)).cast("long"))
    order = Window.partitionBy("block").orderBy(key_digest(seed, F.lit("block"), F.col("epoch"), F.col("key")), "rid")
    return placed.withColumn("block", block).select(
        F.col("rid"), F.col("key"), "source", F.col("n").alias("tokens"), F.col("epoch").cast("int"), "block",
        (F.row_number().over(order) - 1).cast("int").alias("position"),
    )


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **limits) -> DataFrame:
    """Each document as often as the mix uses it; the columns stay as they are."""
    names = docs.columns
    rid, tokens, copies = (free_name(names, c) for c in ("rid", "tokens", "copies"))
    rows = with_row_id(docs.withColumn(tokens, word_count(F.col(text))), rid, "texts")
    used = mix_sources(rows, rid, key, source, tokens, **limits)
    uses = used.groupBy(F.col("rid").alias(rid)).agg(F.count(F.lit(1)).cast("int").alias(copies))
    repeated = rows.join(uses, rid).withColumn(rid, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return repeated.select(*(F.col(f"`{c}`") for c in names))


OP4_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source,
         CAST(coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r]+')), 0) AS BIGINT) AS n
  FROM documents
), s AS (SELECT source, CAST(sum(n) AS BIGINT) AS total FROM d GROUP BY 1),
f AS (SELECT source, total, ln(total / CAST(max(total) OVER () AS DOUBLE)) AS x,
             CAST(max(total) OVER () AS DOUBLE) AS most, min(total) OVER () AS least,
             count(*) OVER () AS sources
      FROM s WHERE total > 0),
b(low, high) AS (
  SELECT CAST(-1 AS BIGINT), CAST({STEPS} AS BIGINT)
  UNION ALL
  SELECT CASE WHEN ok THEN low ELSE k END, CASE WHEN ok THEN k ELSE high END
  FROM (
    SELECT low, high, k,
           (SELECT ln(sum(exp(k / {STEPS}.0::DOUBLE * x)))
                   - k / {STEPS}.0::DOUBLE * sum(exp(k / {STEPS}.0::DOUBLE * x) * x)
                     / sum(exp(k / {STEPS}.0::DOUBLE * x)) <= {EVENNESS}::DOUBLE * ln(count(*))
                   AND exp((1 - k / {STEPS}.0::DOUBLE) * ln(max(most) / max(least))) <= {MOST_EPOCHS}::DOUBLE
            FROM f) AS ok
    FROM (SELECT low, high, (low + high) // 2 AS k FROM b WHERE high - low > 1)
  )
), e AS (SELECT min(high) / {STEPS}.0::DOUBLE AS a FROM b),
p AS (SELECT s.source, total,
             CASE WHEN total > 0
                  THEN round(pow((SELECT max(most) FROM f) / total, 1.0::DOUBLE - (SELECT a FROM e)), 9)
                  ELSE 1.0 END AS epochs FROM s),
q AS (SELECT source, total, CAST(floor(epochs) AS BIGINT) AS whole,
             CAST(floor((epochs - floor(epochs)) * total) AS BIGINT) AS rest FROM p),
k AS (SELECT greatest(1, CAST(ceil(sum(whole * total + rest) / {BLOCK_TOKENS}.0::DOUBLE) AS BIGINT)) AS blocks FROM q),
u AS (SELECT doc_id, source, n, total, whole, rest,
             unnest(range(0, whole + CASE WHEN rest > 0 THEN 1 ELSE 0 END)) AS epoch
      FROM d JOIN q USING (source)),
r AS (SELECT *, sum(n) OVER (PARTITION BY source, epoch ORDER BY digest, doc_id ROWS UNBOUNDED PRECEDING) AS upto
      FROM (SELECT *, md5(concat_ws('|', '{SEED}', CAST(epoch AS VARCHAR), CAST(doc_id AS VARCHAR))) AS digest FROM u)),
w AS (SELECT doc_id, source, n, epoch,
             CASE WHEN total = 0 THEN CAST(concat('0x', substr(digest, 1, 8)) AS BIGINT) % blocks
             ELSE least(CAST(floor((epoch * total + upto - n)
                    / CAST(greatest(whole * total + rest, 1) AS DOUBLE) * blocks) AS BIGINT), blocks - 1) END AS block
      FROM r, k WHERE epoch < whole OR (n > 0 AND upto <= rest))
SELECT doc_id, source, n AS tokens, CAST(epoch AS INTEGER) AS epoch, CAST(block AS BIGINT) AS block,
       CAST(row_number() OVER (PARTITION BY block
            ORDER BY md5(concat_ws('|', '{SEED}', 'block', CAST(epoch AS VARCHAR), CAST(doc_id AS VARCHAR))), doc_id) - 1
            AS INTEGER) AS position
FROM w
"""


@query("op4_temperature_mix", OP4_SQL)
def op4_temperature_mix(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("tokens"))
    used = mix_sources(with_row_id(docs, "rid", "tokens"), "rid")
    return used.select(F.col("key").alias("doc_id"), "source", "tokens", "epoch", "block", "position")
