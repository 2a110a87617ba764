"""Preference data from pairs of conversations: one prompt, two masked completions.

Conversations stay one row per turn from end to end, because one conversation may
hold a large part of all turns.  The turns of a pair are joined on pair and turn
number; the first number at which they differ ends the longest common prefix.
Turns before it are rendered once as prompt, the others as completion of the
chosen or the rejected side.  A rendered turn is

    <|role|>\\n text <|end|>\\n

and in completions the text and end mark of assistant turns are trained on:
``mask_start`` and ``mask_end`` bound them in the segment, in characters.

A turn is what stands under one number of a conversation; rows that share a
number are compared as a collection and rendered one by one.  A prefix is common
only as far as both sides have equal turns, so if one conversation is the
beginning of the other, its completion is empty.  Null texts render as empty,
null roles as ``unknown``.  Rows without conversation or turn number are part
``single`` like those of conversations that are in no pair.  An empty table
gives no rows.

``pairs_of`` makes pairs.  Conversations with the same first turn are paired two by
two, the one with the smaller id being chosen: by ids within blocks of
``BLOCK`` ids, then the ones left over from each block.  So a first turn shared by a
third of all conversations is spread over many tasks.  A conversation without partner but with at
least two assistant turns is paired with itself after its last assistant turn is
replaced by its first, a stale answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.base import load, query
from tabloom.session import stage

BLOCK = 1024
END = "<|end|>"


def _turn_digest():
    """Of a turn's role and text, told apart by the length of the role."""
    role = F.coalesce("role", F.lit("unknown"))
    return F.md5(F.concat_ws("|", F.char_length(role).cast("string"), role, F.coalesce("text", F.lit(""))))


def pairs_of(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen_id, rejected_id, stale_turn, stale_text): at most one for each conversation.

    ``stale_turn`` is null for pairs of two conversations; otherwise the rejected
    side is the chosen one up to that turn, with ``stale_text`` there.
    """
    firsts = turns.groupBy("conv_id").agg(
        F.min(F.struct("turn", _turn_digest().alias("d"))).alias("f"),
        F.max(F.when(F.col("role") == "assistant", F.col("turn"))).alias("last_answer"),
        F.min(F.when(F.col("role") == "assistant", F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))).alias("answer"),
    ).select("conv_id", F.col("f.d").alias("first"), "last_answer", "answer")
    firsts = firsts.withColumn("block", F.floor(F.col("conv_id") / BLOCK))

    def two_by_two(df: DataFrame, by: list[str]) -> DataFrame:
        order = Window.partitionBy(*by).orderBy("conv_id")
        return df.withColumn("k", F.row_number().over(order)).withColumn("next", F.lead("conv_id").over(order))

    near = stage(two_by_two(firsts, ["first", "block"]).withColumn(
        "left", (F.col("k") % 2 == 1) & F.col("next").isNull()
    ), "pairs")
    far = stage(two_by_two(near.where("left").drop("k", "next", "left"), ["first"]), "pairs")
    odd = (F.col("k") % 2 == 1) & F.col("next").isNotNull()
    none = [F.lit(None).cast(turns.schema["turn"].dataType).alias("stale_turn"), F.lit(None).cast("string").alias("stale_text")]
    two = near.where(odd).unionByName(far.where(odd), allowMissingColumns=True).select(
        F.col("conv_id").alias("pair_id"), F.col("conv_id").alias("chosen_id"), F.col("next").alias("rejected_id"), *none
    )
    alone = far.where((F.col("k") % 2 == 1) & F.col("next").isNull() & (F.col("answer.turn") < F.col("last_answer")))
    stale = alone.select(
        F.col("conv_id").alias("pair_id"), F.col("conv_id").alias("chosen_id"), F.col("conv_id").alias("rejected_id"),
        F.col("last_answer").alias("stale_turn"), F.col("answer.text").alias("stale_text"),
    )
    return two.unionByName(stale)


def format_preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pair_id, conv_id, part, turn, role, segment, mask_start, mask_end), a row for each rendered turn."""
    pairs = stage(pairs, "pairs")
    own = turns.select("conv_id", "turn", "role", "text")
    chosen = own.join(pairs.select(F.col("chosen_id").alias("conv_id"), "pair_id"), "conv_id").withColumn("side", F.lit("chosen"))
    given = pairs.select(F.col("rejected_id").alias("conv_id"), "pair_id", "stale_turn", "stale_text")
    at = F.col("turn") == F.col("stale_turn")
    rejected = (
        own.join(given, "conv_id")
        .where(F.col("stale_turn").isNull() | (F.col("turn") <= F.col("stale_turn")))
        .withColumn("text", F.when(F.coalesce(at, F.lit(False)) & (F.col("role") == "assistant"), F.col("stale_text")).otherwise(F.col("text")))
        .withColumn("side", F.lit("rejected"))
        .select(*chosen.columns)
    )
    both = chosen.unionByName(rejected)
    # A turn's content: how often each digest stands under its number, whatever the order.
    content = both.groupBy("pair_id", "turn", "side", _turn_digest().alias("d")).agg(F.count(F.lit(1)).alias("n"))
    sides = content.groupBy("pair_id", "turn", "d").agg(
        F.coalesce(F.sum(F.when(F.col("side") == "chosen", F.col("n"))), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.when(F.col("side") == "rejected", F.col("n"))), F.lit(0)).alias("b"),
    )
    split = stage(
        sides.where("a <> b").groupBy("pair_id").agg(F.min("turn").alias("differs")), "prefixes"
    )
    parted = both.join(split, "pair_id", "left")
    shared = F.col("differs").isNull() | (F.col("turn") < F.col("differs"))
    parts = parted.where(~shared | (F.col("side") == "chosen")).withColumn(
        "part", F.when(shared, F.lit("prompt")).otherwise(F.col("side"))
    )
    paired = pairs.select(F.explode(F.array_distinct(F.array("chosen_id", "rejected_id"))).alias("conv_id")).distinct()
    single = own.join(paired, "conv_id", "left_anti").withColumn("part", F.lit("single")).withColumn("pair_id", F.lit(None).cast(pairs.schema["pair_id"].dataType))
    columns = ["pair_id", "conv_id", "part", "turn", "role", "text"]
    rows = parts.select(*columns).unionByName(single.select(*columns))
    role = F.coalesce("role", F.lit("unknown"))
    head = F.concat(F.lit("<|"), role, F.lit("|>\n"))
    body = F.concat(F.coalesce("text", F.lit("")), F.lit(END))
    trained = F.col("part").isin("chosen", "rejected") & (role == "assistant")
    return rows.select(
        "pair_id", "conv_id", "part", "turn", "role",
        F.concat(head, body, F.lit("\n")).alias("segment"),
        F.when(trained, F.char_length(head)).cast("int").alias("mask_start"),
        F.when(trained, F.char_length(head) + F.char_length(body)).cast("int").alias("mask_end"),
    )


_DIGEST = "md5(concat_ws('|', length(coalesce(role, 'unknown')), coalesce(role, 'unknown'), coalesce(text, '')))"

OP3_SQL = f"""
WITH t AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
f AS (SELECT conv_id, arg_min({_DIGEST}, (turn, {_DIGEST})) AS first,
             max(turn) FILTER (role = 'assistant') AS last_answer,
             min(turn) FILTER (role = 'assistant') AS first_answer,
             arg_min(coalesce(text, ''), (turn, coalesce(text, ''))) FILTER (role = 'assistant') AS answer
      FROM t GROUP BY 1),
n AS (SELECT *, row_number() OVER w AS k, lead(conv_id) OVER w AS next
      FROM (SELECT *, floor(conv_id / {BLOCK}.0) AS block FROM f)
      WINDOW w AS (PARTITION BY first, block ORDER BY conv_id)),
g AS (SELECT conv_id, last_answer, first_answer, answer, row_number() OVER w AS k, lead(conv_id) OVER w AS next
      FROM n WHERE k % 2 = 1 AND next IS NULL WINDOW w AS (PARTITION BY first ORDER BY conv_id)),
p AS (SELECT conv_id AS pair_id, next AS rejected_id, NULL AS stale_turn, NULL AS stale_text FROM n WHERE k % 2 = 1 AND next IS NOT NULL
      UNION ALL SELECT conv_id, next, NULL, NULL FROM g WHERE k % 2 = 1 AND next IS NOT NULL
      UNION ALL SELECT conv_id, conv_id, last_answer, answer FROM g
      WHERE k % 2 = 1 AND next IS NULL AND first_answer < last_answer),
b AS (SELECT pair_id, conv_id, turn, role, text, 'chosen' AS side FROM t JOIN p ON conv_id = pair_id
      UNION ALL
      SELECT pair_id, conv_id, turn, role,
             CASE WHEN turn = stale_turn AND role = 'assistant' THEN stale_text ELSE text END, 'rejected'
      FROM t JOIN p ON conv_id = rejected_id WHERE stale_turn IS NULL OR turn <= stale_turn),
s AS (SELECT pair_id, min(turn) AS differs FROM (
        SELECT pair_id, turn, {_DIGEST} AS d FROM b GROUP BY ALL
        HAVING count(*) FILTER (side = 'chosen') <> count(*) FILTER (side = 'rejected')) GROUP BY 1),
r AS (SELECT pair_id, conv_id, CASE WHEN differs IS NULL OR turn < differs THEN 'prompt' ELSE side END AS part,
             turn, role, text
      FROM b LEFT JOIN s USING (pair_id) WHERE side = 'chosen' OR turn >= differs
      UNION ALL
      SELECT NULL, conv_id, 'single', turn, role, text FROM conversations
      WHERE conv_id IS NULL OR turn IS NULL OR conv_id NOT IN (SELECT pair_id FROM p UNION ALL SELECT rejected_id FROM p))
SELECT pair_id, conv_id, part, turn, role,
       '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '{END}' || chr(10) AS segment,
       CAST(CASE WHEN part IN ('chosen', 'rejected') AND role = 'assistant' THEN 14 END AS INTEGER) AS mask_start,
       CAST(CASE WHEN part IN ('chosen', 'rejected') AND role = 'assistant'
            THEN 14 + length(coalesce(text, '')) + {len(END)} END AS INTEGER) AS mask_end
FROM r
"""


def preferences(turns: DataFrame) -> DataFrame:
    """Pairs by first turn, formatted; rows that belong nowhere come out as ``single``."""
    placed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    sound = turns.where(placed)
    formatted = format_preferences(sound, pairs_of(sound))
    none = turns.where(~placed).select(
        F.lit(None).cast(formatted.schema["pair_id"].dataType).alias("pair_id"), "conv_id", F.lit("single").alias("part"), "turn", "role",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit(END + "\n")).alias("segment"),
        F.lit(None).cast("int").alias("mask_start"), F.lit(None).cast("int").alias("mask_end"),
    )
    return formatted.unionByName(none)


@query("op3_preference_pairs", OP3_SQL)
def op3_preference_pairs(spark, sf_dir):
    return preferences(load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
