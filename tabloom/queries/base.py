"""Declaring queries, loading tables, and the frames several queries start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.names import unique_name
from tabloom.session import scratch_path
from tabloom.sources.tables import ensure_schema

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that must give the same rows."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is declared twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def work_schema(spark: SparkSession) -> str:
    """A new catalog schema in the shared folder, so that runs do not meet."""
    return ensure_schema(spark, unique_name("tabloom"), scratch_path(spark, "schema"))


# --- events by hour: a count to predict from the time of day ----------------


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour, split into two kinds that add up to the count."""
    events = load(spark, sf_dir, "events")
    day, hr = F.to_date("ts"), F.hour("ts")
    casual = F.col("event_type").isin("click", "view")
    return (
        events.groupBy(day.alias("dteday"), hr.alias("hr"))
        .agg(
            F.count_if(casual).cast("int").alias("casual"),
            F.count_if(~casual).cast("int").alias("registered"),
            F.count(F.lit(1)).cast("int").alias("cnt"),
        )
        .select(
            (F.datediff("dteday", F.lit("2024-01-01").cast("date")) * 24 + F.col("hr")).alias(
                "instant"
            ),
            "dteday",
            "hr",
            F.weekday("dteday").alias("weekday"),
            (F.weekday("dteday") < 5).cast("int").alias("workingday"),
            "casual",
            "registered",
            "cnt",
        )
    )


HOURLY = """
hourly AS (
  SELECT CAST(date_diff('day', DATE '2024-01-01', dteday) * 24 + hr AS INTEGER) AS instant,
         dteday, hr,
         CAST(isodow(dteday) - 1 AS INTEGER) AS weekday,
         CAST(isodow(dteday) <= 5 AS INTEGER) AS workingday,
         casual, registered, casual + registered AS cnt
  FROM (
    SELECT CAST(ts AS DATE) AS dteday, CAST(hour(ts) AS INTEGER) AS hr,
           CAST(count(*) FILTER (event_type IN ('click', 'view')) AS INTEGER) AS casual,
           CAST(count(*) FILTER (event_type NOT IN ('click', 'view')) AS INTEGER) AS registered
    FROM events GROUP BY 1, 2
  )
)
"""

# --- documents: shape of the text against a quality label -------------------

# Letters that mark a language.
FRENCH, GERMAN, SPANISH = "éèêàç", "äöüß", "ñóáíú"


def text_shape(documents: DataFrame) -> DataFrame:
    """Numbers describing each whole text, all computed by built-in expressions."""
    words = F.split("text", "[ \n\t]+")
    n = F.greatest(F.length("text"), F.lit(1)).cast("double")

    def share(pattern: str):
        return F.regexp_count("text", F.lit(pattern)) / n

    return documents.select(
        "doc_id",
        F.length("text").cast("double").alias("chars"),
        F.size(words).cast("double").alias("words"),
        (F.regexp_count("text", F.lit("\n")) + 1).cast("double").alias("lines"),
        share("[.,;:!?]").alias("punctuation_ratio"),
        share("[0-9]").alias("digit_ratio"),
        share("[A-Z]").alias("upper_ratio"),
        (F.size(F.array_distinct(words)) / F.size(words)).alias("distinct_word_ratio"),
    )


TEXT_FEATURES = [
    "chars",
    "words",
    "lines",
    "punctuation_ratio",
    "digit_ratio",
    "upper_ratio",
    "distinct_word_ratio",
]


def _kept(pattern: str) -> str:
    return f"CAST(length(regexp_replace(text, '[^{pattern}]', '', 'g')) AS DOUBLE)"


TEXT_SHAPE = f"""
text_shape AS (
  SELECT doc_id, lang,
         CAST(length(text) AS DOUBLE) AS chars,
         CAST(len(string_split_regex(text, '[ \\n\\t]+')) AS DOUBLE) AS words,
         {_kept(chr(92) + "n")} + 1 AS lines,
         {_kept(".,;:!?")} / greatest(length(text), 1) AS punctuation_ratio,
         {_kept("0-9")} / greatest(length(text), 1) AS digit_ratio,
         {_kept("A-Z")} / greatest(length(text), 1) AS upper_ratio,
         CAST(len(list_distinct(string_split_regex(text, '[ \\n\\t]+'))) AS DOUBLE)
           / len(string_split_regex(text, '[ \\n\\t]+')) AS distinct_word_ratio
  FROM documents
)
"""


def letter_code(documents: DataFrame) -> DataFrame:
    """One small number per text: how often each language's letters occur (27 values)."""
    n = F.greatest(F.length("text"), F.lit(1)).cast("double")

    def level(letters: str):
        share = F.regexp_count("text", F.lit(f"[{letters}]")) / n
        return F.when(share == 0, 0).when(share < 0.01, 1).otherwise(2)

    code = level(FRENCH) * 9 + level(GERMAN) * 3 + level(SPANISH)
    return documents.select("doc_id", "lang", code.cast("int").alias("letter_code"))


def _level(letters: str) -> str:
    share = f"{_kept(letters)} / greatest(length(text), 1)"
    return f"(CASE WHEN {share} = 0 THEN 0 WHEN {share} < 0.01 THEN 1 ELSE 2 END)"


LETTER_CODE = f"""
letter_code AS (
  SELECT doc_id, lang,
         CAST({_level(FRENCH)} * 9 + {_level(GERMAN)} * 3 + {_level(SPANISH)} AS INTEGER)
           AS letter_code
  FROM documents
)
"""


def hash01_sql(seed: int, *keys: str) -> str:
    """The SQL twin of ``tabloom.functions.hashing.hash01``."""
    joined = ", ".join([f"'{seed}'", *(f"CAST({k} AS VARCHAR)" for k in keys)])
    return (
        f"(CAST(concat('0x', substr(md5(concat_ws('|', {joined})), 1, 8)) AS BIGINT)"
        f" / 4294967296.0::DOUBLE)"
    )


def digest_sql(seed: int, *keys: str) -> str:
    joined = ", ".join([f"'{seed}'", *(f"CAST({k} AS VARCHAR)" for k in keys)])
    return f"md5(concat_ws('|', {joined}))"
