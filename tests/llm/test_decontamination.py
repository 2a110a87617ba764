"""Benchmark items in other clothes, against SQL over the same small tables."""

import re

import pytest
from pyspark.sql import functions as F

from tabloom import llm
from tabloom.llm import decontamination
from tests.compare import difference

TOM = "Tom has 3 apples. Tom buys 5 pears. Tom sells 2 plums. Tom eats 4 figs. How many does Tom have?"
RUN = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} Anna" if i in (10, 50) else f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(58))
ITEMS = {
    1: "Compute 12 plus 7 minus 5 plus 31 minus 8 plus 4 times 9",
    2: "What is 17 + 25 + 38 + 41 + 52 + 63 + 74 + 85?",
    3: "Name the largest of them all",
    4: TOM,
    5: RUN,
    6: "the farmer sold 12 apples and kept 12 pears while Anna bought 7 plums at the market today",
    7: "小明有三个苹果和两个梨一共有多少个水果",
    8: "In Berlin wohnen viele Menschen die gerne Kuchen essen und Kaffee trinken",
    9: "Two words",
    10: None,
    11: "",
}
FOUND = {
    1: ITEMS[1], 2: ITEMS[2], 3: ITEMS[3].upper(), 4: TOM.replace("Tom", "Anna"), 5: RUN.replace("Anna", "Bert", 1),
    6: ITEMS[6].replace("12", "30").replace("Anna", "Bert").replace("7", "9"), 7: ITEMS[7], 8: ITEMS[8].lower(),
}
CLEAN = [
    None, "", "Two words", "clean words only, nothing else in here", ITEMS[6].replace("12 apples", "30 apples").replace("12 pears", "31 pears"),
    "Compute 1 of 2", "Name the largest of", "小明有三个梨", "What is it? Tom has a house. Tom has a dog.",
]


@pytest.fixture
def tables(spark, tmp_path):
    docs = [(i, f"Some words come first. {text}\nAnd others then.") for i, text in FOUND.items()]
    docs += [(100 + i, text) for i, text in enumerate(CLEAN)]
    docs += [(200, "plain " * 20_000 + ITEMS[1] + " plain" * 20_000)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(ITEMS.items()), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_every_item_is_found_and_clean_documents_stay(spark, tables):
    found = {r["doc_id"]: r for r in llm.all_queries()["op7_decontamination"](spark, tables).collect()}
    assert {i: r["items"] for i, r in found.items() if r["contaminated"]} == {**{i: str(i) for i in FOUND}, 200: "1"}


def test_results_equal_sql(spark, tables):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables}/{t}.parquet/*.parquet')")
    assert difference(llm.all_queries()["op7_decontamination"](spark, tables), con, decontamination.OP7_SQL) is None


def test_columns_and_repeated_rows_stay(spark):
    docs = spark.createDataFrame([(1, "x " + ITEMS[1], 5), (1, "x " + ITEMS[1], 5), (2, "clean", None), (2, "clean", None)], "doc_id long, text string, rid int")
    items = spark.createDataFrame([(1, ITEMS[1]), (1, ITEMS[1]), (2, ITEMS[3])], "item_id long, text string")
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert [tuple(r) for r in kept.collect()] == [(2, "clean", None)] * 2
    assert decontamination.drop_contaminated(docs.limit(0), items).collect() == []
    assert decontamination.drop_contaminated(docs, items.limit(0)).count() == 4


def test_windows_are_hashed_row_by_row_not_in_lambdas(spark):
    texts = ["Tom has 5 kg of 12 apples. Anna ate them all in 3 days", "one two", None, "¶ A b. C d e f g h I 7 j"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    for forms, widths in ((["canon"], []), (["canon", "plain", "named"], [4]), (["plain"], [5])):
        found = decontamination._spread(df, "k", "t", forms, widths)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        # A hash of several tokens inside a lambda is interpreted for each window.
        assert not re.search(r"lambdafunction\([^,]*xxhash64\([a-z]+#\d+\[", plan)
        raw = df.select("k", decontamination.raw_tokens(F.col("t")).alias("raw"))
        want = set()
        for r in raw.select("k", *[c.alias(f) for f, c in decontamination._forms(F.col("raw")).items()]).collect():
            for f, width in [*((f, decontamination.WINDOW) for f in forms), *(("plain", w) for w in widths)]:
                want |= {(r["k"], p, " ".join(r[f][p : p + width])) for p in range(len(r[f]) - width + 1)}
        tokens = spark.createDataFrame(sorted({x for *_, x in want}), "string").withColumn("h", F.transform(F.split("value", " "), lambda x: F.xxhash64(x)))
        hashes = {}
        for r in tokens.collect():
            hashes[r["value"]] = r["h"]
        pairs = spark.createDataFrame([(w, h) for w, h in hashes.items()], "w string, h array<long>")
        long = {n: pairs.where(F.size("h") == n).select("w", F.xxhash64(*[F.col("h")[j] for j in range(n)]).alias("x")).collect() for n in {len(h) for h in hashes.values()}}
        of = {r["w"]: r["x"] for rows in long.values() for r in rows}
        got = {(r["k"], r["p"], r["hash"]) for r in found.where("p is not null and hash is not null").collect()}
        assert got == {(k, p, of[x]) for k, p, x in want} and got
