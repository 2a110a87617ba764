"""Inputs on which operators once went wrong."""

import duckdb
import numpy as np

from tabloom import llm
from tabloom.llm import mixing, preferences, toxicity
from tests.compare import difference

DOCS = "doc_id long, text string, score string"


def test_toxicity_learns_where_all_toxic_texts_are_long(spark):
    rng = np.random.default_rng(2)
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows, labels = [], []
    for i in range(150):
        toxic = i % 3 == 0
        text = [str(w) for w in rng.choice(words, 1200 if toxic else 60)]
        if toxic:
            text[600:604] = ["vile", "hateful", "vile", "scum"]
        rows.append((i, " ".join(text), "x"))
        labels.append((i, int(toxic)))
    assert min(len(r[1]) for r in rows if r[0] % 3 == 0) > toxicity.TRAINING_CHARS
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    sample = toxicity.training_sample(docs, known, "doc_id", "text", "toxic")
    assert sum(y for _, y in sample) > 30
    scored = toxicity.score_toxicity(docs.unionByName(docs.limit(3)), toxicity.train_toxicity(docs, known))
    assert scored.columns == [*docs.columns, "score_"] and scored.count() == 153
    right = sum((r["score_"] >= 0.5) == (r["doc_id"] % 3 == 0) for r in scored.collect())
    assert right >= 130
    assert toxicity.train_toxicity(docs.limit(0), known) == 0.0


def test_turns_are_told_apart_by_role_and_text(spark):
    turns = [(1, 0, "user", "same"), (1, 1, "a|b", "c"), (2, 0, "user", "same"), (2, 1, "a", "b|c")]
    df = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    parts = {(r["conv_id"], r["turn"]): r["part"] for r in preferences.preferences(df).collect()}
    assert parts == {(1, 0): "prompt", (1, 1): "chosen", (2, 1): "rejected"}
    assert preferences.preferences(df.limit(0)).collect() == []


def test_wordless_sources_are_dealt_over_all_blocks(spark, tmp_path):
    rows = [(i, "some words of a text " * 400, "a") for i in range(250)] + [(1000 + i, None if i % 2 else " ", "none") for i in range(500)]
    rows += [(2000 + i, "words without a source", None) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = llm.all_queries()["op4_temperature_mix"](spark, str(tmp_path))
    blocks = [r["block"] for r in found.where("source = 'none'").collect()]
    assert len(blocks) == 500 and len(set(blocks)) == 1 + max(r["block"] for r in found.collect()) > 4
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert difference(found, con, mixing.OP4_SQL) is None
