"""Corpus operators against brute force, and on nulls, ties, repeats and empty tables."""

import numpy as np
import pytest

from tabloom.llm import decontamination, html_text, licences, mixing, near_dedup
from tabloom.llm import preferences, sharding, shingles, toxicity, vector_search
from tabloom.llm.base import with_row_id

DOCS = "doc_id long, text string, source string, score string"
WORDS = [f"w{i}" for i in range(200)]
ODD = [(1, None, "a", "x"), (2, "", None, "x"), (3, "one", "b", "x"), (3, "one", "b", "x")]


def test_main_text():
    page = (
        '<body><nav><a href="/">Menu</a></nav><div class="cookie-notice">We use cookies</div>'
        "<article><h1>Title</h1><p>First &amp;\n second <b>bold</b> part.<p>Next<br>line</article>"
        '<div class="comments"><p>Great post, many words of a reader here</p></div><footer>(c)</footer></body>'
    )
    assert html_text.main_text(page) == "Title\n\nFirst & second bold part.\n\nNext line"
    assert html_text.main_text(None) == html_text.main_text("") == ""
    assert html_text.main_text("<script>x</script>") == ""
    assert html_text.main_text("<p>a" + " b" * 200_000).startswith("a b")


def test_main_text_keeps_wrappers_called_like_noise():
    article = "<p>" + "Plain words of the article itself. " * 8 + "</p>"
    want = " ".join(("Plain words of the article itself. " * 8).split())
    for name in ("content-sidebar-wrap", "has-sidebar", "no-comments", "comments-open"):
        for inner in (f"<article>{article}</article>", f"<main>{article}</main>", article):
            page = (f'<body><div class="{name}">{inner}<div class="sidebar"><p>Side words</p></div></div>'
                    '<div><p>Imprint</p></div></body>')  # fmt: skip
            assert html_text.main_text(page) == want
    assert html_text.main_text('<body><div class="notice"><p>All there is</p></div></body>') == "All there is"


def test_best_fit_decreasing_takes_the_tightest_bin():
    rng = np.random.default_rng(1)
    sizes = [int(x) for x in rng.integers(1, 60, 300)]
    room, want = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(r, b) for b, r in enumerate(room) if r >= sizes[i]]
        if not fits:
            room.append(100)
            fits = [(100, len(room) - 1)]
        b = min(fits)[1]
        room[b] -= sizes[i]
        want[i] = b
    assert sharding.best_fit_decreasing(sizes, 100) == [want[i] for i in range(len(sizes))]


@pytest.mark.parametrize("rows", [ODD, ODD * 50, []])
def test_shards(spark, rows):
    found = sharding.shard_documents(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == len(rows)
    for shard in {r["shard"] for r in found}:
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def brute_components(docs):
    sets = {}
    for i, t in docs:
        w = (t or "").split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))} if w else set()
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    return root


def test_near_duplicates(spark):
    rng = np.random.default_rng(3)
    base = [" ".join(rng.choice(WORDS, 80)) for _ in range(4)]
    docs = []
    for i in range(40):
        words = base[i % 4].split()
        for j in rng.integers(0, 80, i % 5):
            words[j] = f"x{i}"
        docs.append((i, " ".join(words)))
    docs += [(40, None), (41, ""), (42, "a b"), (43, "a b"), (44, " ".join(["long"] * 50_000))]
    rows = spark.createDataFrame([(i, t, "s", "c") for i, t in docs], DOCS)
    found = near_dedup.near_duplicates(with_row_id(rows, "rid", "t"), "rid").collect()
    assert {r["key"]: r["component_id"] for r in found} == brute_components(docs)
    kept = near_dedup.drop_near_duplicates(rows)
    assert kept.columns == rows.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(brute_components(docs).values()))
    assert near_dedup.drop_near_duplicates(rows.limit(0)).count() == 0


def test_odd_sketch_never_rules_out_a_link():
    rng = np.random.default_rng(4)
    for n in (5, 100, 700, 5000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[n // 8 :], rng.integers(0, 2**63, n // 10, dtype=np.uint64)]))
        assert shingles.linked(a, b)
        level = max(shingles.level_of(len(a)), shingles.level_of(len(b)))
        half = shingles.SKETCH_BITS // 64
        parts = [shingles.odd_sketches(x)[half * (level - shingles.level_of(len(x))) :][:half] for x in (a, b)]
        bits = sum(bin(int(x)).count("1") for x in (parts[0] ^ parts[1]).view(np.uint64))
        mean = (len(a) + len(b)) / 7 / 2**level
        assert bits <= (mean if level == 0 else mean + 5 * mean**0.5)


def test_decontamination_checks_slots(spark):
    item = "the farmer sold 12 apples and kept 12 pears while Anna bought 7 plums at the market today"
    same = item.replace("12", "30").replace("Anna", "Bert").replace("7", "9")
    mixed = item.replace("12 apples", "30 apples").replace("12 pears", "31 pears")
    rows = [(1, f"before that {same} and then", "a", "x"), (2, f"before that {mixed} and then", "a", "x"),
            (3, None, "a", "x"), (4, "", "a", "x"), (5, "clean words only", "a", "x")]
    docs = spark.createDataFrame(rows, DOCS)
    items = spark.createDataFrame([(1, item), (2, None), (3, "too short")], "item_id long, text string")
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 5]
    assert decontamination.drop_contaminated(docs, items.limit(0)).count() == 5


def test_decontamination_flags_long_literal_runs_despite_a_changed_slot(spark):
    item = " ".join(f"{w} Anna" if i in (10, 50) else w for i, w in enumerate(WORDS[:58]))
    copy = item.replace("Anna", "Bert", 1)
    docs = spark.createDataFrame([(1, f"before that {copy} and then", "a", "x"), (2, "clean", "a", "x")], DOCS)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [r["doc_id"] for r in decontamination.drop_contaminated(docs, items).collect()] == [2]


def test_mixing_uses_every_row_and_keeps_the_limit(spark):
    rows = [(i, "a b c d", "big" if i % 10 else "small", "x") for i in range(200)] + ODD
    docs = spark.createDataFrame(rows, DOCS)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    uses = {}
    for r in mixed.collect():
        uses[r["doc_id"], r["source"]] = uses.get((r["doc_id"], r["source"]), 0) + 1
    assert {(r[0], r[2]) for r in rows} == set(uses)
    assert max(n for (i, _), n in uses.items() if i > 3) <= mixing.MOST_EPOCHS
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_preferences_share_one_prompt(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (2, 0, "user", "hi"), (2, 1, "assistant", "b"),
             (3, 0, "user", None), (None, 0, "user", "lost"), (4, 0, "user", "q"), (4, 1, "assistant", "x"),
             (4, 2, "user", "r"), (4, 3, "assistant", "y")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    found = preferences.preferences(df).collect()
    parts = sorted((r["pair_id"] or 0, r["part"], r["turn"], r["segment"]) for r in found)
    assert (1, "prompt", 0, "<|user|>\nhi<|end|>\n") in parts
    assert [p[1] for p in parts if p[0] == 1] == ["chosen", "prompt", "rejected"]
    assert [p[3] for p in parts if p[0] == 4 and p[1] == "rejected"] == ["<|assistant|>\nx<|end|>\n"]
    assert sum(p[1] == "single" for p in parts) == 2
    assert all(r["segment"][r["mask_start"] : r["mask_end"]].endswith("<|end|>") for r in found if r["mask_start"])


def test_toxicity_learns_and_takes_odd_texts(spark):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(200):
        words = list(rng.choice(WORDS, 40))
        if i % 4 == 0:
            words[rng.integers(0, 40)] = "vile" + str(rng.choice(["ness", "ly", "r"]))
        rows.append((i, " ".join(words), "a", "x"))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, marks)
    scores = model.score([r[1] for r in rows])
    assert np.mean((scores >= 0.5) == [y == 1 for _, y in labels]) > 0.9
    odd = model.score([None, "", "w1 " * 30_000])
    assert np.all((odd >= 0) & (odd <= 1))
    assert toxicity.train_toxicity(docs, marks.limit(0)) == 0.0
    assert toxicity.drop_toxic(docs.limit(0), marks).count() == 0


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 16))
    x[50:80] = x[50]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(900, None), (1000, [0.0] * 16), (1100, [float("nan")] * 16), (1200, [None] * 16), (100, rows[100][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in vector_search.nearest(df, lambda k: k % 50 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert sorted(found) == [0, 50, 100, 150, 200, 250]
    assert found[50] == list(range(51, 61))
    hit = 0
    for q, got in found.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        hit += len(set(got) & set(np.lexsort((np.arange(300), d))[:10]))
    assert hit >= 0.9 * 60
    assert vector_search.nearest(df.limit(0), lambda k: k % 50 == 0).count() == 0


def test_licences(spark):
    rows = [(1, "Released under the MIT License. MIT-license!", "a", "x"), (2, None, "a", "x"), (3, "", "a", "x"),
            (4, "words " * 50_000 + "GNU General Public License, version 3", "a", "x")]
    found = {r["doc_id"]: r for r in licences.scan_licences(spark.createDataFrame(rows, DOCS)).collect()}
    assert (found[1]["n_base"], found[1]["first_word"], found[1]["last_word"]) == (2, 3, 5)
    assert found[1]["labels"] == "mit" and found[1]["score"] == 1.0
    assert found[2]["labels"] == found[3]["labels"] == "" and found[2]["first_word"] is None
    assert found[4]["n_base"] == 1 and "gpl-3.0" in found[4]["labels"]


@pytest.mark.parametrize("first", ["bsd", "isc"])
def test_licences_look_up_every_notice_of_a_file(first):
    index = licences.LicenceIndex(licences.TEMPLATES, licences.BASE_PHRASES, {})
    notice = next(n for label, n, _ in licences.TEMPLATES if label == first)
    for label in ("gpl-3.0", "cc-by-nc-4.0", "apache-2.0"):
        other = next(n for name, n, _ in licences.TEMPLATES if name == label)
        found = index.scan(f"{notice} some words of our own. {other}.")["labels"].split(",")
        assert first in found and label in found
