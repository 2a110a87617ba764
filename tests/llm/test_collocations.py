"""Collocations and their tries against plain counting."""

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tabloom.llm.collocations import collocations, words_and_breaks
from tabloom.llm.tries import DoubleArray

KIND = "doc_id long, lang string, text string, phrase string"


@pytest.mark.parametrize("length,n,most", [(1, 5, 3), (2, 2000, 100), (3, 4000, 3000), (2, 50_000, 40_000), (4, 10, 10**7)])
def test_tries_find_every_phrase(length, n, most):
    rng = np.random.default_rng(n)
    phrases = rng.zipf(1.3, (n, length)).astype(np.int64) % most
    trie = DoubleArray(phrases)
    tokens = (rng.zipf(1.3, 20_000) % most).astype(np.int32)
    tokens[rng.random(len(tokens)) < 0.05] = -1
    held = min(n, 1000)
    tokens[: held * length] = phrases[:held].ravel()
    known = {tuple(p): i for i, p in enumerate(trie.phrases.tolist())}
    t = tokens.tolist()
    assert trie.walk(tokens).tolist() == [known.get(tuple(t[i : i + length]), -1) if i + length <= len(t) else -1 for i in range(len(t))]
    used = np.flatnonzero(trie.check >= 0)
    assert len(used) >= len(trie.phrases)
    assert len(trie.walk(tokens[: length - 1])) == length - 1


def test_words_and_breaks():
    assert words_and_breaks("A  b\tÉc.d\x0be\x00f ") == [b"a", b"b", "Éc".encode(), b"\n", b"d", b"\n", b"e\x00f"]


def plain(rows, least, longest, top):
    counts, totals = Counter(), Counter()
    for _, lang, text, _ in rows:
        piece = []
        for w in [*words_and_breaks(text or ""), b"\n"]:
            if w == b"\n":
                for i in range(len(piece)):
                    for m in range(1, longest + 1):
                        if i + m <= len(piece):
                            counts[lang or "und", tuple(piece[i : i + m])] += 1
                totals[lang or "und"] += len(piece)
                piece = []
            else:
                piece.append(w)
    good = {k: v for k, v in counts.items() if len(k[1]) > 1 and v >= least}
    gone = {
        (lang, p[i : i + m])
        for (lang, p), f in good.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
        if 100 * f >= 100 * counts[lang, p[i : i + m]]
    }
    out = {}
    for (lang, p), a in good.items():
        if (lang, p) in gone:
            continue
        cuts = [(Fraction(1000 * a * totals[lang], counts[lang, p[:k]] * counts[lang, p[k:]]).__floor__(), k) for k in range(1, len(p))]
        score, k = min(cuts)
        row = (b" ".join(p).decode(), a, counts[lang, p[:k]], counts[lang, p[k:]], totals[lang], score)
        out.setdefault(lang, []).append(row)
    return [
        (lang, i + 1, *r)
        for lang, found in out.items()
        for i, r in enumerate(sorted(found, key=lambda r: (-r[5], -r[1], r[0].encode()))[:top])
    ]


def texts(n):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(30)] + ["Über", "a\x01b", "the"]
    rows = []
    for i in range(n):
        text = "".join(
            rng.choice(["of the big house ", "of the big house. ", rng.choice(words) + " ", rng.choice(words) + rng.choice([". ", "\n", "\t", " ; "])])
            for _ in range(rng.randrange(0, 80))
        )
        rows.append((i, rng.choice(["en", "en", "de", None, "und"]), text, "x"))
    return rows + [(n, "en", None, None), (n, "en", "", None), (None, "fr", "one", None), *[(-1, "en", "again and again", "x")] * 12]


@pytest.mark.parametrize("vocabulary,tries,longest,top", [(10**6, 10**5, 5, 40), (7, 5, 4, None), (10**6, 20, 3, 3)])
def test_phrases_match_plain_counting(spark, vocabulary, tries, longest, top):
    rows = texts(60)
    df = spark.createDataFrame(rows, KIND).repartition(4)
    found = collocations(df, least=5, longest=longest, top=top, vocabulary=vocabulary, trie_phrases=tries)
    want = plain(rows, 5, longest, top)
    assert len(want) > 3
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_long_texts_and_empty_tables(spark):
    rows = [(1, "en", "a b c d " * 300_000, "x")]
    found = collocations(spark.createDataFrame(rows, KIND), least=100)
    assert sorted(map(tuple, found.collect())) == sorted(plain(rows, 100, 5, 2000))
    for none in ([], [(1, None, None, None)], [(1, "en", "rare words", None)]):
        assert collocations(spark.createDataFrame(none, KIND)).collect() == []
