"""Licence scans over whole texts with a positional rare-token index.

A template is the word sequence of a public licence notice with the key phrases
that must not be missing.  The index keeps, for each licence word, its postings
(template, position).  For each file

1. the words of each template whose key words it holds are ranked by inverse
   document frequency, counted over all files; the rarest of each are looked up,
2. every occurrence votes for (template, place where the template would begin);
   a place named by at least two of the template's looked-up words is a candidate,
3. a candidate stands if every key phrase of the template occurs as consecutive
   words within the template's span (widened by ``SLACK`` words, for notices
   that were reflowed or slightly edited); its score is the share of template
   words standing exactly at their relative position.

Base phrases are counted apart from the templates, at every place.

Words: A-Z in lower case, then runs of letters a-z, digits and characters
beyond ASCII.  UTF-8 puts every character beyond ASCII in bytes of 128 and
above, so the bytes of the text are cut directly.

Null and empty texts have no words, no label and score 0.  Repeated rows each
give a row.  Other columns of the input are left out, so clashes cannot arise.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.base import load, query
from tabloom.session import with_code

# Base phrases and their labels.
BASE_PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Public licence notices as (label, notice, key phrases).
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons "
        "to whom the software is furnished to do so subject to the following conditions the "
        "above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies",
        ("permission to use copy modify", "with or without fee is hereby granted"),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met redistributions of source "
        "code must retain the above copyright notice this list of conditions and the following "
        "disclaimer",
        ("redistribution and use in source and binary forms", "with or without modification"),
    ),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0",
        ("apache license version 2 0",),
    ),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file "
        "except in compliance with the license you may obtain a copy of the license at",
        ("apache license version 2 0", "in compliance with the license"),
    ),
    (
        "gpl-3.0",
        "licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
        ("gnu general public license", "free software foundation"),
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms "
        "of the gnu lesser general public license as published by the free software foundation",
        ("gnu lesser general public license",),
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license v 2 0",),
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
)

RARE_WORDS = 8
SLACK = 8

_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, in order."""
    return text.encode().translate(_WORD_BYTES).split() if text else []


def places(words: list[bytes], phrase: list[bytes], begin: int = 0, end: int | None = None):
    """Every start of ``phrase`` among ``words[begin:end]``."""
    end = len(words) if end is None else min(end, len(words))
    found, at = [], begin
    while True:
        try:
            at = words.index(phrase[0], at, end)
        except ValueError:
            return found
        if at + len(phrase) <= end and words[at : at + len(phrase)] == phrase:
            found.append(at)
        at += 1


class LicenceIndex:
    """Postings of the template words, and the look-up of one file."""

    def __init__(self, templates, base_phrases, idf: dict[bytes, float]):
        self.labels = [label for label, _, _ in templates]
        self.words = [words_of(notice) for _, notice, _ in templates]
        self.keys = [[words_of(k) for k in keys] for _, _, keys in templates]
        self.base = [(words_of(phrase), label) for phrase, label in base_phrases]
        self.idf = idf
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, words in enumerate(self.words):
            for q, word in enumerate(words):
                self.postings[word].append((t, q))
        self.needed = [frozenset(w for k in keys for w in k) for keys in self.keys]
        self.base_needed = frozenset.intersection(*(frozenset(p) for p, _ in self.base))
        self.doors = frozenset(min(n, key=lambda w: (-idf.get(w, 0.0), w)) for n in self.needed)

    def candidates(self, words: list[bytes], have: set[bytes]) -> list[tuple[int, int]]:
        """(template, begin) named by the rarest words of each template that the file holds."""
        sought: dict[bytes, set[int]] = defaultdict(set)
        enough = {}
        for t, needed in enumerate(self.needed):
            if needed <= have:
                known = sorted(have.intersection(self.words[t]), key=lambda w: (-self.idf.get(w, 0.0), w))
                # A template with only one word to look up needs that one.
                enough[t] = min(2, len(known))
                for w in known[:RARE_WORDS]:
                    sought[w].add(t)
        votes: dict[tuple[int, int], set[bytes]] = defaultdict(set)
        if not sought:
            return []
        for p, word in enumerate(words):
            if word in sought:
                open_ = sought[word]
                for t, q in self.postings[word]:
                    if t in open_:
                        votes[t, p - q].add(word)
        return sorted(place for place, by in votes.items() if len(by) >= enough[place[0]])

    def scan(self, text: str | None) -> dict:
        words = words_of(text)
        have = set(words)
        starts, base_labels = [], set()
        if self.base_needed <= have:
            for phrase, label in self.base:
                if found := places(words, phrase):
                    starts += found
                    base_labels.add(label)
        labels, score = set(base_labels), 0.0
        matches = []
        if self.doors & have:
            for t, begin in self.candidates(words, have):
                own = self.words[t]
                low, high = max(0, begin - SLACK), begin + len(own) + SLACK
                if not all(places(words, k, low, high) for k in self.keys[t]):
                    continue
                hits = sum(
                    0 <= begin + q < len(words) and words[begin + q] == w
                    for q, w in enumerate(own)
                )
                matches.append((self.labels[t], max(begin, 0), hits / len(own)))
                labels.add(self.labels[t])
                score = max(score, hits / len(own))
        return {
            "n_words": len(words),
            "n_base": len(starts),
            "first_word": min(starts) if starts else None,
            "last_word": max(starts) if starts else None,
            "base_labels": ",".join(sorted(base_labels)),
            "labels": ",".join(sorted(labels)),
            "score": score,
            "matches": matches,
        }


def vocabulary(templates=TEMPLATES) -> list[bytes]:
    return sorted({w for _, notice, _ in templates for w in words_of(notice)})


def licence_idf(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> dict[bytes, float]:
    """Inverse document frequency of each licence word over all files.

    Tasks count for themselves; what is added up and fetched are as many rows
    as the templates have different words.
    """
    vocab = frozenset(vocabulary(templates))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        n = 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                n += 1
                seen.update(vocab.intersection(words_of(t)))
        out = [(w.decode(), c) for w, c in seen.items()] + [("", n)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in out]), pa.array([c for _, c in out], pa.int64())],
            names=["word", "files"],
        )

    counted = with_code(docs.select(F.col(text))).mapInArrow(count, "word string, files long")
    totals = {r["word"]: r["files"] for r in counted.groupBy("word").agg(F.sum("files").alias("files")).collect()}
    n = totals.pop("", 0)
    return {w: math.log((1 + n) / (1 + totals.get(w.decode(), 0))) for w in vocab}


SCAN_SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, matches array<struct<label:string,begin:long,score:double>>"
)


def scan_licences(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates=TEMPLATES,
    base_phrases=BASE_PHRASES,
) -> DataFrame:
    """One row per file: key, counts of the base phrases, labels, score and every match.

    ``matches`` lists each verified template with the word it begins at.  No
    shuffle of files: both passes are per row.
    """
    index = LicenceIndex(templates, base_phrases, licence_idf(docs, text, templates))
    kind = docs.schema[key].dataType
    fields = [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        (
            "matches",
            pa.list_(pa.struct([("label", pa.string()), ("begin", pa.int64()), ("score", pa.float64())])),
        ),
    ]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [index.scan(t) for t in batch.column(1).to_pylist()]
            columns = [pa.array([r[n] for r in rows], k) if n != "matches" else pa.array(
                [[{"label": a, "begin": b, "score": s} for a, b, s in r["matches"]] for r in rows], k
            ) for n, k in fields]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["key", *(n for n, _ in fields)]
            )

    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return with_code(narrow).mapInArrow(scan, f"key {kind.simpleString()}, {SCAN_SCHEMA}").withColumnRenamed(
        "key", key
    )


@query("op10_license_scan")
def op10_license_scan(spark, sf_dir):
    found = scan_licences(load(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )
