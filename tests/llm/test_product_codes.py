"""Codes by range masks against exhaustive search and a plain fit."""

import math
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from tabloom import llm
from tabloom.llm import product_codes as pc


@pytest.mark.parametrize("high", [2, 100, 10**6, 10**30])
@pytest.mark.parametrize("entries", [1, 16, 64, 90])
def test_masks_find_the_nearest_entry(high, entries):
    rng = np.random.default_rng(entries)
    for d in (1, 3, 8):
        e, x = rng.integers(-1000, 1000, (entries, d)), rng.integers(-1000, 1000, (200, d))
        if high < 1000:
            e, x = e % high, x % high
        elif high > 10**9:
            e, x = e.astype(object) * high, x.astype(object) * high
        squares = [[sum((int(a) - int(b)) ** 2 for a, b in zip(u, v, strict=True)) for v in e] for u in x]
        masks = pc.RangeMasks(e)
        found, least = masks.nearest(x)
        assert found.tolist() == [s.index(min(s)) for s in squares]
        assert [int(v) for v in least] == [min(s) for s in squares]
        bits = np.unpackbits(masks.candidates(x).view(np.uint8), axis=1, bitorder="little")
        assert all(bits[i, s.index(min(s))] for i, s in enumerate(squares))


def test_integers_are_floors():
    x = np.array([[-1 / 4096, -0.5 / 4096, 0.0, 1.99 / 4096, 3e9, -3e9, 1e300, 1.0]])
    assert pc.integer_parts(x).ravel().tolist() == [-1, -1, 0, 1, 4096 * 3 * 10**9, -4096 * 3 * 10**9, 10**50, 4096]
    assert pc.integer_parts(np.ones((2, 3))).shape == (2, 8, 1)


def plain(rows):
    rows = [r for r in rows if r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1])]
    ints = [[math.floor(4096 * v) for v in r[1]] for r in rows]
    d = len(ints[0]) // 8
    first = sorted(range(len(rows)), key=lambda i: rows[i][0])[:16]
    books = [[ints[i][p * d : (p + 1) * d] for i in first] for p in range(8)]

    def near(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(e, x, strict=True)), i) for i, e in enumerate(book))

    for _ in range(6):
        for p in range(8):
            groups = defaultdict(list)
            for x in ints:
                groups[near(books[p], x[p * d : (p + 1) * d])[1]].append(x[p * d : (p + 1) * d])
            for i, m in groups.items():
                books[p][i] = [sum(c) // len(m) for c in zip(*m, strict=True)]
    sha = sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out, labels = {}, Counter()
    for r, x in zip(rows, ints, strict=True):
        found = [near(books[p], x[p * d : (p + 1) * d]) for p in range(8)]
        out[r[0]] = "".join(f"{i:02x}" for _, i in found), sum(s for s, _ in found)
        labels[r[2]] += out[r[0]][1]
    return {r[0]: (r[0], *out[r[0]], labels[r[2]], sha) for r in rows}


def test_query_matches_a_plain_fit(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=16) * rng.choice([0.01, 1, 5])], int(i % 3) if i % 7 else None) for i in range(300)]
    rows += [(1000, None, 1), (1001, [float("nan")] * 16, 1), (1002, [None] + [1.0] * 15, 1), (1003, [float("inf")] * 16, 1)]
    rows += [(1100 + i, [0.0] * 16, 1) for i in range(20)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = [(r[0], r[1] and [None if v is None else float(np.float32(v)) for v in r[1]], r[2]) for r in rows]
    found = llm.all_queries()["op11_product_codes"](spark, str(tmp_path)).collect()
    assert {r["vec_id"]: tuple(r) for r in found} == plain(rows)


def test_odd_tables(spark):
    kind = "vec_id long, embedding array<double>, code string"
    rows = [(1, [1.0] * 8, "x"), (1, [1.0] * 8, "x"), (None, [2.0] * 8, "x"), (3, [1.0, 2.0], "y"), (4, [], "z"), (5, [1e40] * 8, "w")]
    df = spark.createDataFrame(rows, kind)
    books = pc.fit_codebooks(df)
    found = pc.with_codes(df, books).collect()
    assert len(found) == len(rows)
    assert {tuple(r)[2:4] for r in found if r["vec_id"] == 1} == {("x", "00" * 8)}
    assert all(r["error"] == 0 for r in found)
    empty = spark.createDataFrame([], kind)
    assert pc.fit_codebooks(empty) == {}
    assert pc.with_codes(empty, {}).columns == ["vec_id", "embedding", "code", "code_", "error"]
    assert pc.with_codes(empty, {}).collect() == []


def test_group_sums_with_a_hot_group_and_nulls(spark):
    rows = [(i, None if i % 2 else i % 50, i) for i in range(40_000)]
    df = spark.createDataFrame(rows, "id long, g int, v long")
    want = Counter()
    for _, g, v in rows:
        want[g] += v
    found = pc.with_group_sum(df, "g", "v", "s").collect()
    assert len(found) == len(rows) and all(r["s"] == want[r["g"]] for r in found)
