"""Merge replay against the tokenizer library, and the exact way back."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tabloom.llm.bpe import MergeReplay, Words, decode_ids, encode_texts, read_ranks, slices

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SIGNS = ["a", "b", "the", " ", "  ", "\n", "1", "é", "中", "#", ".", "\x1c", "\x85", "'s", "<|endoftext|>",
         "\U0001e6c1", "\U00016ea1", "՘", "\U0001f600"]


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokens(replay, words):
    return np.frombuffer(b"".join(replay.encode([w.encode() for w in words])), np.int32).tolist()


def encoded(ranks, text):
    return tokens(MergeReplay(ranks), Words(public_tokenizers.PATTERN)(text))


def test_words_are_cut_as_the_library_does(ranks, library):
    rng = random.Random(1)
    names = [t.decode("utf8", "ignore") for t in ranks]
    replay, cut = MergeReplay(ranks), Words(public_tokenizers.PATTERN)
    for _ in range(500):
        text = "".join(rng.choice([*SIGNS, rng.choice(names)]) for _ in range(rng.randrange(1, 60)))
        assert tokens(replay, cut(text)) == library.encode_ordinary(text)


@pytest.mark.parametrize("signs", ["ab", "aab ", "the ans", "=-", "中文字"])
def test_long_words_with_overlapping_pairs(ranks, library, signs):
    rng = random.Random(signs)
    for n in (1, 2, 3, 50, 3000):
        text = "".join(rng.choice(signs) for _ in range(n))
        assert encoded(ranks, text) == library.encode_ordinary(text)


def test_a_merge_that_makes_a_lower_pair_waits_for_it():
    # "ab" (9) makes "abc" (8) possible, which must come before the second "ab".
    ranks = {bytes([b]): 100 + b for b in range(256)} | {b"abc": 8, b"ab": 9, b"bcab": 7}
    library = tiktoken.Encoding("odd", pat_str=r"\S+", mergeable_ranks={k: v for k, v in ranks.items()}, special_tokens={})
    for text in ("abcab", "abab", "abcabcab", "aabcb"):
        assert tokens(MergeReplay(ranks), [text]) == library.encode_ordinary(text)


def test_a_megabyte_without_a_break(ranks):
    assert len(encoded(ranks, "a" * 1_000_000)) < 1_000_000


def test_slices_hold_all_rows_in_order():
    assert list(slices([3, 3, 9, 1, 1], 6)) == [(0, 2), (2, 3), (3, 5)]
    assert list(slices([], 6)) == []


def test_tables(spark, ranks, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Hello world's  end\n", "x"), (3, "Hello world's  end\n", "x"),
            (None, "word " * 50_000, None), (5, "<|endoftext|>", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = encode_texts(df, ranks, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "text", "ids", "ids_"]
    back = decode_ids(found, ranks, ids="ids_").collect()
    assert len(back) == len(rows)
    for r in back:
        assert r["ids_"] == library.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert decode_ids(encode_texts(empty, ranks, public_tokenizers.PATTERN), ranks).collect() == []
    none = spark.createDataFrame([(None,)], "ids array<int>")
    assert bytes(decode_ids(none, ranks).first()["decoded"]) == b""
