"""Token alignment against whole texts and sets, on odd texts, and its parts."""

from functools import lru_cache

import numpy as np
import plain
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sessionflow.llm import queries, token_align

PATHS = [public_tokenizers.path(p) for p in queries.ALIGNED]
ODD = [
    None,
    "",
    " ",
    "  ",
    "\n",
    "a",
    "word ",
    "two  blanks   three    four \n  lines \t tabs ",
    " leading blank",
    "<|endoftext|> <s> </s> <unk> <0x41> plain",
    "lower ▁ block",
    "nbsp  here, ideographic　 space,   em, zero​ width, ﻿ mark",
    "été été ﬁn straße 你好 世界 слово \U0001f600 \U0001f468‍\U0001f469 x",
    "nul\x00byte \x1f unit \x85 next",
    "don't we'll I'm 12 345 6.7e8 --- ... !!!",
    "x" * 3000,
    "long words " * 20000,
]


@lru_cache
def whole_texts():
    words = token_align._Words(*PATHS)
    words.splits = False
    return words


@pytest.fixture(scope="module")
def odd_frame(spark):
    rows = [(i, t, "x", "x") for i, t in enumerate(ODD)] + [(None, "no id", "x", "x"), (5, "a", "x", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, align_row string, pair string").repartition(3)


def digests(aligned, **limits):
    counted = token_align.link_counts(aligned, token_align.pair_counts(aligned), **limits)
    return sorted((tuple(r) for r in token_align.digests(counted).collect()), key=repr)


def test_odd_texts(odd_frame):
    aligned = token_align.align(odd_frame, *PATHS)
    texts = {i: t for i, t in enumerate(ODD)} | {None: "no id", "again": "a"}
    want = plain.aligned(texts, *PATHS)
    rows = sorted(((5 if i == "again" else i, *want[i]) for i in texts), key=repr)
    assert digests(aligned) == rows
    assert want[10] == (0, 0, 0, 0, 0, 0, "")  # the block becomes a blank


def test_rare_pairs_by_joins(odd_frame):
    aligned = token_align.align(odd_frame, *PATHS)
    assert digests(aligned, hot_pairs=20) == digests(aligned) == digests(aligned, hot_pairs=0)


def test_whole_texts_where_words_cannot_be_split(odd_frame):
    aligned = token_align.align(odd_frame, *PATHS)
    words, by_word = whole_texts(), token_align._Words(*PATHS)
    for text in [t for t in ODD if t]:
        data = np.frombuffer(text.encode(), np.uint8)
        offsets = np.array([0, len(data)])
        assert [c.to_pylist() for c in token_align._aligned(data, offsets, words)] == [c.to_pylist() for c in token_align._aligned(data, offsets, by_word)]
    assert aligned.columns == ["doc_id", "pair", "align_a_ids", "align_b_ids", "align_a_closes", "align_b_closes", "align_row"]


def test_a_small_cache_of_words(monkeypatch):
    words = token_align._Words(*PATHS)
    monkeypatch.setattr(token_align, "CACHED_WORDS", 3)
    other = token_align._Words(*PATHS)
    for text in ["a b c d e", "c d e f g h", "a a a"]:
        data = np.frombuffer(text.encode(), np.uint8)
        assert token_align._aligned(data, np.array([0, len(data)]), words) == token_align._aligned(data, np.array([0, len(data)]), other)


def test_empty_table(spark, odd_frame):
    assert digests(token_align.align(odd_frame.limit(0), *PATHS)) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab c\n\t.'1é世　  ▁<s>")), max_size=40), max_size=5))
def test_random_texts_by_words_and_whole(texts):
    data = [t.encode() for t in texts]
    flat, offsets = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    assert token_align._aligned(flat, offsets, token_align._words(*PATHS)) == token_align._aligned(flat, offsets, whole_texts())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 400)), st.sets(st.integers(1, 400)), st.integers(401, 420)), min_size=1, max_size=4))
def test_common_ends(pieces):
    a, b, a_cuts, b_cuts, at = [], [], [0], [0], 0
    for first, second, end in pieces:
        a += [at + x for x in sorted(first | {end})]
        b += [at + x for x in sorted(second | {end})]
        a_cuts.append(len(a))
        b_cuts.append(len(b))
        at += end
    in_a, in_b = token_align.common_ends(*map(np.array, (a, b, a_cuts, b_cuts)))
    assert [x for x, hit in zip(a, in_a) if hit] == [x for x, hit in zip(b, in_b) if hit] == sorted(set(a) & set(b))


def test_long_stretches_and_lanes():
    rnd = np.random.default_rng(5)
    a = np.unique(rnd.integers(1, 200_000, 60_000))
    b = np.unique(np.concatenate([a[rnd.random(len(a)) < 0.9], rnd.integers(1, 200_000, 3_000), a[-1:]]))
    b = b[b <= a[-1]]
    in_a, in_b = token_align.common_ends(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
    assert (in_a == np.isin(a, b)).all() and (in_b == np.isin(b, a)).all()
