"""Operators on documents against plain versions, and on odd rows."""

import hashlib
import math
import random
import struct
import tracemalloc
import types
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import plain
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sessionflow.llm import bpe_lexicon, minhash, mixing, quality_crf, suffix_dedup, suffix_tree_lm, toxicity
from sessionflow.llm.texts import shingle_hashes, word_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}" for i in range(40_000))
PATH = public_tokenizers.path("word_bpe_49k.json")


def odd_rows():
    passage = "A passage of quite some length, which stands in several of these documents, word for word."
    texts = [None, "", " \n\t ", "one", "one", "two words", LONG, LONG + " end", passage, f"Before it. {passage} After it.", passage, "é" * 80, "x" + "é" * 80]
    texts += [f"{passage} {passage}", "\x00 nul \x00", "a b c d e f g h i j k", "A B c d e f g h i j k", "STOP!! NOW!! STOP!!\nfine line here"]
    return [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 2}", None) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, copies, and columns named like those that operators use."""
    rows = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    clashing = ["key", "rep", "component_id", "hash", "size", "mix_size", "mix_target", "tox_severity", "suffix_text", "suffix_kept", "bpe_ids", "quality_score", "label", "held_out", "row", "n"]
    return rows.select("*", *[F.lit("x").alias(c) for c in clashing])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i != 17), int(i == 17), "x") for i in range(1, 18)], "doc_id long, quality int, toxic int, text string")


def texts_of(rows):
    return {r[0]: r[1] for r in rows}


def random_texts(seed, n, words=30):
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice(["alpha", "Beta", "gamma", "d", "eps"]) + str(rnd.randint(0, 40)) for _ in range(words)) for _ in range(4)]
    made = []
    for _ in range(n):
        parts = rnd.choice(base).split(" ")
        for _ in range(rnd.randint(0, 4)):
            parts[rnd.randrange(len(parts))] = rnd.choice(["new", "é", "x" * rnd.randint(1, 9)])
        made.append(" ".join(parts[rnd.randint(0, 4) :]) + rnd.choice(["", " ", "\n tail"]))
    return made


# --- suffix-array dedup --------------------------------------------------------------------------


def cut(docs, length=50):
    rows = suffix_dedup.remove_repeats(docs, length=length).collect()
    return {r["doc_id"]: (r["suffix_bytes"], r["suffix_removed"], r["suffix_spans"], hashlib.sha256(r["suffix_kept"]).hexdigest()) for r in rows}


def test_suffix_odd_rows(odd):
    assert cut(odd) == plain.cut_repeats(texts_of(odd_rows()), 50)


@pytest.mark.parametrize("seed,length", [(1, 50), (2, 20), (3, 33)])
def test_suffix_random(spark, seed, length):
    texts = dict(enumerate(random_texts(seed, 60)))
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(4)
    assert cut(docs, length) == plain.cut_repeats(texts, length)


@pytest.mark.parametrize("hot", [0, 5, 100])
def test_suffix_hot_anchors(spark, odd, hot):
    """What is cut does not depend on how the neighbourhoods of an anchor are dealt."""
    passage = "A passage that a third of all documents holds, between texts that differ in each of them."
    texts = {i: f"{i * 7919} {passage} {i * 104729} or {i} so" for i in range(100, 400)} | dict(enumerate(random_texts(4, 60))) | {1000 + i: t for i, t in texts_of(odd_rows()).items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    rows = suffix_dedup.remove_repeats(docs, hot=hot).collect()
    found = {r["doc_id"]: (r["suffix_bytes"], r["suffix_removed"], r["suffix_spans"], hashlib.sha256(r["suffix_kept"]).hexdigest()) for r in rows}
    assert found == plain.cut_repeats(texts, 50)


def test_suffix_chunk_sends_a_hot_anchor_twice_at_most(spark):
    """However many neighbourhoods it has there; windows go to many buckets, each once."""
    passage = "A passage that all of these documents hold, between texts that differ in each of them."
    docs = spark.createDataFrame([(i, f"{i * 7919} {passage} {i * 104729}") for i in range(500)], "doc_id long, text string").coalesce(1)
    chunks = suffix_dedup._pack(docs.selectExpr("doc_id", "cast(text as binary) suffix_text"), "doc_id").collect()
    chunk = suffix_dedup.Chunk(chunks[0]["ids"], chunks[0]["lengths"], chunks[0]["data"], 50, 1)
    assert max(Counter(chunk.gram[chunk.first].tolist()).values()) > 400
    told = Counter(r for c in suffix_dedup._tell(spark.createDataFrame(chunks), 50, 1).collect() for r in np.cumsum(suffix_dedup.unpacked(c["content"])["step"], dtype=np.uint32).tolist())
    assert max(told.values()) == 2


def packed_chunk(texts):
    data = [t.encode() for t in texts]
    ids, lengths = np.arange(len(data)), np.array([len(d) for d in data])
    return ids.tobytes(), lengths.tobytes(), suffix_dedup.zstandard.compress(b"".join(data))


def test_a_chunk_is_looked_through_in_blocks():
    texts = random_texts(9, 2000, words=60)
    chunk = packed_chunk(texts)
    size = sum(len(t.encode()) for t in texts)
    suffix_dedup.Chunk(*chunk, 50, 4)  # powers are kept
    tracemalloc.start()
    suffix_dedup.Chunk(*chunk, 50, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 26 * size


@pytest.mark.parametrize("block", [1, 7, 40, 1000])
def test_blocks_do_not_move_anchors(block):
    data = [t.encode() for t in ["short", "", *random_texts(11, 12), "x" * 49, "y" * 50, "ab" * 90, ""]]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    rolling = suffix_dedup.Rolling(np.frombuffer(b"".join(data), np.uint8))
    hashes = rolling.windows(suffix_dedup.GRAM) | np.uint64(1)
    wanted = set()
    for a, b in zip(offsets, offsets[1:]):
        for s in range(a, b - 49):
            stretch = hashes[s : s + 35]
            wanted.update((s + np.flatnonzero(stretch == stretch.min())).tolist())
    places, grams = suffix_dedup.find_anchors(rolling, offsets, 50, block)
    assert places.tolist() == sorted(wanted)
    assert grams.tolist() == hashes[places].tolist()


def test_occurrences_travel_without_names_and_hashes():
    """For the removal a chunk is told places, lengths and documents: a few bytes for each occurrence."""
    rnd = random.Random(3)
    passage = [" ".join(str(rnd.randint(0, 9999)) for _ in range(30)) for _ in range(40)]
    chunk = packed_chunk([f"{rnd.random()} {rnd.choice(passage)} {rnd.random()}" for _ in range(600)])
    row = pd.DataFrame([(0, *chunk)], columns=["chunk", "ids", "lengths", "data"])
    told = next(suffix_dedup._tell(FakeRows(), 50, 1)(iter([pa.RecordBatch.from_pandas(row)]))).to_pandas()
    sent = suffix_dedup._send_mixed(50, 1)(row, suffix_dedup._answer(np.inf)(told))
    assert set(sent["bucket"]) <= set(range(suffix_dedup.FINE))
    made = [suffix_dedup.unpacked(c) for b in sorted(set(sent["bucket"])) for c in suffix_dedup._find_spans(50, suffix_dedup.FINE, False)(sent[sent["bucket"] == b].reset_index())["content"]]
    assert sum(len(m["start"]) for m in made) > 300
    assert {k: v.dtype.itemsize for k, v in made[0].items()} == {"bucket": 8, "step": 4, "start": 1, "length": 1, "least": 8}


class FakeRows:
    """Hands out the function that rows would go through."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def neighbourhoods(fine):
    """A group of neighbourhoods that a chunk sends when all anchors are told apart by their bytes."""
    passages = random_texts(3, 300, 12)
    texts = [f"{i} {p} {i % 7}" for i, p in enumerate(passages * 2)]
    chunk = suffix_dedup.Chunk(*packed_chunk(texts), 50, fine)
    entry, cuts = suffix_dedup._mixed(chunk, np.full(len(chunk.first), suffix_dedup.MIXED, np.uint8), fine)
    return chunk, entry, cuts


@pytest.mark.parametrize("buckets", [2, 4, 6])
def test_all_buckets_take_anchors(buckets):
    chunk, _, cuts = neighbourhoods(buckets)
    assert set(chunk.bucket.tolist()) == set(range(buckets))
    assert (np.diff(cuts) > 0).all()


def test_suffix_arrays_are_made_of_parts_of_a_group(monkeypatch):
    chunk, entry, _ = neighbourhoods(1)
    at = chunk.first[entry]
    data = b"".join(chunk.data[a:b].tobytes() for a, b in zip(chunk.start[at], chunk.stop[at]))
    size = (chunk.stop[at] - chunk.start[at]).astype(np.uint8)
    content = suffix_dedup.packed(
        gram=chunk.gram[at], around=chunk.around[at], doc=chunk.doc[at], several=chunk.several[entry], size=size, data=np.frombuffer(data, np.uint8)
    )
    frame = pd.DataFrame({"bucket": [0], "chunk": [0], "content": [content]})
    taken = []
    whole = suffix_dedup.maximal_repeats
    monkeypatch.setattr(suffix_dedup, "maximal_repeats", lambda texts, sizes, *a: taken.append(int(sizes.sum())) or whole(texts, sizes, *a))

    def gone(part_bytes):
        monkeypatch.setattr(suffix_dedup, "PART_BYTES", part_bytes, raising=False)
        found = suffix_dedup.unpacked(suffix_dedup._find_spans(50, 1, False)(frame)["content"][0])
        own = at[np.cumsum(found["step"], dtype=np.int64)]
        start = chunk.start[own] + found["start"]
        cut = zip(start, start + found["length"], chunk.doc[own] > found["least"])
        return {p for a, b, later in cut if later for p in range(a, b)}

    at_once = gone(1 << 40)
    assert at_once and len(taken) == 1
    assert gone(4000) == at_once
    assert max(taken[1:]) < 8000 < taken[0]  # an anchor is not divided


def test_suffix_null_ids_and_repeated_rows(spark, empty):
    text = "the same text of more than fifty bytes in each of the rows"
    rows = spark.createDataFrame([(None, text), (5, text), (5, text), (6, text)], "doc_id long, text string")
    found = sorted((r["doc_id"] or 0, r["suffix_removed"]) for r in suffix_dedup.remove_repeats(rows).collect())
    assert found == [(0, 0), (5, 0), (5, 0), (6, len(text))]
    assert suffix_dedup.remove_repeats(empty).collect() == []
    assert suffix_dedup.repeats(empty).collect() == []


def test_suffix_whole_characters(spark):
    rows = spark.createDataFrame([(1, "é" * 60), (2, "aé" + "é" * 60 + "b")], "doc_id long, text string")
    kept = {r["doc_id"]: r["suffix_kept"].decode() for r in suffix_dedup.remove_repeats(rows, whole_characters=True).collect()}
    assert kept == {1: "é" * 60, 2: "ab"}


def test_repeats_list_all_occurrences(spark):
    passage = "0123456789" * 6 + "abcdefghij"
    texts = {1: f"x{passage}y", 2: f"{passage} z", 3: f"q{passage}", 4: "nothing of it here, but long enough to have a window of its own, is it?"}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = suffix_dedup.repeats(rows).collect()
    groups = {}
    for r in found:
        data = texts[r["doc_id"]].encode()[r["start"] : r["start"] + r["length"]]
        groups.setdefault(r["repeat"], set()).add(data)
        assert data in passage.encode()
    assert all(len(g) == 1 for g in groups.values())  # a name is one string
    assert {r["doc_id"] for r in found} == {1, 2, 3}
    assert (1, 1) in {(r["doc_id"], r["start"]) for r in found}


def test_stack_scan_finds_left_diverse_intervals():
    texts = [b"Xabcdefgh1", b"Yabcdefgh2", b"Yabcdefzzz"]
    sizes = np.array([len(t) for t in texts])
    matrix = np.array([list(t) for t in texts], dtype=np.uint8)
    of, start, long, least, _ = suffix_dedup.maximal_repeats(matrix, sizes, np.array([1, 2, 3]), np.zeros(3, bool), 6)
    found = sorted(zip(of.tolist(), start.tolist(), long.tolist(), least.tolist()))
    # "abcdef" in all three, "abcdefgh" in two, "Yabcdef" in two
    assert found == [(0, 1, 6, 1), (0, 1, 8, 1), (1, 0, 7, 2), (1, 1, 6, 1), (1, 1, 8, 1), (2, 0, 7, 2), (2, 1, 6, 1)]


def test_the_order_of_suffixes_takes_little_more_than_their_bytes():
    rnd = np.random.default_rng(5)
    texts = rnd.integers(97, 99, (3000, 84), dtype=np.uint8)
    text, start = (x.ravel() for x in np.mgrid[0:3000, 0:35])
    tracemalloc.start()
    order = suffix_dedup._suffix_order(texts, text, start)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * len(text) * 88
    whole = [bytes(texts[t, s:]).ljust(84, b"\0") for t, s in zip(text.tolist(), start.tolist())]
    assert [whole[i] for i in order] == sorted(whole)


# --- MinHash -------------------------------------------------------------------------------------


def found_components(docs, **options):
    rows = minhash.near_duplicates(docs, **options).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


@pytest.mark.parametrize("width", [4, 5])
def test_minhash_odd_rows(odd, width):
    assert found_components(odd, width=width) == plain.near_duplicates(texts_of(odd_rows()), width, 80)


@pytest.mark.parametrize("seed", [1, 2])
def test_minhash_random(spark, seed):
    texts = dict(enumerate(random_texts(seed, 150, words=60)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert found_components(docs, width=4) == plain.near_duplicates(texts, 4, 80)


def test_minhash_null_id_and_empty(spark, empty):
    rows = spark.createDataFrame([(None, "a b c d e"), (1, "a b c d e")], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(rows).collect()} == {(None, None, True), (1, 1, True)}
    assert minhash.near_duplicates(empty).collect() == []


def test_least_matches_bound_the_miss_probability():
    for n, m in minhash.least_matches(0.8, 1e-7):
        below = sum(math.comb(n + 1, k) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(m))
        assert below < 1e-7 <= below + math.comb(n + 1, m) * 0.8**m * 0.2 ** (n + 1 - m)


def test_shingles_of_bytes_equal_those_of_words():
    texts = [t or "" for t in texts_of(odd_rows()).values()]
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    words, counts = word_hashes(np.frombuffer(b"".join(data), np.uint8), offsets)
    assert counts.tolist() == [len(plain.lower_words(t)) for t in texts]
    assert shingle_hashes(words, counts, 4)[1].tolist() == [len(plain.shingles(t, 4)) for t in texts]


# --- BPE -----------------------------------------------------------------------------------------


def test_bpe_equals_the_library(spark, odd, empty):
    tokenizer = Tokenizer.from_file(PATH)
    rnd = random.Random(3)
    pieces = ["the", "it's", "we'LL", "Straße", "ΣΑΣ", "İx", "é", "é", " ", "\x1c", "\x1fq", "\x85", "<|endoftext|>", "12", "½", "日本語", "!!", "’s", "a" * 120, "\x00", "﻿", " "]
    texts = ["".join(rnd.choice(pieces) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 25))) for _ in range(300)]
    docs = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = docs.unionByName(odd.select("doc_id", "text", "bpe_ids"), allowMissingColumns=True)
    name = bpe_lexicon.build_lexicon(docs.limit(150), PATH, words=200)
    for row in bpe_lexicon.encode(docs, PATH, name, with_decoded=True).collect():
        want = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids
        assert list(struct.unpack(f"<{row['bpe_tokens']}I", row["bpe_ids"])) == want
        assert row["bpe_decoded"] == tokenizer.decode(want, skip_special_tokens=False)
    nothing = bpe_lexicon.build_lexicon(empty, PATH)
    assert bpe_lexicon.encode(empty, PATH, nothing).collect() == []


def test_lexicon_shares_suffixes(tmp_path):
    words = {w.encode(): (i, i + 1) for i, w in enumerate(["walking", "talking", "walked", "talked", "walk", "é"])}
    file = tmp_path / "lexicon"
    file.write_bytes(bpe_lexicon.compile_lexicon(words))
    lexicon = bpe_lexicon.Lexicon(str(file))
    order = sorted(words)
    numbers = lexicon.lookup(pa.array([*order, b"wal", b"", b"walkingx", b"zebra"], pa.large_binary()))
    assert numbers.tolist() == [*range(len(order)), -1, -1, -1, -1]
    assert [tuple(lexicon.ids[lexicon.offsets[k] : lexicon.offsets[k + 1]]) for k in numbers[: len(order)]] == [words[w] for w in order]
    assert len(lexicon.final) == 14  # a tree without shared endings has 21 states


# --- classifiers ---------------------------------------------------------------------------------


def test_toxicity_of_odd_rows(odd, labels, empty):
    model = toxicity.fit(odd, labels)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(odd_rows())
    assert all(0 <= r["tox_severity"] <= 3 and 0 <= r["tox_probability"] <= 1 for r in rows)
    assert toxicity.score(empty, toxicity.fit(empty, labels)).collect() == []


def test_toxicity_without_labels_rejects_nothing(odd, labels):
    model = toxicity.fit(odd, labels.where("false"))
    assert not any(r["tox_rejected"] for r in toxicity.score(odd, model).collect())


def test_toxicity_grades_follow_the_evidence():
    rnd = random.Random(5)
    plain_words = [f"w{i}" for i in range(300)]
    texts, toxic = [], []
    for i in range(400):
        words = rnd.choices(plain_words, k=40)
        bad = i % 4 == 0
        words += rnd.choices(["vileness", "rotten", "horrid"], k=rnd.choice([2, 4, 12])) if bad else []
        texts.append(toxicity.text_features(" ".join(words)))
        toxic.append(bad)
    features = [np.fromiter(f, np.int32, len(f)) for f in texts]
    counts = [np.fromiter(f.values(), np.int32, len(f)) for f in texts]
    model = toxicity.fit_rows(features, counts, np.array(toxic))
    assert list(model.thresholds) == sorted(model.thresholds)
    severity = lambda t: sum(model.above(toxicity._text_score(t, model, {})))
    calm, bad, worse = "w1 w2 w3", "w1 rotten vileness w2", "rotten vileness horrid " * 5
    assert severity(calm) < 0.3 < severity(bad) < severity(worse)


def test_quality_of_odd_rows(odd, labels, empty):
    model = quality_crf.fit(odd, labels)
    rows = quality_crf.score(odd, model).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["quality_score"] <= 1 for r in rows)
    assert quality_crf.score(empty, quality_crf.fit(empty, labels)).collect() == []
    alone = quality_crf.fit(odd, labels.where("quality = 1"))
    assert {r["quality_score"] for r in quality_crf.score(odd, alone).collect()} == {1.0}


def test_messages_equal_enumeration():
    rnd = np.random.default_rng(1)
    counts = np.array([1, 4, 0, 3])
    scores, bonus = rnd.normal(size=8), 0.7
    forward, backward = quality_crf.messages(scores, counts, bonus)
    at = 0
    for n in counts:
        own, total = scores[at : at + n], np.zeros(n)
        norm = 0.0
        for state in range(1 << n):
            y = np.array([state >> i & 1 for i in range(n)])
            p = math.exp(float(own @ y) + bonus * float((y[1:] == y[:-1]).sum()))
            total, norm = total + p * y, norm + p
        marginal = 1 / (1 + np.exp(-(forward + backward)[at : at + n]))
        assert np.allclose(marginal, total / norm)
        at += n


def test_quality_learns_bad_lines(spark):
    rnd = random.Random(2)
    rows, marks = [], []
    for i in range(120):
        lines = [" ".join(rnd.choice(["the", "house", "runs", "over", "blue", "fields"]) for _ in range(12)) + "." for _ in range(4)]
        if i % 3 == 0:
            lines[1:] = ["BUY!! NOW!! " * 6] * 3
        rows.append((i, "\n".join(lines)))
        marks.append((i, int(i % 3 != 0)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int")
    model = quality_crf.fit(docs, labels, usable=F.col("doc_id") < 80)
    found = {r["doc_id"]: r["quality_score"] for r in quality_crf.score(docs, model).collect()}
    assert all((found[i] >= 0.7) == bool(q) for i, q in marks)


# --- language model ------------------------------------------------------------------------------


def test_base_scores_and_counts(odd):
    rows = {r["doc_id"]: r for r in suffix_tree_lm.scores(odd.drop("held_out"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in rows}
    tokens = {i: [*plain.lower_words(t), None] for i, t in texts_of(odd_rows()).items()}
    count = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    total, distinct = sum(count.values()), len(count)
    for i, r in rows.items():
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens[i])
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(tokens[i]), sum(count[w] > 0 for w in tokens[i]), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9, abs_tol=1e-9)


def test_tree_is_a_distribution(spark):
    texts = random_texts(7, 200)
    rows = spark.createDataFrame([(t.encode(),) for t in texts], "text binary")
    tree = suffix_tree_lm.learn(rows)
    assert any((r < 1).any() for r in tree.rests)  # contexts are kept
    unknown = 0.5 / tree.total
    assert len(tree.vocabulary) < tree.words or tree.words == len(tree.vocabulary)
    rare = (tree.tokens - tree.counts.sum() + 0.5 * (tree.words - len(tree.vocabulary))) / tree.total
    for d, rest in enumerate(tree.rests):
        for c in np.flatnonzero(rest < 1)[:20]:
            word = np.arange(len(tree.vocabulary))
            p = tree._probability(d + 1, np.zeros(0, np.int64), np.zeros(0, np.int64)) if False else None
            context = np.full(len(word), c)
            lower = tree._probability(d, context, word)
            at = suffix_tree_lm._find(tree.keys[d], suffix_tree_lm.pair_keys(context, word))
            p = np.where(at >= 0, tree.shares[d][np.maximum(at, 0)], 0) + rest[c] * lower
            # words out of the vocabulary get the product of the rests
            chain, s, k = rest[c], c, d
            while k:
                s = tree.suffixes[k - 1][s]
                k -= 1
                chain *= tree.rests[k][s]
            assert math.isclose(p.sum() + chain * (rare + unknown), 1.0, rel_tol=1e-9)


def test_rare_contexts_of_a_large_corpus_count(spark):
    """Three million training tokens more, of other words, do not take entries out of the tree."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(i, text) for i in range(4)], "doc_id long, text string")
    other = spark.range(1000, 1050).select(F.col("id").alias("doc_id"), F.expr("concat_ws(' ', transform(sequence(1, 80000), i -> concat('z', i % 100)))").alias("text"))
    gain = {}
    for name, docs in (("small", rows), ("large", rows.unionByName(other))):
        found = suffix_tree_lm.scores(docs, F.col("doc_id") % 5 == 1).where("doc_id < 1000").collect()
        gain[name] = sum(r["score"] - r["base_score"] for r in found)
    assert gain["large"] > 0.95 * gain["small"] > 0


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_buckets_give_the_scores_of_the_tree(spark, odd, depth, monkeypatch):
    monkeypatch.setattr(suffix_tree_lm, "BUCKET_RUNS", 3_000)
    texts = list(enumerate([*random_texts(7, 200), *random_texts(8, 100)], 1000))
    rows = spark.createDataFrame([*texts, (None, "alpha1 alpha2")], "doc_id long, text string").unionByName(odd.select("doc_id", "text")).repartition(5)
    held = F.coalesce(F.col("doc_id"), F.lit(0)) % 5 == 1
    ways = [suffix_tree_lm.scores(rows, held, depth=depth, tree_tokens=n).collect() for n in (1 << 40, 0)]
    tree, buckets = (sorted(map(tuple, w), key=repr) for w in ways)
    assert any(r["score"] != r["base_score"] for r in ways[0])
    assert [r[:5] for r in buckets] == [r[:5] for r in tree]
    assert np.allclose([r[5:] for r in buckets], [r[5:] for r in tree], rtol=1e-9)


def test_later_steps_carry_numbers_not_hashes(spark, monkeypatch):
    """Hashes of words go once, for the first step; what is kept of longer runs is a few bytes each."""
    rnd = random.Random(5)
    names = [f"w{i}" for i in range(120)]
    rows = spark.createDataFrame([(i, " ".join(rnd.choices(names, k=2000) + [f"once{i}x{k}" for k in range(1000)])) for i in range(40)], "doc_id long, text string")
    kept, write = {}, suffix_tree_lm.write_step

    def recorded(df, name):
        table = write(df, name)
        kept[name] = table.agg(F.sum(F.length("content"))).first()[0]
        return table

    monkeypatch.setattr(suffix_tree_lm, "write_step", recorded)
    found = suffix_tree_lm.scores(rows.coalesce(1), F.lit(False), tree_tokens=0).collect()
    assert len(found) == 40 and all(r["score"] > r["base_score"] for r in found)
    assert kept["lm-counts-2"] < 4 * 120 * 120


@pytest.mark.parametrize("words", [50, 1 << 40])
def test_distinct_pairs(words):
    """Sorted with their places in one number, or, without room for that, places by pairs."""
    rnd = np.random.default_rng(3)
    head, word = rnd.integers(0, 40, 5000), rnd.integers(0, 50, 5000)
    place, back = suffix_tree_lm._distinct(head, word, words)
    pairs = list(zip(head.tolist(), word.tolist()))
    want = sorted(set(pairs))
    assert [pairs[i] for i in place] == want and [want[i] for i in back] == pairs
    assert place.tolist() == [pairs.index(p) for p in want]
    assert [len(x) for x in suffix_tree_lm._distinct(head[:0], word[:0], words)] == [0, 0]


def test_a_chunk_takes_each_answer_apart_once(monkeypatch):
    rnd = random.Random(9)
    texts = pa.array([" ".join(rnd.choices([f"w{i}" for i in range(30)], k=200)).encode() for _ in range(20)], pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array([False] * 20), texts], ["doc_id", "held_out", "text"])
    monkeypatch.setattr(suffix_tree_lm, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    chunks = pd.concat(b.to_pandas() for b in suffix_tree_lm._chunked(1 << 20)(iter([batch])))
    buckets, total, bases, answers = 3, 4020 + 0.5 * 32, (), []
    for length in (1, 2):
        known = pd.concat(answers) if answers else None
        asked = suffix_tree_lm._ask(buckets, total, bases)(chunks, known)
        counted = pd.concat(suffix_tree_lm._add_up(length, True)(f.reset_index(drop=True)) for _, f in asked.groupby("bucket"))
        frequent = counted.groupby("bucket")["frequent"].sum().reindex(range(buckets), fill_value=0)
        bases += (np.cumsum([0, *frequent]),)
        answers.append(counted)
    taken, unpack = Counter(), suffix_tree_lm.unpacked
    monkeypatch.setattr(suffix_tree_lm, "unpacked", lambda content: taken.update([content]) or unpack(content))
    entries = suffix_tree_lm.Runs(chunks["content"].iloc[0], buckets, total, bases, pd.concat(answers)).entries()
    assert entries["parts"].sum() > 30 and max(taken.values()) == 1


def test_pieces_grow_no_faster_than_the_texts(spark, monkeypatch):
    """Every chunk asks every bucket: with both of fixed size, four times the texts made sixteen times the pieces."""
    for name, value in (("CHUNK_BYTES", 1 << 13), ("BUCKET_RUNS", 2_000), ("LEVEL_BYTES", 1 << 16)):
        monkeypatch.setattr(suffix_tree_lm, name, value, raising=False)
    pieces, write = {}, suffix_tree_lm.write_step

    def recorded(df, name):
        table = write(df, name)
        pieces[name] = table.count()
        return table

    monkeypatch.setattr(suffix_tree_lm, "write_step", recorded)
    texts = [t for t in random_texts(11, 2000) if t and len(t) < 1 << 12]
    part = next(n for n in range(1, len(texts)) if sum(map(len, texts[:n])) > 1 << 16)
    made = []
    for times in (1, 4):
        rows = spark.createDataFrame(list(enumerate((texts[:part] * times))), "doc_id long, text string").coalesce(1)
        ways = [suffix_tree_lm.scores(rows, F.col("doc_id") % 5 == 1, tree_tokens=n).collect() for n in (1 << 40, 0)]
        tree, buckets = (sorted(map(tuple, w)) for w in ways)
        assert [r[:5] for r in buckets] == [r[:5] for r in tree] and np.allclose([r[5:] for r in buckets], [r[5:] for r in tree], rtol=1e-9)
        made.append(pieces["lm-counts-1"])
    assert made[0] >= 16 and made[1] < 6 * made[0]


def test_scores_of_nothing(empty, spark):
    assert suffix_tree_lm.scores(empty, F.lit(False)).collect() == []
    rows = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    only = suffix_tree_lm.scores(rows, F.lit(True)).first()
    assert only["train_tokens"] == 0 and only["n_known"] == 0 and math.isclose(only["score"], only["base_score"])


# --- mixing --------------------------------------------------------------------------------------


def test_mixing_targets_and_budgets(odd, empty):
    rows = mixing.mix(odd).collect()
    sizes = {r["doc_id"]: len(plain.lower_words(r["text"])) for r in rows}
    by_source = {}
    for r in rows:
        assert r["mix_size"] == sizes[r["doc_id"]] and 0 <= r["mix_copies"] <= 2
        by_source.setdefault(r["source"], []).append(r)
    assert math.isclose(sum(g[0]["mix_target"] for g in by_source.values()), 1.5 * sum(sizes.values()))
    for group in by_source.values():
        size, target = group[0]["mix_source_size"], group[0]["mix_target"]
        taken = sum(r["mix_copies"] * r["mix_size"] for r in group)
        assert size == sum(r["mix_size"] for r in group) and target <= 2 * size
        assert target - max(r["mix_size"] for r in group) <= taken <= target
    assert mixing.mix(empty).collect() == []
    repeated = mixing.repeated(mixing.mix(odd))
    assert repeated.count() == sum(r["mix_copies"] for r in rows)


def test_mixing_keeps_repeated_rows_together(spark):
    rows = spark.createDataFrame([(1, "a b", "x")] * 3 + [(2, "c", "x"), (3, "d e", None)], "doc_id long, text string, source string")
    copies = {}
    for r in mixing.mix(rows).collect():
        copies.setdefault(r["doc_id"], set()).add(r["mix_copies"])
    assert all(len(c) == 1 for c in copies.values())
