"""The registered queries, through queries(), against plain versions."""

import hashlib
import math
import struct
import zlib
from collections import Counter, defaultdict

import plain
import public_tokenizers
import pytest
from test_queries import connection
from tokenizers import Tokenizer

from sessionflow.llm import queries


def texts_of(sf_dir):
    return dict(connection(sf_dir).execute("select doc_id, text from documents").fetchall())


def result(spark, sf_dir, name):
    return queries.queries()[name](spark, sf_dir).collect()


def test_quality(spark, sf_dir):
    rows = result(spark, sf_dir, "op2_quality_crf")
    assert {r["doc_id"] for r in rows} == set(texts_of(sf_dir))
    labels = dict(connection(sf_dir).execute("select doc_id, quality from labels").fetchall())
    right = []
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        if r["held_out"] and labels.get(r["doc_id"]) is not None:
            right.append(r["predicted"] == labels[r["doc_id"]])
    assert sum(right) >= 0.9 * len(right)


def test_encoding(spark, sf_dir):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.VOCABULARY))
    texts = texts_of(sf_dir)
    for r in result(spark, sf_dir, "op3_bpe_lexicon"):
        ids = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_language_model(spark, sf_dir):
    tokens = {i: [*plain.lower_words(t), None] for i, t in texts_of(sf_dir).items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    count = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    total = sum(count.values())
    better = Counter()
    for r in result(spark, sf_dir, "op7_suffix_tree_lm"):
        words = tokens[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (len(count) + 1))) for w in words)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(words), sum(count[w] > 0 for w in words), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        better[r["held_out"]] += r["score"] - r["base_score"]
    assert better[True] > 0 and better[False] > 0


def test_conversations(spark, sf_dir):
    turns = defaultdict(list)
    for i, turn, role, text in connection(sf_dir).execute("select conv_id, turn, role, text from conversations").fetchall():
        turns[i].append((turn, role, text or ""))
    said = "\\### Assistant: </turn> ok"
    turns[-7] = [(0, "user", said), (1, "assistant", said)]
    rows = result(spark, sf_dir, "op10_chat_windows")
    assert {r["conv_id"] for r in rows} == set(turns) and len(rows) == len(turns)
    for r in rows:
        found = sorted(turns[r["conv_id"]], key=lambda t: t[0])
        digest = hashlib.sha256("".join(f"{role}\n{text}\n" for _, role, text in found).encode()).hexdigest()
        loss = "".join(text for _, role, text in found if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(found), digest)
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_alignment(spark, sf_dir):
    want = plain.aligned(texts_of(sf_dir), *map(public_tokenizers.path, queries.ALIGNED))
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r["doc_id"]: tuple(r[c] for c in columns) for r in result(spark, sf_dir, "op11_token_align")} == want


def test_sharding(spark, sf_dir):
    texts, slots = texts_of(sf_dir), defaultdict(list)
    for r in result(spark, sf_dir, "op13_jump_shards"):
        data = (texts[r["doc_id"]] or "").encode()
        key = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16)
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 8, zlib.crc32(data), "key")
        assert (r["shard"], r["grown_shard"]) == (plain.jump_hash(key, 24), plain.jump_hash(key, 25))
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == len(texts)


@pytest.mark.parametrize("name", ["op4_toxicity"])
def test_toxicity(spark, sf_dir, name):
    rows = result(spark, sf_dir, name)
    assert {r["doc_id"] for r in rows} == set(texts_of(sf_dir))
    assert all(r["toxic"] == (r["score"] > 0.5) or math.isclose(r["score"], 0.5) for r in rows)
    assert all(0 <= r["severity"] <= 3 for r in rows)
