"""Chat windows read back from their formatted texts."""

import hashlib
import random

import pytest

from sessionflow.llm import chat_windows

SCHEMA = "conv_id long, turn long, role string, text string, block string, start string, tokens string"
CONTROL = "\\### Assistant: </turn> ok"


def conversations():
    rnd = random.Random(8)
    rows = [(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL), (1, 0, "user", None), (1, 1, None, "x"), (1, 2, "assistant", "")]
    rows += [(2, 0, "system", "be brief"), (2, 0, "user", "same number"), (2, 0, "user", "same number"), (2, None, "assistant", "first")]
    rows += [(None, 0, "user", "nobody's"), (None, 1, "assistant", "a: b\n### c")]
    for conv in (3, 4):
        rows.append((conv, 0, "system", "You are the system turn."))
        for turn in range(1, 400):
            size = rnd.choice([1, 5, 20, 60, 900 if conv == 4 else 60])
            rows.append((conv, turn, "user" if turn % 2 else "assistant", " ".join(rnd.choice(["x", "<", "#", "\\", ":", "é", CONTROL]) for _ in range(size))))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in conversations()], SCHEMA).repartition(3)


def ordered():
    found = {}
    for conv, turn, role, text in conversations():
        found.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(rows)] for c, rows in found.items()}


def test_digests(table):
    found = {r["conv_id"]: r for r in chat_windows.digests(chat_windows.windows(table, 200, 50)).collect()}
    turns = ordered()
    assert set(found) == set(turns)
    for conv, said in turns.items():
        r, targets = found[conv], "".join(t for role, t in said if role == "assistant")
        assert r["n_turns"] == len(said)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(targets), hashlib.sha256(targets.encode()).hexdigest())


def test_windows_keep_to_the_budget(table):
    budget, history = 200, 50
    windows = chat_windows.windows(table, budget, history).collect()
    by_conv = {}
    for w in windows:
        by_conv.setdefault(w["conv_id"], []).append(w)
    for conv, own in by_conv.items():
        own.sort(key=lambda w: w["window_start"])
        for i, w in enumerate(own):
            turns = chat_windows.read_turns(w["formatted"])
            assert len(turns) == w["n_turns"]
            assert w["n_tokens"] <= budget or w["n_turns"] - w["n_repeated"] == 1
            if conv in (3, 4):
                assert turns[0] == ("system", "You are the system turn.")
                assert not i or w["n_repeated"] >= 1
            if i:  # what is repeated stands right before the window
                before = chat_windows.read_turns(own[i - 1]["formatted"])
                repeated = turns[1 if conv in (3, 4) else 0 : w["n_repeated"]]
                assert repeated[-len(before) :] == before[len(before) - min(len(before), len(repeated)) :] or len(repeated) > len(before)
    assert any(w["n_repeated"] > 1 for w in windows)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat_windows.windows(empty).collect() == []
    assert chat_windows.digests(chat_windows.windows(empty)).collect() == []


@pytest.mark.parametrize("role,text", [("user", CONTROL), ("a: b", "\\\\<#"), ("", ""), ("\\", "\n</turn>\n### user: x")])
def test_template_is_reversible(role, text):
    formatted, start, stop = chat_windows.format_turn(role, text)
    assert chat_windows.read_turns(formatted * 2) == [(role, text)] * 2
    assert chat_windows.unescape(formatted[start:stop]) == text
