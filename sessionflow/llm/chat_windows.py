"""Chat formatting: budgeted windows of turns under a reversible template.

Prefix sums of turn tokens place every turn on the token axis of its conversation. The axis is cut into
cells of many budgets, in which windows are chosen greedily: the longest run of whole turns that fits in
the budget together with the system turn and the repeated history. Cells do not depend on each other, so
a conversation of any length is formatted by many tasks; only the sums over blocks of its turns meet.

A window starts with the system turn of its conversation, then come the last turns before it (at most
``history`` tokens), then its own turns. The loss mask holds the texts of own assistant turns; what is
repeated is never a target again, so every target appears once.

Template: ``### role: text</turn>`` and a line end for each turn. A backslash stands before every
backslash, ``<`` and ``#`` of a text, and before a ``:`` of a role too, so control strings inside texts
cannot be mistaken, and ``read_turns`` gives back the turns as they were.

Defined results: a null text or role is empty; turns are ordered by number, nulls first, and turns of
equal number by role and text; repeated rows are repeated turns; rows without a conversation id form one
of their own; a turn longer than the budget has a window of its own, whole; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Tokens that the marks of a turn count for, beside its words.
MARK_TOKENS = 4
TURN_BLOCK = 256
CELL_BUDGETS = 64
WINDOWS = (
    "conv_id long, window_start long, n_turns int, n_repeated int, n_tokens long, formatted string, "
    "loss array<struct<start:int,stop:int>>"
)
_TEXT_ESCAPES = re.compile(r"[\\<#]")
_ROLE_ESCAPES = re.compile(r"[\\<#:]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _TEXT_ESCAPES.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text starts and stops in it."""
    head = f"### {_ROLE_ESCAPES.sub(lambda m: chr(92) + m[0], role)}: "
    body = escape(text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts of a formatted window."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def positions(conversations: DataFrame) -> DataFrame:
    """Each turn with its tokens and the sum of the tokens before it, ``start``.

    The sums are made in two steps, over blocks of turns and within each block, so that no task needs the
    texts of a whole conversation.
    """
    words = F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"))
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        (F.coalesce(words, F.lit(0)) + MARK_TOKENS).cast("bigint").alias("tokens"),
    ).withColumn("block", F.floor(F.col("turn") / TURN_BLOCK))
    sums = turns.groupBy("conv_id", "block").agg(F.sum("tokens").alias("tokens"), F.min(F.struct("turn", "role", "text")).alias("head"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("conv_id").alias("c"),
        F.col("block").alias("b"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("offset"),
    )
    within = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    inner = turns.withColumn("inner", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
    return inner.join(offsets, same).withColumn("start", F.col("offset") + F.col("inner")).drop("c", "b", "offset", "inner", "block")


def windows(conversations: DataFrame, budget: int = 512, history: int = 128) -> DataFrame:
    """Formatted windows of ``conv_id, turn, role, text`` rows; see ``WINDOWS`` for the columns.

    ``window_start`` is the place of the first own turn on the token axis and orders the windows of a
    conversation; the first ``n_repeated`` turns of a window are repeated ones. ``loss`` holds code points.
    """
    cell = budget * CELL_BUDGETS
    turns = positions(conversations).withColumn("own", F.floor(F.col("start") / cell))
    end = F.col("start") + F.col("tokens")
    later = F.array(F.floor(end / cell), F.floor((end + history) / cell))
    cells = F.array_union(F.array("own"), F.filter(later, lambda x: x > F.col("own")))
    dealt = turns.withColumn("cell", F.explode(cells)).withColumn("is_system", F.lit(False))
    first = turns.where((F.col("start") == 0) & (F.col("role") == "system"))
    wanted = turns.select(F.col("conv_id").alias("c"), F.col("own").alias("cell")).where("cell > 0").distinct()
    system = first.join(wanted, F.col("conv_id").eqNullSafe(F.col("c"))).withColumn("is_system", F.lit(True))
    columns = ["conv_id", "cell", "is_system", "own", "start", "tokens", "role", "text", "turn"]
    rows = dealt.select(*columns).unionByName(system.select(*columns))
    placed = rows.repartition("conv_id", "cell").sortWithinPartitions("conv_id", "cell", F.desc("is_system"), "start", "turn", "role", "text")

    def form(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in WINDOWS.split(", ")]
        for (conv, cell_no), group in groupby(_rows(frames, columns), key=lambda r: (r[0], r[1])):
            made = [(conv, *w) for w in cell_windows(list(group), cell_no, budget, history)]
            if made:
                yield pd.DataFrame(made, columns=names).astype({"conv_id": "Int64"})

    return placed.mapInPandas(_in_batches(form), WINDOWS)


def _rows(frames: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple]:
    for frame in frames:
        ids = frame["conv_id"].astype("Int64").astype(object).where(frame["conv_id"].notna(), None)
        yield from zip(ids, *(frame[c] for c in columns[1:]))


def _in_batches(form, rows: int = 1000):
    """Gather small frames into batches of some size."""

    def gathered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, n = [], 0
        for frame in form(frames):
            kept.append(frame)
            n += len(frame)
            if n >= rows:
                yield pd.concat(kept)
                kept, n = [], 0
        if kept:
            yield pd.concat(kept)

    return gathered


def cell_windows(rows: list[tuple], cell: int, budget: int, history: int) -> Iterator[tuple]:
    """Windows of one cell: rows of the system turn, of the turns before the cell, and of its own."""
    system = next((r for r in rows if r[2]), None)
    turns = [r for r in rows if not r[2]]
    if system is None and turns and turns[0][4] == 0 and turns[0][6] == "system":
        system = turns[0]
    first = next((i for i, r in enumerate(turns) if r[3] == cell), len(turns))
    at = first
    while at < len(turns):
        begin = turns[at][4]
        back, kept = at, 0
        while back > 0 and turns[back - 1] is not system and kept + turns[back - 1][5] <= history:
            if turns[back - 1][4] + turns[back - 1][5] != turns[back][4] or (system and turns[back - 1][4] == 0):
                break
            back -= 1
            kept += turns[back][5]
        repeats_system = system is not None and begin > 0
        used = kept + (system[5] if repeats_system else 0)
        if used + turns[at][5] > budget:  # history gives way to the turn itself
            back, used = at, used - kept
        stop = at
        while stop < len(turns) and (stop == at or used + turns[stop][5] <= budget):
            used += turns[stop][5]
            stop += 1
        repeated = ([system] if repeats_system else []) + turns[back:at]
        yield (begin, len(repeated) + stop - at, len(repeated), used, *_write(repeated, turns[at:stop]))
        at = stop


def _write(repeated: list[tuple], own: list[tuple]) -> tuple[str, list[dict]]:
    parts, loss, at = [], [], 0
    for i, row in enumerate(repeated + own):
        text, start, stop = format_turn(row[6], row[7])
        if i >= len(repeated) and row[6] == "assistant":
            loss.append({"start": at + start, "stop": at + stop})
        parts.append(text)
        at += len(text)
    return "".join(parts), loss


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_windows long"
)


def digests(formatted: DataFrame) -> DataFrame:
    """Turns and targets of each conversation, read back from its windows one after the other."""
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "window_start")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in DIGESTS.split(", ")]
        columns = ["conv_id", "n_repeated", "formatted", "loss"]
        for conv, group in groupby(_rows(frames, columns), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = chars = loss_chars = n_windows = 0
            for _, repeated, text, spans in group:
                own = read_turns(text)[repeated:]
                n, chars, n_windows = n + len(own), chars + len(text), n_windows + 1
                for role, said in own:
                    turns.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    target = unescape(text[span["start"] : span["stop"]])
                    loss_chars += len(target)
                    loss.update(target.encode())
            row = (conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, n_windows)
            yield pd.DataFrame([row], columns=names).astype({"conv_id": "Int64"})

    return ordered.mapInPandas(_in_batches(read), DIGESTS)
