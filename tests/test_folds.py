"""The fold of a micro-batch against a loop over its rows."""

import random

import numpy as np
import pytest

from sessionflow.streaming.cells import lots, merged
from sessionflow.streaming.folds import Open, advance


def loop(stored, batch, gap, recede):
    """Row by row: closed sessions, the open one, and whether its only row is the last of the batch."""
    closed, state, alone = [], stored, False
    for t, m in sorted(batch):
        alone = False
        if state is None:
            state = [t, t, m, m]
        elif t - state[1] > gap:
            closed.append(tuple(state))
            state, alone = [t, t, m, m], True
        elif recede or t >= state[1]:
            state = [state[0], t, state[2], m]
    return closed, tuple(state), alone


def as_chunks(batch, rng):
    """Rows as single-row cells, in several chunks and any order."""
    batch = batch[:]
    rng.shuffle(batch)
    while batch:
        n = rng.randint(1, len(batch))
        part, batch = batch[:n], batch[n:]
        t, m = np.array([p[0] for p in part]), np.array([p[1] for p in part])
        yield np.stack([t, m, m, t, m, m, np.ones_like(t)]).T


@pytest.mark.parametrize("recede", [False, True])
@pytest.mark.parametrize("seed", range(60))
def test_against_loop(seed, recede):
    rng = random.Random(seed)
    gap, stored, now = rng.choice([0, 5, 30]), None, 0
    for _ in range(12):
        batch = [(now + rng.randint(-60, 60), rng.randint(0, 99)) for _ in range(rng.randint(1, 25))]
        closed, opened, alone = loop(list(stored) if stored else None, batch, gap, recede)
        step = advance(Open(*stored) if stored else None, merged(as_chunks(batch, rng), gap + 1), gap, recede)
        got = list(zip(step.start_ms, step.end_ms, step.start_value, step.end_value))
        assert got == [*closed, opened]
        assert step.tail_is_new == alone
        stored, now = opened, now + rng.randint(0, 120)


@pytest.mark.parametrize("at_once", [1, 7, 10**9])
def test_cells_do_not_depend_on_when_they_are_merged(monkeypatch, at_once):
    monkeypatch.setattr("sessionflow.streaming.cells.ROWS_PER_REDUCTION", at_once)
    rng = random.Random(3)
    batch = [(rng.randint(-500, 500), i) for i in range(300)]
    found = merged(as_chunks(batch, rng), 10)
    by_cell = {}
    for t, m in sorted(batch):
        by_cell.setdefault(t // 10, []).append((t, m))
    expected = [(c[0][0], c[0][1], c[-1][0], c[-1][1], len(c)) for c in by_cell.values()]
    assert list(zip(*(found[f].tolist() for f in ("t0", "m0", "t1", "m1", "n")))) == expected


def test_two_rows_at_once_are_not_alone():
    cells = merged(lots([100, i, i, 100, i, i, 1] for i in (1, 2)), 11)
    assert not advance(Open(0, 0), cells, 10).tail_is_new
