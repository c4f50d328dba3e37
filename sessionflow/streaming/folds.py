"""What a micro-batch does to the stored session of one key. Pure functions, no Spark.

Sessions here are split by gaps: an open session is closed by the first row that comes more than
``gap_ms`` after its end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Open:
    """The session a key has open between micro-batches."""

    start_ms: int
    end_ms: int
    start_value: int = 0
    end_value: int = 0


@dataclass(frozen=True)
class Step:
    """Result of a micro-batch: the sessions it touched, in order; the last one stays open."""

    start_ms: np.ndarray
    end_ms: np.ndarray
    start_value: np.ndarray
    end_value: np.ndarray
    tail_is_new: bool

    @property
    def open(self) -> Open:
        return Open(
            int(self.start_ms[-1]),
            int(self.end_ms[-1]),
            int(self.start_value[-1]),
            int(self.end_value[-1]),
        )


def advance(
    stored: Open | None, cells: dict[str, np.ndarray], gap_ms: int, end_may_recede: bool = False
) -> Step:
    """Split the cells of a micro-batch by gaps, continuing the stored session.

    Rows older than the stored end can still arrive within the watermark. They never move the
    start. The end stays where it is, unless ``end_may_recede``: then the end, and with it the
    distance to the next row, always follows the row seen last.

    ``tail_is_new`` tells that the session left open consists of the very last row only, which
    itself broke away from an earlier session.
    """
    t0, t1 = cells["t0"], cells["t1"]
    m0, m1 = cells["m0"], cells["m1"]
    carried_end = stored.end_ms if stored else t0[0]

    ends = np.concatenate([[carried_end], t1])
    if not end_may_recede:
        ends = np.maximum.accumulate(ends)
    breaks = t0 - ends[:-1] > gap_ms

    opening = np.flatnonzero(breaks)
    # A carried session, or the first row of a new key, opens the first group without a break.
    lead = not breaks[0]
    first = np.r_[0, opening] if lead else opening
    last = np.r_[first[1:], len(t0)] - 1

    start, start_value = t0[first], m0[first]
    end = ends[1:][last]  # cells are in time order, so the last one of a group sets its end
    end_value = m1[last]

    if stored and lead:
        start = np.r_[stored.start_ms, start[1:]]
        start_value = np.r_[stored.start_value, start_value[1:]]
        if not end_may_recede and stored.end_ms > t1[last[0]]:
            end_value = np.r_[stored.end_value, end_value[1:]]
    elif stored:
        start = np.r_[stored.start_ms, start]
        start_value = np.r_[stored.start_value, start_value]
        end = np.r_[stored.end_ms, end]
        end_value = np.r_[stored.end_value, end_value]

    return Step(start, end, start_value, end_value, bool(breaks[-1] and cells["n"][-1] == 1))

