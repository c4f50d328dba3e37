"""Lines with a budget per micro-batch: cuts, restarts, and recorded files ahead of live ones."""

import json
import os
import random

import pytest
from helpers import rows

from sessionflow.sources import paced
from sessionflow.streaming.runner import run_until_idle


def micro_batches(options, path, backlog):
    """All micro-batches, with a new reader for each, as after a restart."""
    wanted = {**options, "path": str(path), "backlog": str(backlog)}
    at, found = {}, []
    while True:
        reader = paced.PacedReader(wanted)
        reader.partitions(at, at)  # what Spark tells a restarted source
        end = json.loads(json.dumps(reader.latestOffset()))
        if end == at:
            return found
        assert reader.latestOffset() == end
        found.append([x for p in reader.partitions(at, end) for b in reader.read(p) for x in b.column(0).to_pylist()])
        at = end


@pytest.mark.parametrize("seed", range(40))
def test_any_cut_gives_each_line_once_and_in_order(seed, tmp_path, monkeypatch):
    rnd = random.Random(seed)
    monkeypatch.setattr(paced, "RANGE_BYTES", rnd.choice([3, 7, 1000]))
    monkeypatch.setattr(paced, "LOOK_BYTES", rnd.choice([1, 2, 5, 100]))
    want = []
    for group in ("recorded", "live"):
        os.makedirs(tmp_path / group)
        for k in range(rnd.randint(0, 3)):
            lines = ["é" * rnd.randint(0, 9) + str(i) for i in range(rnd.randint(1, 12))]
            (tmp_path / group / f"{k}.txt").write_bytes(("\n".join(lines) + rnd.choice(["", "\n"])).encode())
            want += lines
    for options in ({"maxRows": str(rnd.randint(1, 6))}, {"maxBytes": str(rnd.randint(1, 40))}, {}):
        found = micro_batches(options, tmp_path / "live", tmp_path / "recorded")
        assert [line for batch in found for line in batch] == want
        if "maxRows" in options:
            assert all(0 < len(batch) <= int(options["maxRows"]) for batch in found)


def test_a_growing_file_gives_whole_lines(tmp_path):
    (tmp_path / "live").mkdir()
    path = tmp_path / "live" / "a"
    path.write_bytes(b"one\ntw")
    reader = paced.PacedReader({"path": str(tmp_path / "live"), "growing": "true"})
    first = reader.latestOffset()
    assert list(first.values()) == [4]
    reader.partitions({}, first)
    assert reader.latestOffset() == first
    path.write_bytes(b"one\ntwo\nthree\nfo")
    assert list(reader.latestOffset().values()) == [14]


def test_one_budget_and_a_path(tmp_path):
    for options in ({}, {"path": "x", "maxRows": "1", "maxBytes": "1"}):
        with pytest.raises(ValueError, match="paced lines"):
            paced.PacedReader(options)


def test_a_stream_restarts_within_a_file(spark, tmp_path):
    """Two runs on one checkpoint, a file more between them, recorded lines first although they are newer."""
    live, recorded, folder = tmp_path / "live", tmp_path / "recorded", str(tmp_path / "run")
    live.mkdir()
    recorded.mkdir()
    (live / "a").write_text("".join(f"live {i}\n" for i in range(5)))
    (recorded / "b").write_text("".join(f"recorded {i}\n" for i in range(8)))
    os.utime(live / "a", (1, 1))

    def run():
        lines = paced.paced_stream(spark, str(live), str(recorded), max_rows=3)
        return run_until_idle(lines, "lines", "append", folder)

    found = {}
    for r in run().collect():
        found.setdefault(r["batch_id"], []).append(r["value"])
    assert [sorted(found[b]) for b in sorted(found)] == [
        ["recorded 0", "recorded 1", "recorded 2"],
        ["recorded 3", "recorded 4", "recorded 5"],
        ["recorded 6", "recorded 7"],
        ["live 0", "live 1", "live 2"],
        ["live 3", "live 4"],
    ]
    (live / "c").write_text("more 0\nmore 1\n")
    again = run()
    assert again.where("batch_id < 5").count() == 13
    assert rows(again.where("batch_id >= 5").select("value")) == [("more 0",), ("more 1",)]
