"""A stream of text lines with a budget per micro-batch, recorded files ahead of live ones.

The offset of a micro-batch says how many bytes of each file have been read, always up to the end of a line. A budget of
lines or bytes sets how far the next one goes: the driver looks at line ends only, of as many bytes as the budget allows at most, and
executors read the lines themselves, in ranges of some megabytes. A large file thus makes many small micro-batches,
and a restart goes on in the middle of a file. All files of ``backlog`` folders come before any other, whatever their times are;
within a group files come by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes that one task reads, and that are looked at for line ends at once.
RANGE_BYTES, LOOK_BYTES = 8 << 20, 1 << 16
#: Lines that leave a task at once.
ROWS_PER_BATCH = 10_000
FORMAT = "paced_lines"


@dataclass
class LineRange(InputPartition):
    """Lines of a file that begin within a range of bytes."""

    path: str
    start: int
    stop: int


class PacedLines(DataSource):
    """``spark.readStream.format("paced_lines")`` with the options ``path``, ``backlog``, ``maxRows``, ``maxBytes``,
    ``growing``. Folders are separated by newlines."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PacedReader(dict(self.options))


class PacedReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        option = {k.lower(): v for k, v in options.items()}
        self._groups = [[f for f in option.get(k, "").split("\n") if f] for k in ("backlog", "path")]
        self._rows = int(option.get("maxrows") or 0)
        self._bytes = int(option.get("maxbytes") or 0)
        if not any(self._groups) or (self._rows and self._bytes):
            raise ValueError("paced lines need a path and one budget, of rows or of bytes")
        self._growing = option.get("growing", "false").lower() == "true"
        self._read: dict[str, int] = {}

    # --- on the driver ---------------------------------------------------------------------------

    def initialOffset(self) -> dict:
        return {}

    def partitions(self, start: dict, end: dict) -> list[LineRange]:
        # also called with the last offset of a restarted query, before a new one is asked for
        self._read = dict(end)
        found = []
        for path, stop in end.items():
            for at in range(start.get(path, 0), stop, RANGE_BYTES):
                found.append(LineRange(path, at, min(at + RANGE_BYTES, stop)))
        return found

    def latestOffset(self) -> dict:
        read, rows, left = dict(self._read), self._rows, self._bytes
        for folders in self._groups:
            for path, size in self._files(folders):
                at = read.get(path, 0)
                if at >= size:
                    continue
                stop, rows = self._stop(path, at, size, rows, left)
                if stop > at:
                    read[path] = stop
                    left -= stop - at
                if (self._rows and rows <= 0) or (self._bytes and left <= 0):
                    return read
            if read != self._read:
                break  # a micro-batch does not mix recorded and live lines
        return read

    def _files(self, folders: list[str]) -> list[tuple[str, int]]:
        found = []
        for folder in folders:
            system, place = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
            head = folder[: len(folder) - len(place)] if folder.endswith(place) else ""
            for info in system.get_file_info(fs.FileSelector(place, allow_not_found=True, recursive=True)):
                if info.type == fs.FileType.File and info.size and not info.base_name.startswith(("_", ".")):
                    found.append((head + info.path, info.size))
        return sorted(found)

    def _stop(self, path: str, at: int, size: int, rows: int, left: int) -> tuple[int, int]:
        """The end of the last line to take, and what remains of the budget of rows."""
        with _opened(path) as file:
            if self._rows:
                return self._stop_by_rows(file, at, size, rows)
            stop = min(at + left, size) if self._bytes else size
            return (self._line_end(file, stop - 1, size) if stop < size else self._whole(file, size)), rows

    def _stop_by_rows(self, file, at: int, size: int, rows: int) -> tuple[int, int]:
        stop = at
        while at < size and rows:
            file.seek(at)
            block = file.read(min(LOOK_BYTES, size - at))
            ends = block.count(b"\n")
            if ends >= rows:
                place = -1
                for _ in range(rows):
                    place = block.index(b"\n", place + 1)
                return at + place + 1, 0
            rows -= ends
            stop = at + block.rfind(b"\n") + 1 if ends else stop
            at += len(block)
        if stop < size and not self._growing:  # a last line without an end
            return size, rows - 1
        return stop, rows

    def _line_end(self, file, at: int, size: int) -> int:
        """The place behind the first line end from ``at`` on, or what counts as the end of the file."""
        while at < size:
            file.seek(at)
            block = file.read(min(LOOK_BYTES, size - at))
            place = block.find(b"\n")
            if place >= 0:
                return at + place + 1
            at += len(block)
        return self._whole(file, size)

    def _whole(self, file, size: int) -> int:
        """The end of a file; of one that grows, the place behind its last line end."""
        if not self._growing:
            return size
        stop = size
        while stop > 0:
            start = max(stop - LOOK_BYTES, 0)
            file.seek(start)
            place = file.read(stop - start).rfind(b"\n")
            if place >= 0:
                return start + place + 1
            stop = start
        return 0

    # --- in tasks --------------------------------------------------------------------------------

    def read(self, partition: LineRange) -> Iterator[pa.RecordBatch]:
        with _opened(partition.path) as file:
            start = partition.start
            if start:  # a line that began before belongs to the range before
                file.seek(start - 1)
                start += len(_rest_of_line(file)) - 1
            file.seek(start)
            lines, at = [], start
            for line in _lines(file, start, partition.stop):
                if at >= partition.stop:
                    break
                at += len(line)
                lines.append(line.rstrip(b"\n").removesuffix(b"\r").decode("utf-8", "replace"))
                if len(lines) == ROWS_PER_BATCH:
                    yield _batch(lines)
                    lines = []
            if lines:
                yield _batch(lines)


def _opened(path: str):
    system, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    return system.open_input_file(place)


def _lines(file, at: int, stop: int) -> Iterator[bytes]:
    """Lines with their ends from the place of the file on, read in blocks; not far beyond ``stop``."""
    rest = b""
    while block := file.read(stop - at if at < stop else LOOK_BYTES):
        at += len(block)
        *whole, rest = (rest + block).split(b"\n")
        for line in whole:
            yield line + b"\n"
    if rest:
        yield rest


def _rest_of_line(file) -> bytes:
    found = b""
    while block := file.read(LOOK_BYTES):
        place = block.find(b"\n")
        if place >= 0:
            return found + block[: place + 1]
        found += block
    return found


def _batch(lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])


def paced_stream(
    spark: SparkSession,
    path: str | list[str],
    backlog: str | list[str] = (),
    max_rows: int | None = None,
    max_bytes: int | None = None,
    growing: bool = False,
) -> DataFrame:
    """Lines of the files below ``path`` as a stream, after all lines of the files below ``backlog``.

    A micro-batch has at most ``max_rows`` lines, or the lines that begin within ``max_bytes`` bytes. With ``growing`` files
    may be appended to, and a line counts once it has its end. Files that were read must not change otherwise.
    """

    def joined(folders) -> str:
        return folders if isinstance(folders, str) else "\n".join(folders)

    spark.dataSource.register(PacedLines)
    reader = spark.readStream.format(FORMAT).option("path", joined(path)).option("backlog", joined(backlog))
    for name, value in (("maxRows", max_rows), ("maxBytes", max_bytes)):
        if value:
            reader = reader.option(name, value)
    return reader.option("growing", growing).load()
