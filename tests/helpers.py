"""Rows of results, and streams out of literal rows, one file per micro-batch."""

import os
import tempfile

from sessionflow.sources.lines import text_stream

BASE_S = 1_700_000_000


def rows(df):
    """Rows in a fixed order."""
    return sorted(map(tuple, df.collect()), key=repr)


def write_files(folder, batches, first=0):
    """One text file per micro-batch; the stream takes them by age."""
    for i, lines in enumerate(batches, first):
        path = f"{folder}/{i:03d}.txt"
        with open(path, "w") as f:
            f.write("".join(line + "\n" for line in lines))
        os.utime(path, (1_000_000 + i, 1_000_000 + i))
    return folder


def line_stream(spark, batches):
    return text_stream(spark, write_files(tempfile.mkdtemp(prefix="lines-"), batches), 1)


def vehicle(vin, second, mileage=0):
    return f"{{'vin':'{vin}','createTime':{ms(second)},'mileage':{mileage}}}"


def ms(second):
    return round((BASE_S + second) * 1000)


def split_by_gaps(times, gap_ms):
    """Islands of sorted times, the plain way."""
    found = []
    for t in sorted(times):
        if found and t - found[-1][-1] <= gap_ms:
            found[-1].append(t)
        else:
            found.append([t])
    return found


# Three trips of 59, 60 and 60 seconds, two minutes apart: first and last time and mileage.
DRIVES = [
    (1713258259878, 1713258318369, 0, 58),
    (1713258439034, 1713258498465, 59, 118),
    (1713258619231, 1713258678749, 119, 178),
]
DRIVEN = [(s, e, m0, m1, (e - s) // 1000, m1 - m0) for s, e, m0, m1 in DRIVES]


def drive_lines(vins):
    """A line each second from the start of each trip, and one at its end."""
    lines = []
    for vin in vins:
        for start, end, first, last in DRIVES:
            for mileage in range(first, last + 1):
                at = end if mileage == last else start + 1000 * (mileage - first)
                lines.append(f"{{'vin':'{vin}','createTime':{at},'mileage':{mileage}}}")
    return lines
