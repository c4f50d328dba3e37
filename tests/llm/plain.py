"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import defaultdict

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def lower_words(text: str | None) -> list[bytes]:
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    return WORDS.findall(data)


def cut_repeats(texts: dict[int, str | None], length: int) -> dict[int, tuple[int, int, int, str]]:
    """Bytes, removed bytes, removed runs and the hash of what stays."""
    data = {d: (t or "").encode() for d, t in texts.items()}
    first: dict[bytes, int] = {}
    for d in sorted(data):
        for i in range(len(data[d]) - length + 1):
            first.setdefault(data[d][i : i + length], d)
    found = {}
    for d, b in data.items():
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        found[d] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return found


def roots(ids, links) -> dict:
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def shingles(text: str | None, width: int) -> frozenset:
    words = lower_words(text)
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def near_duplicates(texts: dict[int, str | None], width: int, percent: int) -> dict[int, tuple[int, int]]:
    """Size of the set and component of each document."""
    sets = {d: shingles(t, width) for d, t in texts.items()}
    having = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            having[x].append(d)
    common: dict[tuple[int, int], int] = defaultdict(int)
    for members in having.values():
        for i, b in enumerate(members):
            for a in members[:i]:
                common[a, b] += 1
    links = [p for p, n in common.items() if 100 * n >= percent * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    found = roots(sets, links)
    return {d: (len(s), found[d]) for d, s in sets.items()}


def aligned(texts: dict, a_path: str, b_path: str) -> dict:
    """Token numbers, groups, links, best links, the sum of link counts, and the hash of the groups, by whole texts and sets."""
    import sentencepiece
    from tokenizers import Tokenizer

    from sessionflow.llm.token_align import ByteTokens

    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    a_bytes = ByteTokens(a_path).pieces
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    found, counts = {}, defaultdict(int)
    for key, text in texts.items():
        ids = ([], [])
        if text:
            first = a.encode(" " + text, add_special_tokens=False).ids
            second = b.encode(text)
            names = [b.id_to_piece(i) for i in second]
            pieces = [bytes([int(n[3:5], 16)]) if b.is_byte(i) else n.replace("\u2581", " ").encode() for i, n in zip(second, names)]
            if b"".join(a_bytes[i] for i in first) == b"".join(pieces) == (" " + text).encode():
                ids = (first, second)
        ends = []
        for side, found_bytes in zip(ids, ([a_bytes[i] for i in ids[0]], pieces if ids[1] else [])):
            at, here = 0, {}
            for i, x in zip(side, found_bytes):
                at += len(x)
                here[at] = i
            ends.append(here)
        both = sorted(set(ends[0]) & set(ends[1]))
        links = [(ends[0][e], ends[1][e]) for e in both]
        group_of = [bisect.bisect_left(both, e) for e in sorted(ends[0])], [bisect.bisect_left(both, e) for e in sorted(ends[1])]
        groups = [([], []) for _ in both]
        for side, place in enumerate(group_of):
            for g, i in zip(place, ids[side]):
                groups[g][side].append(str(i))
        groups = ["|".join(",".join(side) for side in g) for g in groups]
        for link in links:
            counts[link] += 1
        found[key] = (ids, links, groups)
    most = defaultdict(int)
    for (x, y), n in counts.items():
        most[y] = max(most[y], n)
    rows = {}
    for key, (ids, links, groups) in found.items():
        best = sum(counts[x] == most[x[1]] for x in links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if links else ""
        rows[key] = (len(ids[0]), len(ids[1]), len(links), len(links), best, sum(counts[x] for x in links), sha)
    return rows


def clustered(vectors: list[tuple], k: int, rounds: int, size: int, scale: float) -> list[tuple]:
    """Cluster and squared distance of each row that is kept, by whole numbers of any size."""
    import math

    def fits(v):
        return v is not None and len(v) == size and all(x is not None and math.isfinite(x) and math.isfinite(x * scale) for x in v)

    kept = [(i, tuple(math.floor(x * scale) for x in v)) for i, v in vectors if fits(v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centres = [tuple(sum(c) // len(members[n]) for c in zip(*members[n])) if members[n] else c for n, c in enumerate(centres)]
    return [(i, *reversed(nearest(v)), ",".join(map(str, centres[nearest(v)[1]]))) for i, v in kept]


def jump_hash(key: int, shards: int) -> int:
    at, after = 0, 0
    while after < shards:
        at = after
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        after = int((at + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return at
