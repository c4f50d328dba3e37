"""Language-model scores by a probabilistic suffix tree over words.

A context is the last one or more words. Contexts and next words count with all training documents,
exactly; an explicit entry is a (context, next word) pair that stands there at least ``LEAST_COUNT`` times,
however large the corpus is. A context stays in the tree if its next words differ from those of its suffix
by a likelihood-ratio test of divergence. The distribution of a kept context is its discounted entries, and
the mass that is left goes to the distribution of its longest kept suffix, down to smoothed word frequencies:

    P(w | s) = max(n(s, w) - d, 0) / n(s) + rest(s) * P(w | suffix of s)

There are two ways to the same scores. The tree of up to ``TREE_TOKENS`` training tokens is small and is
sent to all tasks; only words that stand there once are looked up in buckets. The tree of a larger corpus
stays in buckets of runs of words (``_exchanged``): a chunk of texts asks for each of its distinct runs
once, and only for those whose parts stand there often enough; the bucket adds up the counts, numbers the
frequent runs and answers. Words are asked for by their hash, longer runs by the numbers of their two parts,
which take a third of the bytes. One of the chunks that have an entry hands it to the divergence test, which is
a sum by context that chunks and Spark combine before the shuffle. So neither a common run nor a common context
meets in one task row by row.

Defined results: a null or empty text is the end token only; texts are scored whole; repeated rows are
scored (and counted) each; a null id counts as an empty text for the split; an empty training set gives
the uniform base; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow.llm.batches import write_step
from sessionflow.llm.packing import packed, unpacked
from sessionflow.llm.texts import mixed, slices, word_hashes
from sessionflow.workdir import drop_table, write_table

#: Times from which on a word, or a word after a context, is in the tree.
LEAST_COUNT = 2
#: Training tokens up to which the tree, of half as many entries for each depth at most, is sent to all tasks.
TREE_TOKENS = 2_000_000
DEPTH = 2
DISCOUNT = 0.5
#: Standard deviations by which the divergence of a context has to exceed that of chance.
DEVIATIONS = 4.0
END = np.uint64(0x5BD1E995C0FFEE01)
BUCKET_TOKENS = 2_000_000
#: Distinct keys that a counting task holds before it hands its counts on.
_HELD = 1 << 20


@dataclass
class Tree:
    """Frequent words, and the entries of each depth by ``context << 32 | word``."""

    tokens: int = 0
    words: int = 0
    vocabulary: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    keys: list[np.ndarray] = field(default_factory=list)
    entries: list[np.ndarray] = field(default_factory=list)  # counts n(s, w)
    shares: list[np.ndarray] = field(default_factory=list)  # discounted shares, 0 below contexts that are not kept
    rests: list[np.ndarray] = field(default_factory=list)  # by context, 1 where it is not kept
    suffixes: list[np.ndarray] = field(default_factory=list)  # of each context of a depth, in the depth before

    @property
    def total(self) -> float:
        return self.tokens + 0.5 * (self.words + 1)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word in the vocabulary, or -1."""
        return _find(self.vocabulary, hashes)

    def contexts(self, numbers: np.ndarray, first: np.ndarray, depth: int) -> list[np.ndarray]:
        """For each token its context of each depth up to ``depth``, or -1; ``first`` marks starts of texts."""
        found: list[np.ndarray] = []
        last = np.where(numbers >= 0, numbers, -1)
        for d in range(depth):
            context = np.full(len(numbers), -1, np.int64)
            context[1:] = last[:-1]
            context[first] = -1
            found.append(context)
            if d + 1 < depth:
                last = self.entry(d, context, numbers)
        return found

    def entry(self, d: int, context: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        found = np.full(len(numbers), -1, np.int64)
        there = np.flatnonzero((context >= 0) & (numbers >= 0))
        found[there] = _find(self.keys[d], pair_keys(context[there], numbers[there]))
        return found

    def add_depth(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Take the entries of the next depth, and keep the contexts that diverge from their suffixes."""
        d = len(self.keys)
        context, word = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        size = self.counts if d == 0 else self.entries[d - 1]
        if d:
            before = self.keys[d - 1]
            last = (before & np.uint64(0xFFFFFFFF)).astype(np.int64)
            head = (before >> np.uint64(32)).astype(np.int64)
            self.suffixes.append(last if d == 1 else _find(self.keys[d - 2], pair_keys(self.suffixes[d - 2][head], last)))
        total = size[context].astype(float)
        parent = self._probability(d, context, word)
        n = len(size)
        of = lambda values: np.bincount(context, values, n).astype(float)
        listed, covered, parts = of(counts), of(parent), of(np.ones(len(counts)))
        gain = of(counts * np.log(counts / total / parent))
        rest, other = np.maximum(size - listed, 0.0), np.maximum(1.0 - covered, 1e-12)
        gain += np.where(rest > 0, rest * np.log(np.maximum(rest, 1e-300) / np.maximum(size, 1) / other), 0.0)
        kept = (parts > 0) & (2 * gain > parts + DEVIATIONS * np.sqrt(2 * np.maximum(parts, 1)))
        share = np.where(kept[context], np.maximum(counts - DISCOUNT, 0) / total, 0.0)
        self.keys.append(keys)
        self.entries.append(counts)
        self.shares.append(share)
        self.rests.append(np.where(kept, 1.0 - of(share), 1.0))

    def _probability(self, d: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of words after the suffixes of contexts of depth ``d`` (0: after one word)."""
        if d == 0:
            return (self.counts[word] + 0.5) / self.total
        suffix = self.suffixes[d - 1][context]
        p = self._probability(d - 1, suffix, word)
        at = _find(self.keys[d - 1], pair_keys(suffix, word))
        return np.where(at >= 0, self.shares[d - 1][np.maximum(at, 0)], 0.0) + self.rests[d - 1][suffix] * p

    def log_probabilities(self, numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the base and of the tree's probability; for words out of the vocabulary of the factor to
        the base only."""
        known = numbers >= 0
        base = np.ones(len(numbers))
        base[known] = (self.counts[numbers[known]] + 0.5) / self.total
        p = base.copy()
        for d, context in enumerate(self.contexts(numbers, first, len(self.keys))):
            there = np.flatnonzero(context >= 0)
            c = context[there]
            at = self.entry(d, c, numbers[there])
            share = np.where(at >= 0, self.shares[d][np.maximum(at, 0)], 0.0) if len(self.shares[d]) else 0.0
            p[there] = share + self.rests[d][c] * p[there]
        return np.log10(base), np.log10(p)


def pair_keys(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return context.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64)


def _find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of values in an ascending table, or -1."""
    if not len(table):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens, each text closed by the end token, and their number in each text."""
    words, counts = word_hashes(data, offsets)
    sizes = counts + 1
    tokens = np.empty(int(sizes.sum()), np.uint64)
    ends = np.cumsum(sizes) - 1
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[ends], tokens[inner] = END, words
    return tokens, sizes


def _counted(rows: DataFrame, keys) -> DataFrame:
    """``key, n``: how often ``keys(tokens, sizes)`` gives each key over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["key", "n"])

        for batch in batches:
            for _, data, offsets in slices(batch, "text"):
                new, m = np.unique(keys(*_tokens(data, offsets)), return_counts=True)
                found, n = _merged(found, n, new, m)
                if len(found) > _HELD:
                    yield out()
                    found, n = found[:0], n[:0]
        yield out()

    return rows.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _merged(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(a):
        return b, m.astype(np.int64)
    keys, back = np.unique(np.concatenate([a, b]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([n, m]), len(keys)).astype(np.int64)


def learn(rows: DataFrame, depth: int = DEPTH) -> Tree:
    """The tree of some texts (binary column ``text``), for a corpus whose tree fits into memory."""
    counts = write_table(_counted(rows, lambda tokens, sizes: tokens), "lm-words")
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("words")).first()
    tree = Tree(size["tokens"], size["words"])
    tree.vocabulary, tree.counts = _collected(counts, LEAST_COUNT)
    for _ in range(depth):
        shared = _sent(tree)
        found = _collected(_counted(rows, _pair_counter(shared, len(tree.keys) + 1)), LEAST_COUNT)
        shared.unpersist()
        tree.add_depth(*found)
    return tree


def _pair_counter(shared, depth: int):

    def keys(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        known = shared.value
        numbers = known.numbers(tokens)
        context = known.contexts(numbers, np.cumsum(sizes) - sizes, depth)[-1]
        there = (context >= 0) & (numbers >= 0)
        return pair_keys(context[there], numbers[there])

    return keys


def _sent(tree: Tree):
    """The tree for all tasks."""
    return SparkSession.active().sparkContext.broadcast(tree)


def _collected(counts: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys, ascending, that are counted often enough."""
    table = counts.where(F.col("n") >= least).toArrow()
    keys, n = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order].astype(np.int64)


_SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, bucket long, content binary"
)


def scores(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, tree_tokens: int = TREE_TOKENS
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row.

    The tree is learnt from the rows for which ``held_out`` is false. Up to ``tree_tokens`` training tokens it
    is sent to all tasks; the scores do not depend on that.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        held_out.alias("held_out"),
        F.col(text_col).cast("string").cast("binary").alias("text"),
    )
    growth = _growth(rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
    chunks = write_table(rows.mapInArrow(_chunked(int(CHUNK_BYTES * growth)), CHUNK), "lm-chunks")
    size = chunks.agg(F.coalesce(F.sum("trained"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    if size[0] > tree_tokens:
        return _exchanged(chunks, size[0], int(size[1] / (BUCKET_RUNS * growth)) + 1, depth)
    tree = learn(rows.where(~F.col("held_out")).select("text"), depth)
    buckets = tree.tokens // BUCKET_TOKENS + 1
    shared = _sent(tree)
    parts = write_table(rows.mapInArrow(_scorer(shared, buckets), _SCORED), "lm-scored")
    shared.unpersist()
    sums = parts.where("bucket is not null").groupBy("bucket").applyInPandas(_rare_sums(tree.total), "number long, content binary")
    rare = sums.groupBy("number").applyInPandas(_slice_sums, "row long, rare double, rare_known long")
    joined = parts.where("bucket is null").join(rare, "row", "left")
    extra = F.coalesce("rare", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tree.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + extra).alias("base_score"),
        (F.col("score") + extra).alias("score"),
    )


def _scorer(shared, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, number = shared.value, TaskContext.get().partitionId() << 36
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                tokens, sizes = _tokens(data, offsets)
                numbers = tree.numbers(tokens)
                base, model = tree.log_probabilities(numbers, np.cumsum(sizes) - sizes)
                text = np.repeat(np.arange(len(sizes)), sizes)
                known = (numbers >= 0) & (tree.counts[np.maximum(numbers, 0)] > 0 if len(tree.counts) else False)
                sums = [np.bincount(text, x, len(sizes)) for x in (known, base, model)]
                n = len(sizes)
                yield _rows(
                    row=number + np.arange(n), doc_id=part.column("doc_id"), held_out=part.column("held_out"), n_tokens=sizes,
                    known=sums[0].astype(np.int64), base=sums[1], score=sums[2], bucket=None, content=None, n=n,
                )
                rare = np.flatnonzero(numbers < 0)
                train = ~part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                made = list(_postings(tokens[rare], text[rare], train, number, buckets))
                if made:
                    numbers_, contents = zip(*made)
                    yield _rows(
                        row=None, doc_id=None, held_out=None, n_tokens=None, known=None, base=None, score=None,
                        bucket=np.array(numbers_), content=pa.array(contents, pa.binary()), n=len(made),
                    )
                number += n

    return run


def _rows(n: int, **columns) -> pa.RecordBatch:
    kinds = {"held_out": pa.bool_(), "base": pa.float64(), "score": pa.float64(), "content": pa.binary()}
    arrays = []
    for name, values in columns.items():
        kind = kinds.get(name, pa.int64())
        arrays.append(pa.nulls(n, kind) if values is None else values if isinstance(values, pa.Array) else pa.array(values, kind))
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _postings(tokens: np.ndarray, text: np.ndarray, train: np.ndarray, number: int, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Per bucket of words: the words, their training counts, and how often which text has them."""
    bucket = (tokens >> np.uint64(20)) % np.uint64(buckets)
    order = np.lexsort((text, tokens, bucket))
    tokens, text, bucket = tokens[order], text[order], bucket[order]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(fresh)
    times = np.diff(np.append(at, len(tokens)))
    tokens, text, bucket = tokens[at], text[at], bucket[at]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    for b in np.flatnonzero(np.diff(cuts)):
        s = slice(cuts[b], cuts[b + 1])
        words, first, texts_with = np.unique(tokens[s], return_index=True, return_counts=True)
        trained = np.add.reduceat(times[s] * train[text[s]], first)
        yield int(b), packed(
            words=words, trained=trained.astype(np.uint32), texts=texts_with.astype(np.uint32),
            text=text[s].astype(np.uint32), times=times[s].astype(np.uint32), number=np.array([number]),
        )


def _rare_sums(total: float):
    """For each slice of texts that a bucket knows: sums over its rare words by text, in one value."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [unpacked(c) for c in frame["content"]]
        words, back = np.unique(np.concatenate([p["words"] for p in parts]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([p["trained"] for p in parts]), len(words))[back]
        rows, at = [], 0
        for p in parts:
            count = counts[at : at + len(p["words"])]
            at += len(count)
            value = np.repeat(np.log10((count + 0.5) / total), p["texts"]) * p["times"]
            seen = np.repeat(count > 0, p["texts"]) * p["times"]
            text, back_ = np.unique(p["text"], return_inverse=True)
            sums = packed(text=text, value=np.bincount(back_, value), seen=np.bincount(back_, seen))
            rows.append((int(p["number"][0]), sums))
        return pd.DataFrame(rows, columns=["number", "content"])

    return run


def _slice_sums(frame: pd.DataFrame) -> pd.DataFrame:
    """One row for each text of a slice."""
    parts = [unpacked(c) for c in frame["content"]]
    text, value, seen = (np.concatenate([p[k] for p in parts]) for k in ("text", "value", "seen"))
    texts, back = np.unique(text, return_inverse=True)
    known = np.bincount(back, seen).astype(np.int64)
    return pd.DataFrame({"row": int(frame["number"].iloc[0]) + texts.astype(np.int64), "rare": np.bincount(back, value), "rare_known": known})


# --- a tree that stays in buckets ----------------------------------------------------------------

#: Bytes of text in a chunk, and tokens for each bucket of runs of words, up to so many bytes of text. Beyond, both grow
#: by the root of the bytes: every chunk asks every bucket, so the pieces between them grow no faster than the texts.
CHUNK_BYTES, BUCKET_RUNS, LEVEL_BYTES = 2 << 20, 2_000_000, 1 << 30
CHUNK = "chunk long, trained long, tokens long, content binary, words binary"
_ASKED = "bucket long, chunk long, content binary"
_ANSWER = "chunk long, kind int, words long, content binary"
_ENTRY = "key long, size long, listed long, parts long, covered double, gain double"
_SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
_COUNTED = f"{_ANSWER}, bucket long, frequent long"
#: A frequent run is its bucket and its rank among the frequent runs there; all together are numbered bucket by bucket.
_RANK_BITS = 40
_COUNTS, _RESTS, _OFTEN = 0, 1, 2


def _growth(text_bytes: int) -> float:
    """By how much chunks and buckets are larger than those of a small corpus."""
    return max(1.0, math.sqrt(text_bytes / LEVEL_BYTES))


def _chunked(limit: int):
    """Texts as numbers of words in the list of words of their chunk, and that list, which is needed for the first step only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, _, _ in slices(batch, "text", limit):
                hashed = [_tokens(data, offsets) for _, data, offsets in slices(part, "text", CHUNK_BYTES)]
                tokens, sizes = (np.concatenate(x) for x in zip(*hashed))
                words, token = np.unique(tokens, return_inverse=True)
                doc, held = part.column("doc_id"), part.column("held_out")
                state = held.cast(pa.int8()).fill_null(2).to_numpy(zero_copy_only=False)
                content = packed(
                    token=token.astype(np.uint32), sizes=sizes.astype(np.int64), held=state,
                    doc=doc.fill_null(0).to_numpy(zero_copy_only=False), null=doc.is_null().to_numpy(zero_copy_only=False),
                )
                row = [number, int(sizes[state == 0].sum()), len(tokens), content, packed(step=np.diff(words, prepend=np.uint64(0)))]
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], [c.split()[0] for c in CHUNK.split(", ")])
                number += 1

    return run


@dataclass
class Listed:
    """The distinct runs of one length in a chunk, by bucket and ascending there, and which tokens they end at."""

    at: np.ndarray
    keys: np.ndarray | None  # not known of words that are counted
    place: np.ndarray | None
    back: np.ndarray
    cuts: np.ndarray
    context: np.ndarray | None = None  # number of the run without its last word
    n: np.ndarray | None = None  # known once the counts are
    often: np.ndarray | None = None
    number: np.ndarray | None = None

    def gathered(self, answers: list[dict], name: str, other) -> np.ndarray:
        """What the buckets have answered, run by run."""
        found = np.full(int(self.cuts[-1]), other)
        for a in answers:
            at = self.cuts[int(a["bucket"][0])]
            found[at : at + len(a[name])] = a[name]
        return found

    def _held(self, bucket: int) -> np.ndarray:
        """The frequent runs of a bucket."""
        return self.cuts[bucket] + np.flatnonzero(self.often[self.cuts[bucket] : self.cuts[bucket + 1]])

    def numbers(self, contents, base: np.ndarray) -> np.ndarray:
        """The number of each frequent run, else -1."""
        found = np.full(int(self.cuts[-1]), -1, np.int64)
        for content in contents:
            a = unpacked(content)
            bucket = int(a["bucket"][0])
            found[self._held(bucket)] = base[bucket] + np.cumsum(a["step"], dtype=np.int64)
        return found

    def rests(self, contents) -> np.ndarray:
        """What the runs leave to their suffixes as contexts; 1 where they are not kept."""
        found = np.ones(int(self.cuts[-1]))
        for content in contents:
            a = unpacked(content)
            run = self._held(int(a["bucket"][0]))[np.cumsum(a["step"], dtype=np.int64)]
            found[run] = 1 - (a["listed"] - DISCOUNT * a["parts"]) / self.n[run]
        return found


class Runs:
    """The runs of 1, 2, ... words of a chunk, as far as the buckets have answered; all arrays are by token.

    It stops before counts that are missing (``asked``), before rests that are missing (``entries``), or at
    runs of ``most`` words.
    """

    def __init__(self, content: bytes, buckets: int, total: float, bases: tuple, answers: pd.DataFrame | None = None, most: int = 0, words: bytes = b""):
        """``bases``: of each length that is numbered, the number of the first frequent run of each bucket, and of all.

        ``words`` are asked for as long as there are no answers.
        """
        self.part = unpacked(content)
        self.sizes, self.buckets, self.bases = self.part["sizes"], buckets, bases
        self.token = tokens = self.part["token"].astype(np.int64)
        self.first = np.zeros(len(tokens), bool)
        self.first[np.cumsum(self.sizes) - self.sizes] = True
        self.trained = np.repeat(self.part["held"] == 0, self.sizes)
        self.length = 1
        if answers is None:
            hashes = np.cumsum(unpacked(words)["step"], dtype=np.uint64)
            self.listed = Listed(np.arange(len(tokens)), hashes, None, tokens, self._cuts(self._bucket(hashes)))
            return
        kinds = {k: f["content"] for k, f in answers.groupby("kind")}
        counted = [unpacked(c) for c in kinds[_kind(1, _COUNTS)]]
        sizes = np.zeros(buckets + 1, np.int64)
        for a in counted:
            sizes[int(a["bucket"][0]) + 1] = len(a["n"])
        self.words = self.listed = Listed(np.arange(len(tokens)), None, None, tokens, np.cumsum(sizes))
        self._count(kinds, counted)
        self.known = self.n > 0
        self.base = (self.n + 0.5) / total
        self.p = self.base.copy()
        while self.length != most:
            shorter = self._lengthen()
            if _kind(self.length, _COUNTS) not in kinds:
                return
            self._count(kinds, [unpacked(c) for c in kinds[_kind(self.length, _COUNTS)]])
            if _kind(self.length - 1, _RESTS) not in kinds:
                return
            rests = np.ones(len(self.n))
            rests[shorter.at] = shorter.rests(kinds[_kind(self.length - 1, _RESTS)])[shorter.back]
            rests = self._before(rests, 1.0)  # 1 where the context is not kept
            share = np.where(self.often & (rests < 1), (self.n - DISCOUNT) / np.maximum(self.size, 1), 0.0)
            self.p = share + rests * self.p

    def _bucket(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)

    def _cuts(self, bucket: np.ndarray) -> np.ndarray:
        return np.searchsorted(bucket, np.arange(self.buckets + 1, dtype=np.uint64))

    def _list(self, shorter: Listed, at: np.ndarray) -> Listed:
        """Of the runs of one more word, by the numbers of both parts, that end at some tokens.

        Numbers ascend with places in the lists of the chunk, so the places, which are small, are sorted in their stead.
        """
        head, word = self.run[at - 1], self.token[at]
        place, back = _distinct(head, word, len(self.words.n))
        context = shorter.number[head[place]]
        keys = context.astype(np.uint64) * np.uint64(self.bases[0][-1]) + self.words.number[word[place]].astype(np.uint64)
        bucket = self._bucket(mixed(keys))
        order = np.argsort(bucket.astype(np.uint16) if self.buckets <= 1 << 16 else bucket, kind="stable")
        new = np.empty(len(order), np.int64)
        new[order] = np.arange(len(order))
        return Listed(at, keys[order], place[order], new[back], self._cuts(bucket[order]), context[order])

    def _before(self, values: np.ndarray, other) -> np.ndarray:
        """The value of the token before, within a text."""
        found = np.full(len(values), other, values.dtype)
        found[1:] = values[:-1]
        found[self.first] = other
        return found

    def _count(self, kinds: dict, counted: list[dict]) -> None:
        x = self.listed
        x.n = x.gathered(counted, "n", 0)
        x.often = x.n >= LEAST_COUNT
        self.own = x.gathered(counted, "own", False)
        self.n, self.run = np.zeros(len(self.first), np.int64), np.zeros(len(self.first), np.int64)
        self.n[x.at], self.run[x.at] = x.n[x.back], x.back
        self.often = self.n >= LEAST_COUNT
        if self.length <= len(self.bases):
            x.number = x.numbers(kinds.get(_kind(self.length, _OFTEN), ()), self.bases[self.length - 1])

    def _lengthen(self) -> Listed:
        """Go on to runs of one more word, of which both shorter parts stand there often enough."""
        shorter, at = self.listed, np.flatnonzero(self._before(self.often, False) & self.often)
        self.size = self._before(self.n, 0)
        self.length += 1
        self.listed = self._list(shorter, at)
        return shorter

    def asked(self) -> Iterator[tuple[int, bytes]]:
        """Per bucket: the distinct runs, and how often training texts have them."""
        x = self.listed
        n = np.bincount(x.back, self.trained[x.at], len(x.keys)).astype(np.uint32)
        for b in np.flatnonzero(np.diff(x.cuts)):
            s = slice(x.cuts[b], x.cuts[b + 1])
            yield int(b), packed(step=np.diff(x.keys[s], prepend=np.uint64(0)), n=n[s])

    def entries(self) -> pd.DataFrame:
        """By context, sums over the entries that this chunk has to hand on: counts, their number, P after the suffix, gain."""
        x = self.listed
        own = np.flatnonzero(self.own & x.often)
        at = x.at[x.place[own]]
        number, first, back = np.unique(x.context[own], return_index=True, return_inverse=True)
        n, size, parent = self.n[at], self.size[at], self.p[at]
        listed, parts, covered, gain = (np.bincount(back.ravel(), x, len(number)) for x in (n, np.ones(len(at)), parent, n * np.log(n / size / parent)))
        base = self.bases[self.length - 2]
        bucket = np.searchsorted(base, number, side="right") - 1
        key = (bucket.astype(np.int64) << _RANK_BITS) | (number - base[bucket])
        columns = {"key": key, "size": size[first], "listed": listed.astype(np.int64), "parts": parts.astype(np.int64)}
        return pd.DataFrame(columns | {"covered": covered, "gain": gain})

    def scores(self) -> pd.DataFrame:
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        known, base, score = (np.bincount(text, x, len(self.sizes)) for x in (self.known, np.log10(self.base), np.log10(self.p)))
        columns = {"doc_id": pd.array(self.part["doc"], "Int64"), "held_out": pd.array(self.part["held"] == 1, "boolean")}
        columns["doc_id"][self.part["null"]] = pd.NA
        columns["held_out"][self.part["held"] == 2] = pd.NA
        return pd.DataFrame(columns | {"n_tokens": self.sizes, "n_known": known.astype(np.int64), "base_score": base, "score": score})


def _distinct(head: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct pair stands first, in ascending order, and for each pair which of these it is.

    Pairs and their places are sorted as one number where it has room for both, which is several times as
    fast as sorting places by pairs.
    """
    code, bits = head * words + word, len(head).bit_length()
    if (int(head.max(initial=0)) + 1) * words << bits < 1 << 63:
        code = code << bits | np.arange(len(code))
        code.sort()
        order = code & ((1 << bits) - 1)
        code >>= bits
    else:
        order = np.argsort(code, kind="stable")
        code = code[order]
    fresh = np.ones(len(code), bool)
    fresh[1:] = code[1:] != code[:-1]
    back = np.empty(len(code), np.int64)
    back[order] = np.cumsum(fresh) - 1
    return order[fresh], back


def _kind(length: int, what: int) -> int:
    return 3 * length + what


def _ask(buckets: int, total: float, bases: tuple):
    def run(chunks: pd.DataFrame, answers: pd.DataFrame | None = None) -> pd.DataFrame:
        made = []
        for row in chunks.itertuples():
            runs = Runs(row.content, buckets, total, bases, answers, words=getattr(row, "words", b""))
            made.extend((b, row.chunk, c) for b, c in runs.asked())
        return pd.DataFrame(made, columns=["bucket", "chunk", "content"])

    return run


def _add_up(length: int, numbered: bool):
    """For each chunk: the counts of its runs in all training texts, for which runs it speaks, and the ranks of frequent ones.

    ``frequent`` is the number of frequent runs of the bucket, in its first row.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [unpacked(c) for c in frame["content"]]
        runs, first, back = np.unique(np.concatenate([np.cumsum(p["step"]) for p in parts]), return_index=True, return_inverse=True)
        back = back.ravel()
        n = np.bincount(back, np.concatenate([p["n"] for p in parts]), len(runs)).astype(np.int64)
        own = np.zeros(len(back), bool)
        own[first] = True
        if length > 1:
            n[n < LEAST_COUNT] = 0
        often = n >= LEAST_COUNT
        rank = np.cumsum(often, dtype=np.uint32) - np.uint32(1)
        small = np.int64 if n.max(initial=0) >> 31 else np.int32
        rows, at = [], 0
        for chunk, bucket, p in zip(frame["chunk"], frame["bucket"], parts):
            s = slice(at, at + len(p["step"]))
            mine, frequent = back[s], 0 if at else int(often.sum())
            at = s.stop
            content = packed(bucket=np.array([bucket]), n=n[mine].astype(small), own=own[s])
            rows.append((chunk, _kind(length, _COUNTS), int((own[s] & (n[mine] > 0)).sum()), content, bucket, frequent))
            ranks = rank[mine[often[mine]]] if numbered else ()
            if len(ranks):
                content = packed(bucket=np.array([bucket]), step=np.diff(ranks, prepend=np.uint32(0)))
                rows.append((chunk, _kind(length, _OFTEN), 0, content, bucket, 0))
        return pd.DataFrame(rows, columns=["chunk", "kind", "words", "content", "bucket", "frequent"])

    return run


def _tell_rests(length: int):
    """For each chunk: which of the contexts that it has are kept, with the sum and the number of their entries.

    What they leave to their suffixes follows from these small numbers and the count, which the chunk knows.
    """

    def run(asked: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(keys := kept["key"].to_numpy() & ((1 << _RANK_BITS) - 1))
        keys, listed, parts = keys[order], kept["listed"].to_numpy()[order], kept["parts"].to_numpy()[order]
        small = np.int64 if listed.max(initial=0) >> 31 else np.int32
        rows = []
        for row in asked.itertuples():
            found = _find(keys, np.cumsum(unpacked(row.content)["step"], dtype=np.int64))
            at = np.flatnonzero(found >= 0)
            content = packed(
                bucket=np.array([row.bucket]), step=np.diff(at.astype(np.uint32), prepend=np.uint32(0)),
                listed=listed[found[at]].astype(small), parts=parts[found[at]].astype(small),
            )
            rows.append((row.chunk, _kind(length, _RESTS), 0, content))
        return pd.DataFrame(rows, columns=["chunk", "kind", "words", "content"])

    return run


def _kept(entries: DataFrame) -> DataFrame:
    """``bucket, key, listed, parts`` of the contexts that diverge from their suffixes, as in ``Tree.add_depth``."""
    sums = entries.groupBy("key").agg(
        F.max("size").alias("size"), *[F.sum(c).alias(c) for c in ("listed", "parts", "covered", "gain")]
    )
    left = F.greatest(F.col("size") - F.col("listed"), F.lit(0))
    other = F.greatest(1 - F.col("covered"), F.lit(1e-12))
    gain = F.col("gain") + F.when(left > 0, left * F.log(left / F.col("size") / other)).otherwise(0.0)
    kept = sums.where(2 * gain > F.col("parts") + DEVIATIONS * F.sqrt(2 * F.col("parts")))
    return kept.select(F.shiftright("key", _RANK_BITS).alias("bucket"), "key", "listed", "parts")


def _exchanged(chunks: DataFrame, trained: int, buckets: int, depth: int) -> DataFrame:
    """The scores by a tree that stays in buckets."""
    answer = ["chunk", "kind", "content"]
    bases: tuple[np.ndarray, ...] = ()

    def counted(asked: DataFrame, length: int) -> DataFrame:
        """The counts of the runs of a length, and the ranks of the frequent ones, which go on as contexts."""
        numbered = length <= depth
        rows = write_step(asked.groupBy("bucket").applyInPandas(_add_up(length, numbered), _COUNTED), f"lm-counts-{length}")
        if numbered:
            sizes = np.zeros(buckets + 1, np.int64)
            for r in rows.where(F.col("frequent") > 0).groupBy("bucket").agg(F.sum("frequent").alias("n")).collect():
                sizes[r["bucket"] + 1] = r["n"]
            nonlocal bases
            bases += (np.cumsum(sizes),)
            if int(bases[0][-1]) * int(bases[-1][-1]) >= 1 << 64:
                raise OverflowError("runs of words have too many numbers")
        return rows

    whole = chunks
    answers = counted(whole.select("chunk", "content", "words").mapInPandas(lambda frames: map(_ask(buckets, 0.0, ()), frames), _ASKED), 1)
    chunks = write_table(whole.select("chunk", "content"), "lm-texts")  # most of what was written are the words
    drop_table(whole)
    total = trained + 0.5 * (answers.agg(F.sum("words")).first()[0] + 1)
    often = answers.where(F.col("kind") == _kind(1, _OFTEN)).select("bucket", "chunk", "content")
    answers = answers.select(answer)

    def told(what, schema: str) -> DataFrame:
        return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(what, schema)

    def entries(numbers: tuple):
        return lambda part, known: pd.concat([Runs(row.content, buckets, total, numbers, known).entries() for row in part.itertuples()])

    def scored(numbers: tuple):
        return lambda part, known: pd.concat([Runs(row.content, buckets, total, numbers, known, depth + 1).scores() for row in part.itertuples()])

    for length in range(1, depth + 1):
        rows = counted(told(_ask(buckets, total, bases), _ASKED), length + 1)
        answers = answers.unionByName(rows.select(answer))
        rests = often.groupBy("bucket").cogroup(_kept(told(entries(bases), _ENTRY)).groupBy("bucket")).applyInPandas(_tell_rests(length), _ANSWER)
        answers = answers.unionByName(write_step(rests, f"lm-rests-{length}").select(answer))
        often = rows.where(F.col("kind") == _kind(length + 1, _OFTEN)).select("bucket", "chunk", "content")
    columns = ("doc_id", "held_out", "n_tokens", "n_known", F.lit(trained).cast("bigint").alias("train_tokens"), "base_score", "score")
    return told(scored(bases), _SCORE).select(*columns)
