"""Alignment of two tokenisations of a text by diagonal run skipping.

Both tokenisers cover the same bytes, so each is an array of the byte offsets at which its tokens end. Offsets that both
arrays hold cut the tokens into groups, and the two tokens that end there are linked. Where both cut alike, equal offsets lie on a
diagonal: as many places apart in the two arrays as at the place before. Such a stretch is jumped by probing exponentially
longer blocks at the current shift; where a block differs, the irregular group is walked offset by offset until both meet again, which
sets the next shift. Arrays are cut into lanes at common ends first, and the lanes of a slice of texts proceed at once.

Tokens never cross the start of a word that follows a blank, in either vocabulary, which is checked when they are loaded. So
the distinct words of a slice are tokenised once and kept by the worker; a vocabulary without that property gets whole texts.

Counts of linked pairs cover the whole corpus. The most frequent pairs, of a bounded number, are sent to all tasks; links
of the others are counted by joins, in which no pair is frequent.

Defined results: a null or empty text, one that is not UTF-8, and one whose tokens do not give back its bytes have no tokens; strings of
special tokens are plain text; texts of any length are one alignment; repeated rows are counted each; an empty table gives
an empty result; other columns pass through, but one with the name of an added column is replaced.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType
from tokenizers import Tokenizer

from sessionflow.llm.batches import write_large
from sessionflow.llm.bpe_lexicon import _BYTE_CHARS, _runs
from sessionflow.llm.texts import slices
from sessionflow.workdir import drop_table, write_table

_ADDED = ["align_row", "align_a_ids", "align_b_ids", "align_a_closes", "align_b_closes"]
#: Bytes of texts that are aligned at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Words whose tokens a worker keeps between slices.
CACHED_WORDS = 300_000
#: Words that a tokeniser gets at once.
ENCODED_WORDS = 4096
#: Tokens between the places where lanes begin, and tokens that are searched for such a place.
LANE_TOKENS, LANE_SEARCH = 256, 16
#: Longest block that is probed at once.
LONGEST_PROBE = 64
#: Pairs that are sent to all tasks at most.
HOT_PAIRS = 1 << 20
#: Distinct pairs that a counting task holds before it hands its counts on.
COUNTED_PAIRS = 1 << 21
_MARK = "▁"
_BLANK = 0x20


# --- tokenisers ----------------------------------------------------------------------------------


class ByteTokens:
    """Byte-level BPE of a ``tokenizers`` file; a text is encoded behind a blank."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = spec["pre_tokenizer"] or {}
        self.splits = spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"]
        byte = {c: b for b, c in enumerate(_BYTE_CHARS)}
        size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        entries = [self._tokenizer.id_to_token(i) or "" for i in range(size)]
        self.pieces = [bytes(byte[c] for c in e) if all(c in byte for c in e) else e.encode() for e in entries]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with the blank."""
        return [e.ids for e in self._tokenizer.encode_batch(texts, add_special_tokens=False)]


class PieceTokens:
    """BPE of a ``sentencepiece`` model, which puts a blank before a text itself."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.splits = _MARK in names and not any(_MARK in n.lstrip(_MARK) for n in names)
        self._blank = [self._model.piece_to_id(_MARK)]
        self.pieces = [bytes([int(n[3:5], 16)]) if self._model.is_byte(i) else n.replace(_MARK, " ").encode() for i, n in enumerate(names)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = self._model.encode([t[1:] for t in texts], num_threads=1)
        # a word of the blank alone ends a text; an empty text would have no token
        return [self._blank if t == " " else ids for t, ids in zip(texts, found)]


class _Words:
    """Tokens of the words seen so far, by both tokenisers."""

    def __init__(self, a_path: str, b_path: str):
        self.tokenisers = [ByteTokens(a_path), PieceTokens(b_path)]
        self.sizes = [np.array([len(p) for p in t.pieces], dtype=np.int64) for t in self.tokenisers]
        self._first = [np.cumsum(n) - n for n in self.sizes]
        self._bytes = [np.frombuffer(b"".join(t.pieces), dtype=np.uint8) for t in self.tokenisers]
        self.splits = all(t.splits for t in self.tokenisers)
        self._clear()

    def _clear(self) -> None:
        self._words = pa.array([], pa.large_string())
        self._good = np.zeros(0, dtype=bool)
        self._ids = [np.zeros(0, dtype=np.int32)] * 2
        self._counts = [np.zeros(0, dtype=np.int64)] * 2

    def encode(self, words: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """For distinct words: which of them their tokens give back, and ids and numbers of tokens by tokeniser."""
        places = pc.fill_null(pc.index_in(words, value_set=self._words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(self._words) and len(self._words) + int((places < 0).sum()) > CACHED_WORDS:
            self._clear()
            places[:] = -1
        fresh = np.flatnonzero(places < 0)
        places[fresh] = len(self._words) + np.arange(len(fresh))
        if len(fresh):
            self._learn(words.take(pa.array(fresh)))
        found = []
        for ids, counts in zip(self._ids, self._counts):
            first = np.cumsum(counts) - counts
            found.append((ids[_runs(first[places], counts[places])], counts[places]))
        return self._good[places], found

    def _learn(self, fresh: pa.Array) -> None:
        texts = fresh.to_pylist()
        offsets = np.frombuffer(fresh.buffers()[1], dtype=np.int64)[: len(fresh) + 1]
        data = np.frombuffer(fresh.buffers()[2], dtype=np.uint8)
        good = np.ones(len(texts), dtype=bool)
        for i, tokeniser in enumerate(self.tokenisers):
            ids, counts = [self._ids[i]], [self._counts[i]]
            for start in range(0, len(texts), ENCODED_WORDS):
                lists = tokeniser.encode(texts[start : start + ENCODED_WORDS])
                counts.append(np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)))
                ids.append(np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=int(counts[-1].sum())))
            good &= self._given_back(i, np.concatenate(ids[1:]), np.concatenate(counts[1:]), data, offsets)
            self._ids[i], self._counts[i] = np.concatenate(ids), np.concatenate(counts)
        self._good = np.concatenate([self._good, good])
        self._words = pa.concat_arrays([self._words, fresh])

    def _given_back(self, i: int, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which words the bytes of their tokens give."""
        sizes = self.sizes[i][ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        lengths = np.diff(ends)
        good = lengths == np.diff(offsets)
        joined = self._bytes[i][_runs(self._first[i][ids], sizes)]
        fitting = np.flatnonzero(good)
        differs = joined[_runs(ends[fitting], lengths[fitting])] != data[_runs(offsets[fitting], lengths[fitting])]
        of_word = np.repeat(fitting, lengths[fitting])
        good[of_word[differs]] = False
        return good


@lru_cache(maxsize=2)
def _words(a_path: str, b_path: str) -> _Words:
    return _Words(a_path, b_path)


def _word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts begin, and blanks behind something that neither is nor may pass for white space.

    Of the characters beyond ASCII, those of three bytes that begin like a white space are taken for one; so are two-byte
    ones of the first block, where more of it lies.
    """
    blank = np.flatnonzero(data[1:] == _BLANK) + 1
    before = data[blank - 1]
    safe = (before > _BLANK) & (before < 0x7F)
    other = np.flatnonzero(before >= 0x80)
    if len(other):
        place = blank[other]
        one, two, three = data[place - 2], data[np.maximum(place - 3, 0)], data[np.maximum(place - 4, 0)]
        pair = (one >= 0xC3) & (one <= 0xDF)
        triple = (two >= 0xE3) & (two <= 0xEE) & ~((two == 0xE3) & (one == 0x80))
        safe[other] = pair | ((one < 0xC0) & (triple | (three >= 0xF0)))
    begins = np.zeros(len(data), dtype=bool)
    begins[blank[safe]] = True
    begins[offsets] = True
    return np.flatnonzero(begins)


# --- alignment -----------------------------------------------------------------------------------


def _lanes(a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cuts with further ones at common ends, some tokens apart."""
    tries = np.arange(LANE_TOKENS, len(a), LANE_TOKENS)
    if not len(tries):
        return a_cuts, b_cuts
    near = np.minimum(tries[:, None] + np.arange(LANE_SEARCH), len(a) - 1)
    at = np.minimum(np.searchsorted(b, a[near]), len(b) - 1)
    hit = b[at] == a[near]
    found = hit.argmax(axis=1)
    rows = np.flatnonzero(hit.any(axis=1))
    more_a, more_b = near[rows, found[rows]] + 1, at[rows, found[rows]] + 1
    return np.union1d(a_cuts, more_a), np.union1d(b_cuts, more_b)


def common_ends(a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which ends of two ascending arrays the other one has too.

    ``a_cuts`` and ``b_cuts`` are the indexes at which texts begin, and the lengths at last: there both arrays have gone equally far.
    """
    in_a, in_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
    a_cuts, b_cuts = _lanes(a, b, a_cuts, b_cuts)
    i, i_end, j = a_cuts[:-1].copy(), a_cuts[1:], b_cuts[:-1].copy()
    j_end = b_cuts[1:]
    probe = np.ones(len(i), dtype=np.int64)
    active = np.flatnonzero((i < i_end) & (j < j_end))
    while len(active):
        # a block of ends at the current shift; the next one is twice as long
        width = np.minimum(np.minimum(i_end[active] - i[active], j_end[active] - j[active]), probe[active])
        first = np.cumsum(width) - width
        from_a, from_b = _runs(i[active], width), _runs(j[active], width)
        differs = np.flatnonzero(a[from_a] != b[from_b])
        run = width.copy()
        if len(differs):
            lane = np.searchsorted(first, differs, side="right") - 1
            once = np.concatenate([[True], lane[1:] != lane[:-1]])
            run[lane[once]] = differs[once] - first[lane[once]]
        equal = _runs(first, run)
        in_a[from_a[equal]] = True
        in_b[from_b[equal]] = True
        i[active] += run
        j[active] += run
        irregular = active[run < width]
        probe[active] = np.minimum(probe[active] * 2, LONGEST_PROBE)
        probe[irregular] = 1
        # an irregular group: the end that lies behind moves on until both meet, which sets the new shift
        while len(irregular):
            x, y = a[i[irregular]], b[j[irregular]]
            i[irregular] += x < y
            j[irregular] += y < x
            irregular = irregular[(x != y) & (i[irregular] < i_end[irregular]) & (j[irregular] < j_end[irregular])]
        active = active[(i[active] < i_end[active]) & (j[active] < j_end[active])]
    return in_a, in_b


def _packed(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    ids = ids.astype("<u4")
    return pa.array([ids[x:y].tobytes() for x, y in zip(bounds, bounds[1:])], pa.binary())


def _bitmaps(flags: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.array([np.packbits(flags[x:y]).tobytes() for x, y in zip(bounds, bounds[1:])], pa.binary())


def _aligned(data: np.ndarray, offsets: np.ndarray, words: _Words) -> list[pa.Array]:
    """Ids and closing bits of the texts of a slice, by tokeniser."""
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes > 0)
    # a blank before each text
    starts = np.concatenate([[0], np.cumsum(sizes[full] + 1)])
    spaced = np.full(int(starts[-1]), _BLANK, dtype=np.uint8)
    body = np.ones(len(spaced), dtype=bool)
    body[starts[:-1]] = False
    spaced[body] = data
    begin = (_word_starts(spaced, starts[:-1]) if words.splits else starts[:-1]) if len(full) else np.zeros(0, dtype=np.int64)
    cuts = np.concatenate([begin, starts[-1:]]).astype(np.int64)
    column = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(cuts), pa.py_buffer(spaced))
    coded = column.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    good, found = words.encode(coded.dictionary)
    text_of = np.searchsorted(starts, begin, side="right") - 1
    spoilt = np.zeros(len(full), dtype=bool)
    spoilt[text_of[~good[codes]]] = True
    held = ~spoilt[text_of]
    codes, text_of = codes[held], text_of[held]
    ids, bounds, ends = [], [], []
    for (table, counts), size in zip(found, words.sizes):
        number = counts[codes]
        ids.append(table[_runs((np.cumsum(counts) - counts)[codes], number)])
        of_text = np.bincount(text_of, weights=number, minlength=len(full)).astype(np.int64)
        of_row = np.zeros(len(sizes), dtype=np.int64)
        of_row[full] = of_text
        bounds.append(np.concatenate([[0], np.cumsum(of_row)]))
        ends.append(np.cumsum(size[ids[-1]]))
    closes = common_ends(*ends, *[b[np.concatenate([[True], b[1:] > b[:-1]])] for b in bounds])
    return [_packed(ids[0], bounds[0]), _packed(ids[1], bounds[1]), _bitmaps(closes[0], bounds[0]), _bitmaps(closes[1], bounds[1])]


def _utf8(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts, those that are not UTF-8 as empty ones."""
    try:
        data.tobytes().decode()
        return data, offsets
    except UnicodeDecodeError:
        pass
    kept = []
    for x, y in zip(offsets, offsets[1:]):
        try:
            data[x:y].tobytes().decode()
            kept.append(data[x:y])
        except UnicodeDecodeError:
            kept.append(data[:0])
    return np.concatenate(kept), np.concatenate([[0], np.cumsum([len(k) for k in kept])])


def align(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """The documents with the ids of both tokenisers (``align_a_ids``, ``align_b_ids``, unsigned little-endian 32-bit integers)
    and, for each token, a bit that tells whether it closes a group (``align_a_closes``, ``align_b_closes``, first token in the
    highest bit). ``align_row`` numbers the rows. Written to the shared folder, as counts need all of it twice."""
    docs = docs.drop(*_ADDED)
    kept = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    names = [f.name for f in kept]
    schema = StructType([*kept, *[StructField(c, BinaryType()) for c in _ADDED[1:]]])
    bytes_of = "align_a_ids"  # the texts travel under the name of a column that they become

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(a_path, b_path)
        for batch in batches:
            for part, data, offsets in slices(batch, bytes_of, SLICE_BYTES):
                found = _aligned(*_utf8(data, offsets), words)
                yield pa.RecordBatch.from_arrays([*part.select(names).columns, *found], schema.names)

    texts = docs.withColumn(bytes_of, F.col(text_col).cast("string").cast("binary")).select(*names, bytes_of)
    return write_large(texts.mapInArrow(run, schema).withColumn("align_row", F.monotonically_increasing_id()), "aligned")


# --- links ---------------------------------------------------------------------------------------


def _column(batch: pa.RecordBatch, name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a packed column, and how many each row has."""
    array = batch.column(name)
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(array.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return np.frombuffer(data.tobytes(), dtype=kind), np.diff(offsets) // np.dtype(kind).itemsize


class _Rows:
    """Tokens and closing bits of some rows."""

    def __init__(self, batch: pa.RecordBatch):
        self.ids, self.counts, self.closes = [], [], []
        for side in "ab":
            ids, counts = _column(batch, f"align_{side}_ids", "<u4")
            bits, bytes_held = _column(batch, f"align_{side}_closes", "u1")
            first = 8 * (np.cumsum(bytes_held) - bytes_held)
            self.ids.append(ids)
            self.counts.append(counts)
            self.closes.append(np.unpackbits(bits)[_runs(first, counts)].astype(bool))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The pair of each link as one number, and the number of links of each row."""
        a, b = (ids[closes].astype(np.uint64) for ids, closes in zip(self.ids, self.closes))
        ends = np.concatenate([[0], np.cumsum(self.closes[0])])
        return a << np.uint64(32) | b, np.diff(ends[np.concatenate([[0], np.cumsum(self.counts[0])])])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some megabytes of rows at once, one at least."""
    for batch in batches:
        size = np.cumsum(_column(batch, "align_a_ids", "u1")[1])
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, before + SLICE_BYTES, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: the links of each pair (first id times 2**32 plus second id), and whether no other pair of
    the second id has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            pairs, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return pairs, np.bincount(at, weights=np.concatenate([h[1] for h in held]), minlength=len(pairs)).astype(np.int64)

        def rows(pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(n)], ["pair", "n"])

        for part in _parts(batches):
            pairs, n = np.unique(_Rows(part).links()[0], return_counts=True)
            held.append((pairs, n))
            size += len(pairs)
            if size >= COUNTED_PAIRS:
                held = [merged()]
                if len(held[0][0]) >= COUNTED_PAIRS // 2:
                    yield rows(*held.pop())
                size = sum(len(h[0]) for h in held)
        if held:
            yield rows(*merged())

    columns = [c for c in _ADDED if c != "align_row"]
    counts = aligned.select(*columns).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = write_large(counts, "pair-counts")
    second = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(second.alias("second")).agg(F.max("n").alias("most"))
    found = counts.join(most, second == F.col("second")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    found = write_table(found, "pairs")
    drop_table(counts)
    return found


def _hot(pairs: DataFrame, most: int) -> int:
    """The smallest power of two that at most ``most`` pairs reach by their counts."""
    power = F.floor(F.log2("n")).cast("int")
    left = most
    by_power = {r[0]: r[1] for r in pairs.groupBy(power).count().collect()}
    for p in sorted(by_power, reverse=True):
        left -= by_power[p]
        if left < 0:
            return 1 << (p + 1)
    return 1


def _sent(spark, pairs: DataFrame, least: int) -> Broadcast:
    table = pairs.where(F.col("n") >= least).toArrow()
    keys = table.column("pair").to_numpy().astype(np.uint64)
    order = np.argsort(keys)
    best = table.column("best").to_numpy().astype(bool)
    return spark.sparkContext.broadcast((keys[order], table.column("n").to_numpy()[order], best[order]))


def link_counts(aligned: DataFrame, pairs: DataFrame, hot_pairs: int | None = None) -> DataFrame:
    """``aligned`` with ``align_best`` (links whose pair is the most frequent one of its second id) and ``align_count_sum`` (the sum over
    links of the counts of their pairs), both over the whole corpus."""
    least = _hot(pairs, HOT_PAIRS if hot_pairs is None else hot_pairs)
    hot = _sent(aligned.sparkSession, pairs, least)
    counted = StructType([*aligned.schema.fields, StructField("align_best", LongType()), StructField("align_count_sum", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = hot.value
        for part in _parts(batches):
            links, number = _Rows(part).links()
            distinct, codes = np.unique(links, return_inverse=True)
            at, known = _found(keys, distinct)
            values = (np.where(known, column[at], 0)[codes] if len(keys) else np.zeros(len(codes), np.int64) for column in (best.astype(np.int64), n))
            ends = np.concatenate([[0], np.cumsum(number)])
            sums = [pa.array(np.diff(np.concatenate([[0], np.cumsum(v)])[ends]).astype(np.int64)) for v in values]
            yield pa.RecordBatch.from_arrays([*part.columns, *sums], counted.names)

    found = aligned.mapInArrow(run, counted)
    return found if least == 1 else _with_rare(aligned, found, pairs.where(F.col("n") < least), hot)


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _with_rare(aligned: DataFrame, found: DataFrame, rare: DataFrame, hot: Broadcast) -> DataFrame:
    """Adds the links of pairs that were not sent, each of which has few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            links, number = _Rows(part).links()
            rows = np.repeat(part.column("align_row").to_numpy(), number)
            other = ~_found(hot.value[0], links)[1]
            yield pa.RecordBatch.from_arrays([pa.array(rows[other]), pa.array(links[other].astype(np.int64))], ["row", "pair"])

    linked = aligned.mapInArrow(run, "row long, pair long")
    more = linked.join(rare, "pair").groupBy("row").agg(F.sum(F.col("best").cast("bigint")).alias("_best"), F.sum("n").alias("_sum"))
    joined = found.join(more, found["align_row"] == more["row"], "left")
    return joined.select(
        *[f"`{c}`" for c in aligned.columns],
        (F.col("align_best") + F.coalesce("_best", F.lit(0))).alias("align_best"),
        (F.col("align_count_sum") + F.coalesce("_sum", F.lit(0))).alias("align_count_sum"),
    )


# --- digests -------------------------------------------------------------------------------------


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of the numbers below ``size``, left-aligned, with a free place behind; and their lengths."""
    texts = [str(i).encode() for i in range(size)]
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    table = np.zeros((size, int(lengths.max(initial=1)) + 1), dtype=np.uint8)
    for i, t in enumerate(texts):
        table[i, : len(t)] = list(t)
    return table, lengths


@lru_cache(maxsize=1)
def _digit_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _digits(size)


def _group_texts(rows: _Rows) -> tuple[np.ndarray, np.ndarray]:
    """The groups of each row as ``a1,a2|b1;a3|b2,b3;``, one after the other, and the length of each."""
    n = [len(i) for i in rows.ids]
    sizes = [np.diff(np.concatenate([[-1], np.flatnonzero(c)])) for c in rows.closes]
    group = [np.repeat(np.arange(len(s)), s) for s in sizes]
    before = [np.concatenate([[0], np.cumsum(s)]) for s in sizes]
    place = [np.arange(n[0]) + before[1][group[0]], np.arange(n[1]) + before[0][group[1] + 1]]
    ids = np.empty(sum(n), dtype=np.int64)
    mark = np.full(sum(n), ord(","), dtype=np.uint8)
    for at, found, closes, last in zip(place, rows.ids, rows.closes, "|;"):
        ids[at] = found
        mark[at[closes]] = ord(last)
    table, lengths = _digit_table(1 << int(max(ids.max(initial=1), 1)).bit_length())
    size = lengths[ids]
    ends = np.cumsum(size + 1)
    text = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    first = ends - size - 1
    for i in range(table.shape[1] - 1):
        some = size > i
        text[first[some] + i] = table[ids[some], i]
    text[ends - 1] = mark
    row_ends = np.concatenate([[0], np.cumsum(rows.counts[0] + rows.counts[1])])
    return text, np.diff(np.concatenate([[0], ends])[row_ends])


def digests(counted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``<id>, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` from the rows of ``link_counts``."""
    columns = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    schema = StructType([counted.schema[id_col], *StructType.fromDDL(columns).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            rows = _Rows(part)
            groups = rows.links()[1]
            text, lengths = _group_texts(rows)
            ends = np.cumsum(lengths)
            view = memoryview(text)
            shas = [sha256(view[e - n : e - 1]).hexdigest() if n else "" for e, n in zip(ends.tolist(), lengths.tolist())]
            numbers = [pa.array(x.astype(np.int64)) for x in (*rows.counts, groups, groups)]
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), *numbers, part.column("align_best"), part.column("align_count_sum"), pa.array(shas, pa.string())], schema.names
            )

    return write_large(counted.mapInArrow(run, schema), "align-digests")
