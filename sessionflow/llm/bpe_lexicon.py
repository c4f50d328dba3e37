"""BPE encoding by a minimal acyclic transducer of frequent words.

Words are what Unicode white space separates. The most frequent ones of the corpus, counted over all
documents, are compiled into a minimal acyclic automaton whose arcs carry outputs: along the path of a
word they add up to its number, which leads to its token ids. Words with common endings share the states
of these endings. The automaton is a few flat arrays in one file below the shared folder; Spark hands the
file to every executor, whose workers map it into memory. Other words are merged exactly by the ranks of
the vocabulary. Token strings are joined by blanks when ids are decoded, as the library does for this
vocabulary, which has no decoder.

Defined results: a null text is empty and has no tokens; texts of any length are encoded whole; special
tokens that stand in a text become their ids; repeated rows are encoded each; an empty table gives an
empty result and an empty lexicon; other columns pass through, but one with the name of an added column is
replaced.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from sessionflow.llm.texts import slices
from sessionflow.workdir import drop_table, shared_dir, write_table

#: Words in the automaton; its file has a few megabytes whatever the size of the corpus.
LEXICON_WORDS = 1 << 17
#: Words longer than this are merged, not looked up.
LONGEST_ENTRY = 64
#: Distinct words that a counting task holds before it hands its counts on.
COUNTED_WORDS = 1 << 19
#: Words and pieces of words whose ids a worker keeps.
WORD_CACHE, PIECE_CACHE = 1 << 16, 1 << 17
#: Bytes up to which a list serves better than a queue.
SHORT_PIECE = 48
#: Pieces that merge side by side.
MERGED_ROWS = 8192

#: Bytes of texts that are worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
# Unicode white space in UTF-8, by first byte, second byte and third byte.
_ONE_BYTE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]
_TWO_BYTES = [(0xC2, 0x85), (0xC2, 0xA0)]
_THREE_BYTES = [(0xE1, 0x9A, [0x80]), (0xE2, 0x80, [*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF]), (0xE2, 0x81, [0x9F]), (0xE3, 0x80, [0x80])]


def white_space(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space."""
    table = np.zeros(256, dtype=bool)
    table[_ONE_BYTE] = True
    found = table[data]
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    one, two = (data[np.minimum(lead + i, len(data) - 1)] if len(data) else lead for i in (1, 2))
    for first, second in _TWO_BYTES:
        at = lead[(data[lead] == first) & (one == second)]
        found[at] = found[at + 1] = True
    for first, second, thirds in _THREE_BYTES:
        at = lead[(data[lead] == first) & (one == second) & np.isin(two, thirds)]
        found[at] = found[at + 1] = found[at + 2] = True
    return found


def coded_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts, the place of each word among them, and the number of words of each text."""
    inside = ~white_space(data)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    place = np.concatenate([[0], np.cumsum(inside)])
    bounds = np.concatenate([place[starts], place[-1:]])
    kept = np.ascontiguousarray(data[inside])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(kept)])
    coded = words.dictionary_encode()
    number = np.diff(np.searchsorted(starts, offsets))
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), number


class Vocabulary:
    """Tokens, merges and special tokens of a word-end BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, number in [*self.ids.items(), *self.special.items()]:
            self.tokens[number] = token
        self._special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._pieces = regex.compile(split["pattern"]["Regex"])
        self._tables()
        # the bytes of each token, and the blank that joins it to the next one
        strings = [t.encode() + b" " for t in self.tokens]
        self.joined = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.joined_sizes = np.array(list(map(len, strings)), dtype=np.int64)
        self.joined_starts = np.cumsum(self.joined_sizes) - self.joined_sizes
        self.merged = lru_cache(maxsize=WORD_CACHE)(self._merge_word)
        self.piece = lru_cache(maxsize=PIECE_CACHE)(self._merge_piece)

    def _tables(self) -> None:
        """Merges as sorted pairs of ids, and the ids of bytes within and at the end of a piece."""
        pairs = [(self.ids[a] << 32 | self.ids[b], r, self.ids[a + b]) for (a, b), r in self.ranks.items()]
        pairs.sort()
        self._pairs, self._pair_ranks, self._pair_ids = (np.array(c, dtype=np.int64) for c in zip(*pairs))
        self._byte_ids = np.array([self.ids[c] for c in _BYTE_CHARS], dtype=np.int64)
        self._end_ids = np.array([self.ids[c + self.end] for c in _BYTE_CHARS], dtype=np.int64)

    def _ranked(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair of ids and the id it merges to; pairs that do not merge rank last."""
        key = first << 32 | second
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        hit = (self._pairs[at] == key) & (first >= 0) & (second >= 0)
        return np.where(hit, self._pair_ranks[at], len(self._pairs)), self._pair_ids[at]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without white space, one after the other, and how many each has; pieces of all words merge side by side."""
        pieces: list[bytes] = []
        number = np.ones(len(words), dtype=np.int64)
        apart: dict[int, tuple[int, ...]] = {}
        for i, word in enumerate(words):
            if word.isascii() and word.isalpha():
                pieces.append(word.lower().encode())
            elif self._special.search(word):
                apart[i], number[i] = self._merge_word(word), 0
            else:
                found = self._split(word)
                pieces.extend(x.encode() for x in found)
                number[i] = len(found)
        ids, counts = self._merge_pieces(pieces)
        ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(number)])]
        lengths = np.diff(ends)
        if not apart:
            return ids, lengths
        parts = [np.array(apart[i], dtype=np.uint32) if i in apart else ids[a:b] for i, (a, b) in enumerate(zip(ends, ends[1:]))]
        return np.concatenate(parts), np.array(list(map(len, parts)), dtype=np.int64)

    def _merge_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array(list(map(len, pieces)), dtype=np.int64)
        counts = np.zeros(len(pieces), dtype=np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        low = 0
        for high in (4, 8, 12, 16, 24, 32, SHORT_PIECE):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            for start in range(0, len(rows), MERGED_ROWS):
                some = rows[start : start + MERGED_ROWS]
                symbols = self._merge_rows([pieces[i] for i in some.tolist()], sizes[some], high)
                counts[some] = (symbols >= 0).sum(axis=1)
                found.append((some, symbols[symbols >= 0]))
        for i in np.flatnonzero(sizes > SHORT_PIECE):
            ids = self.piece(pieces[i].decode())
            counts[i] = len(ids)
            found.append((np.array([i]), np.array(ids, dtype=np.int64)))
        out = np.zeros(int(counts.sum()), dtype=np.uint32)
        first = np.cumsum(counts) - counts
        for rows, ids in found:
            out[_runs(first[rows], counts[rows])] = ids
        return out, counts

    def _merge_rows(self, pieces: list[bytes], sizes: np.ndarray, width: int) -> np.ndarray:
        """One piece per row, as ids from the left: the pair of the lowest rank, the leftmost first, until none is left."""
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        symbols = np.full((len(pieces), width + 1), -1, dtype=np.int64)  # the last column stays empty
        symbols[:, :width][np.arange(width) < sizes[:, None]] = self._byte_ids[data]
        every = np.arange(len(pieces))
        symbols[every, sizes - 1] = self._end_ids[data[np.cumsum(sizes) - 1]]
        ranks, _ = self._ranked(symbols[:, :-1], symbols[:, 1:])
        place = np.arange(width + 1)
        active = every
        while len(active):
            at = ranks[active].argmin(axis=1)
            merges = ranks[active, at] < len(self._pairs)
            active, at = active[merges], at[merges]
            if not len(active):
                break
            own = np.arange(len(active))
            here = symbols[active]
            _, joined = self._ranked(here[own, at], here[own, at + 1])
            here = np.take_along_axis(here, np.minimum(place + (place > at[:, None]), width), axis=1)
            here[own, at] = joined
            order = ranks[active]
            order = np.take_along_axis(order, np.minimum(place[:-1] + (place[:-1] > at[:, None]), width - 1), axis=1)
            order[:, -1] = len(self._pairs)
            order[own, at] = self._ranked(joined, here[own, at + 1])[0]
            left = np.maximum(at - 1, 0)
            before = self._ranked(here[own, left], here[own, left + 1])[0]
            order[own, left] = np.where(at > 0, before, order[own, left])
            symbols[active], ranks[active] = here, order
        return symbols

    def _merge_word(self, word: str) -> tuple[int, ...]:
        """Token ids of a word without white space."""
        found, at = [], 0
        for mark in self._special.finditer(word):
            found.extend(self._encode_plain(word[at : mark.start()]))
            found.append(self.special[mark[0]])
            at = mark.end()
        found.extend(self._encode_plain(word[at:]))
        return tuple(found)

    def _encode_plain(self, word: str) -> list[int]:
        return list(chain.from_iterable(map(self.piece, self._split(word))))

    def _split(self, word: str) -> list[str]:
        # letter by letter, so that no letter looks at its neighbours
        normal = word.lower() if word.isascii() else "".join(map(str.lower, unicodedata.normalize("NFC", word)))
        return [normal] if normal.isascii() and normal.isalpha() else self._pieces.findall(normal)

    def _merge_piece(self, piece: str) -> list[int]:
        parts = [_BYTE_CHARS[b] for b in piece.encode()]
        parts[-1] += self.end
        return [self.ids[p] for p in (self._merge_short(parts) if len(parts) <= SHORT_PIECE else self._merge_long(parts))]

    def _merge_short(self, parts: list[str]) -> list[str]:
        """Join the pair of the lowest rank, the leftmost first, until none is left."""
        get, none = self.ranks.get, len(self.ranks)
        ranks = [get(p, none) for p in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), none)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same with a queue, in time proportional to the length times its logarithm."""
        right = list(range(1, len(parts) + 1))
        left = list(range(-1, len(parts) - 1))
        queue: list[tuple[int, int, str, str]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < len(parts):
                rank = self.ranks.get((parts[i], parts[j]))
                if rank is not None:
                    heapq.heappush(queue, (rank, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while queue:
            _, i, first, second = heapq.heappop(queue)
            j = right[i]
            if parts[i] != first or j >= len(parts) or parts[j] != second:
                continue
            parts[i], parts[j] = first + second, ""
            right[i] = right[j]
            if right[i] < len(parts):
                left[right[i]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [p for p in parts if p]

    def decode(self, ids) -> str:
        return " ".join([self.tokens[i] for i in ids])


def _byte_chars() -> list[str]:
    """A printable character for each byte: itself where it is one, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in chars:
            chars[b], spare = chr(spare), spare + 1
    return [chars[b] for b in range(256)]


_BYTE_CHARS = _byte_chars()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


# --- the automaton -------------------------------------------------------------------------------


class _State:
    __slots__ = ("arcs", "final", "number", "words")

    def __init__(self) -> None:
        self.arcs: list[tuple[int, _State]] = []
        self.final, self.number, self.words = False, -1, 0


def compile_lexicon(entries: dict[bytes, tuple[int, ...]]) -> bytes:
    """The automaton of some words as one file.

    Words come in byte order, so whatever leaves the path of the newest word is complete: such a state
    is replaced by an equal one that is already known, with the same arcs and the same finality.
    """
    root, known, states = _State(), {}, []
    path, last = [root], b""

    def close(down_to: int) -> None:
        while len(path) > down_to + 1:
            state = path.pop()
            key = (state.final, tuple((b, s.number) for b, s in state.arcs))
            same = known.get(key)
            if same is None:
                state.number = len(states)
                state.words = state.final + sum(s.words for _, s in state.arcs)
                known[key] = same = state
                states.append(state)
            parent = path[-1]
            parent.arcs[-1] = (parent.arcs[-1][0], same)

    order = sorted(entries)
    for word in order:
        common = len(os.path.commonprefix([word, last]))
        close(common)
        for b in word[common:]:
            state = _State()
            path[-1].arcs.append((b, state))
            path.append(state)
        path[-1].final = True
        last = word
    close(0)
    root.number = len(states)
    states.append(root)
    keys, targets, outputs = [], [], []
    for state in states:  # an arc adds the words that end here or go by an earlier arc
        passed = int(state.final)
        for b, target in state.arcs:
            keys.append(state.number << 8 | b)
            targets.append(target.number)
            outputs.append(passed)
            passed += target.words
    ids = [i for w in order for i in entries[w]]
    offsets = np.cumsum([0, *(len(entries[w]) for w in order)])
    arrays = [keys, targets, outputs, [s.final for s in states], offsets, ids]
    packed = [np.asarray(a, dtype=np.uint32) for a in arrays]
    head = struct.pack("<7I", root.number, *(len(a) for a in packed))
    return head + b"".join(a.tobytes() for a in packed)


class Lexicon:
    """The mapped file; ``lookup`` follows the arcs of many words at once."""

    def __init__(self, path: str):
        self.root, *sizes = struct.unpack("<7I", np.memmap(path, dtype=np.uint8, mode="r", shape=28).tobytes())
        whole = np.memmap(path, dtype=np.uint32, mode="r", offset=28) if sum(sizes) else np.zeros(0, dtype=np.uint32)
        whole = whole.view(np.ndarray)  # still mapped; plain arrays are read faster
        cuts = np.cumsum(sizes)[:-1]
        self.keys, self.targets, self.outputs, self.final, self.offsets, self.ids = np.split(whole, cuts)

    def lookup(self, words: pa.Array) -> np.ndarray:
        """The number of each word, or -1."""
        n = len(words)
        if not n or not len(self.keys):
            return np.full(n, -1, dtype=np.int64)
        words = words.cast(pa.large_binary())
        offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + n + 1]
        first, lengths = offsets[:-1], np.diff(offsets)
        data = np.frombuffer(words.buffers()[2], dtype=np.uint8)
        state = np.full(n, self.root, dtype=np.int64)
        number = np.zeros(n, dtype=np.int64)
        alive = np.flatnonzero((lengths > 0) & (lengths <= LONGEST_ENTRY))
        ended = lengths > LONGEST_ENTRY
        step = 0
        while len(alive):
            key = state[alive] << 8 | data[first[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key.astype(np.uint32)), len(self.keys) - 1)
            hit = self.keys[at] == key
            ended[alive[~hit]] = True
            alive, at = alive[hit], at[hit]
            state[alive] = self.targets[at]
            number[alive] += self.outputs[at]
            step += 1
            alive = alive[lengths[alive] > step]
        accepted = ~ended & (self.final[state] > 0)
        return np.where(accepted, number, -1)


@lru_cache(maxsize=2)
def mapped(file: str) -> Lexicon:
    return Lexicon(SparkFiles.get(file))


# --- on Spark ------------------------------------------------------------------------------------


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n`` over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            for _, data, offsets in slices(batch, "text", SLICE_BYTES):
                words, codes, _ = coded_words(data, offsets)
                held.append(pa.table({"word": words, "n": np.bincount(codes, minlength=len(words)).astype(np.int64)}))
                size += len(words)
                if size >= COUNTED_WORDS:
                    held = [_summed(held)]
                    size = held[0].num_rows
                    if size >= COUNTED_WORDS // 2:
                        yield from _word_rows(held.pop())
                        size = 0
        if held:
            yield from _word_rows(_summed(held))

    texts = docs.select(F.col(text_col).cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _summed(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])


def _word_rows(table: pa.Table) -> list[pa.RecordBatch]:
    named = table.set_column(0, "word", table.column("word").cast(pa.large_string()).cast(pa.string()))
    return named.combine_chunks().to_batches(max_chunksize=10_000)


def build_lexicon(docs: DataFrame, vocabulary_path: str, text_col: str = "text", words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words and hand the file to all executors; gives its name.

    At most ``words`` words of at most ``LONGEST_ENTRY`` bytes reach the driver.
    """
    spark = docs.sparkSession
    counts = write_table(word_counts(docs, text_col).where(F.octet_length("word") <= LONGEST_ENTRY), "word-counts")
    top = [r["word"] for r in counts.where(F.col("n") >= _least_count(counts, words)).select("word").toLocalIterator()]
    drop_table(counts)
    vocab = vocabulary(vocabulary_path)
    content = compile_lexicon({w.encode(): vocab.merged(w) for w in top})
    uri = f"{shared_dir(spark, 'lexicon')}.bin"
    _write_file(spark, uri, content)
    spark.sparkContext.addFile(uri)
    return uri.rpartition("/")[2]


def _least_count(counts: DataFrame, words: int) -> int:
    """The smallest count that at most ``words`` words reach."""
    by_count = counts.groupBy("n").agg(F.count("*").alias("words"))
    reach = by_count.select("n", F.sum("words").over(Window.orderBy(F.desc("n"))).alias("reach"))
    least = reach.where(F.col("reach") <= words).agg(F.min("n")).first()[0]
    return least if least is not None else 1 << 62


def _write_file(spark: SparkSession, uri: str, content: bytes) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(content)
    finally:
        out.close()


def encode(docs: DataFrame, vocabulary_path: str, lexicon: str, text_col: str = "text", with_decoded: bool = False, keep_text: bool = True) -> DataFrame:
    """The documents with ``bpe_ids`` (unsigned little-endian 32-bit integers), ``bpe_tokens`` (their number)
    and, if wanted, ``bpe_decoded``."""
    docs = docs.drop("bpe_ids", "bpe_tokens", "bpe_decoded")
    added = [StructField("bpe_ids", BinaryType()), StructField("bpe_tokens", LongType())]
    added += [StructField("bpe_decoded", StringType())] if with_decoded else []
    kept = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    schema = StructType([*kept, *added])

    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, words = vocabulary(vocabulary_path), mapped(lexicon)
        for batch in batches:
            for part, data, offsets in slices(batch, "bpe_ids", SLICE_BYTES):
                found = _encoded(data, offsets, vocab, words, with_decoded)
                yield pa.RecordBatch.from_arrays([*part.select(names).columns, *found], schema.names)

    # the texts travel under the name of a column that they become
    return docs.withColumn("bpe_ids", F.col(text_col).cast("string").cast("binary")).select(*[f"`{n}`" for n in names], "bpe_ids").mapInArrow(run, schema)


def _encoded(data: np.ndarray, offsets: np.ndarray, vocab: Vocabulary, lexicon: Lexicon, with_decoded: bool) -> list[pa.Array]:
    distinct, codes, n_words = coded_words(data, offsets)
    numbers = lexicon.lookup(distinct)
    known, other = np.flatnonzero(numbers >= 0), np.flatnonzero(numbers < 0)
    merged, merged_sizes = vocab.encode_words([w.decode("utf-8", "replace") for w in distinct.take(pa.array(other)).to_pylist()])
    lengths = np.zeros(len(distinct), dtype=np.int64)
    begin = lexicon.offsets[numbers[known]].astype(np.int64)
    lengths[known] = lexicon.offsets[numbers[known] + 1] - begin
    lengths[other] = merged_sizes
    first = np.cumsum(lengths) - lengths
    table = np.zeros(int(lengths.sum()), dtype=np.uint32)
    table[_runs(first[known], lengths[known])] = lexicon.ids[_runs(begin, lengths[known])]
    table[_runs(first[other], lengths[other])] = merged
    sizes = lengths[codes]
    tokens = table[_runs(first[codes], sizes)]
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(n_words)])]
    ids = tokens.astype("<u4")
    found = [pa.array([ids[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()), pa.array(np.diff(ends), pa.int64())]
    return [*found, _decoded(tokens, ends, vocab)] if with_decoded else found


def _decoded(tokens: np.ndarray, ends: np.ndarray, vocab: Vocabulary) -> pa.Array:
    """The token strings of each text joined by blanks."""
    sizes = vocab.joined_sizes[tokens]
    joined = vocab.joined[_runs(vocab.joined_starts[tokens], sizes)].tobytes()
    at = np.concatenate([[0], np.cumsum(sizes)])[ends].tolist()
    return pa.array([joined[a : b - 1] if b > a else b"" for a, b in zip(at, at[1:])], pa.binary()).cast(pa.string())


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of several runs, one run after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
