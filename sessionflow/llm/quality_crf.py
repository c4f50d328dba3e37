"""Document quality by a linear-chain conditional random field over lines.

Every line of a document is good or bad. A line's score is linear in features of the line and of the
lines before and after it, and neighbouring lines of the same kind get a bonus. Forward and backward
messages give the marginal probability of each line to be good. Their mean, weighted by the lengths of the
lines, is turned into the probability that the document is good.

Labels exist for documents only. Lines start with the label of their document; after a first fit the
lines of bad documents that look good are relabelled, and the field is fitted again.

Defined results: a null or empty text is one empty line; texts are scored whole, whatever their length;
repeated rows get equal scores; without labels of both kinds every score is the share of good labels (1 if
there is none); an empty table gives an empty result; other columns pass through, but one named
like an added or inner column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sessionflow.llm.labelled import labelled_sample
from sessionflow.llm.texts import Rolling, lowered, slices, word_bounds

#: Labelled documents that are fitted on, at most.
SAMPLE_ROWS = 5_000
_TEXT = "quality_text"
_CLASSES = {
    "upper": [*range(65, 91)],
    "letters": [*range(65, 91), *range(97, 123), *range(128, 256)],
    "digits": [*range(48, 58)],
    "stops": [ord(c) for c in ".,;:?"],
    "marks": [ord(c) for c in "!\"'()-"],
    "signs": [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:?!\"'()-"],
}
_TABLE = np.zeros((256, len(_CLASSES)), np.float32)
for _i, _codes in enumerate(_CLASSES.values()):
    _TABLE[_codes, _i] = 1.0


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and lengths of the lines of some texts, and the number of lines of each text."""
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([breaks + 1, offsets[:-1]]))
    starts = starts[starts < len(data)]
    empty = offsets[:-1][np.diff(offsets) == 0]
    starts = np.sort(np.concatenate([starts, empty]))  # an empty text is a line of its own
    text = np.searchsorted(offsets, starts, side="right") - 1
    if len(empty):  # several texts may start at one place: the empty ones come first
        text = _texts_of(starts, offsets)
    bounds = np.append(starts, len(data))
    sizes = np.diff(bounds)
    n = len(starts)
    sums = np.zeros((n, len(_CLASSES)), np.float32)
    full = np.flatnonzero(sizes > 0)
    if len(full):
        for i in range(len(_CLASSES)):
            sums[full, i] = np.add.reduceat(_TABLE[:, i][data], bounds[:-1][full])
    low = lowered(data)
    begin, end, _ = word_bounds(low, np.append(np.unique(starts), len(data)))
    line = np.minimum(np.searchsorted(starts, begin, side="right") - 1, n - 1)
    words = np.bincount(line, minlength=n)
    hashes = Rolling(low).substrings(begin, end)
    distinct = _distinct(hashes, line, n)
    twice = np.zeros(len(hashes), bool)
    twice[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    last = _TABLE[data[end - 1]] if len(end) else np.zeros((0, len(_CLASSES)), np.float32)
    per_word, per_byte = np.maximum(words, 1), np.maximum(sizes, 1)
    columns = [sums[:, i] / per_byte for i in range(len(_CLASSES))]
    columns += [
        sums[:, 0] / np.maximum(sums[:, 1], 1),
        distinct / per_word,
        np.bincount(line, weights=twice, minlength=n) / per_word,
        np.bincount(line, weights=last[:, 4], minlength=n) / per_word,
        np.bincount(line, weights=last[:, 5], minlength=n) / per_word,
        np.bincount(line, weights=(end - begin == 1), minlength=n) / per_word,
        np.log1p(words) / 5.0,
        sizes / per_word / 10.0,
        (words == 0).astype(float),
    ]
    return np.stack(columns, axis=1).astype(np.float64), sizes, np.bincount(text, minlength=len(offsets) - 1)


def _texts_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The text of each line start, where empty texts have a start of their own."""
    at = np.searchsorted(offsets[:-1], starts, side="right") - 1
    first = np.searchsorted(offsets[:-1], starts, side="left")
    exact = offsets[:-1][np.minimum(first, len(offsets) - 2)] == starts
    # the i-th line that starts where texts start belongs to the i-th of these
    place = np.arange(len(starts)) - np.searchsorted(starts, starts, side="left")
    return np.where(exact, np.minimum(first + place, at), at)


def _distinct(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((values, groups))
    v, g = values[order], groups[order]
    fresh = np.ones(len(v), bool)
    fresh[1:] = (v[1:] != v[:-1]) | (g[1:] != g[:-1])
    return np.bincount(g[fresh], minlength=n)


def with_neighbours(features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Features of each line, of the one before and of the one after (zeros at the ends), and a one."""
    n = len(features)
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    ends = np.cumsum(counts)
    starts = (ends - counts)[counts > 0]
    before[starts] = 0
    after[ends[counts > 0] - 1] = 0
    return np.concatenate([features, before, after, np.ones((n, 1))], axis=1)


def _message(x: np.ndarray, bonus: float) -> np.ndarray:
    """What a line with log-odds ``x`` tells its neighbour, as log-odds."""
    return np.logaddexp(x + bonus, 0.0) - np.logaddexp(x, bonus)


def messages(scores: np.ndarray, counts: np.ndarray, bonus: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of each line from itself and all before it, and from all after it.

    All texts take a step together; those with fewer lines drop out.
    """
    order = np.argsort(-counts, kind="stable")
    starts, sizes = (np.cumsum(counts) - counts)[order], counts[order]
    forward, backward = scores.copy(), np.zeros_like(scores)
    longest = int(sizes.max(initial=0))
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # texts with more lines than t
    for t in range(1, longest):
        at = starts[: active[t]] + t
        forward[at] += _message(forward[at - 1], bonus)
    last = starts + sizes - 1
    for t in range(1, longest):
        at = last[: active[t]] - t
        backward[at] = _message(scores[at + 1] + backward[at + 1], bonus)
    return forward, backward


@dataclass
class Model:
    """Line weights, the bonus of equal neighbours, and the line from mean log-odds to log-odds of a text."""

    weights: np.ndarray | None
    bonus: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    base: float = 1.0

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        features, sizes, counts = line_features(data, offsets)
        if self.weights is None:
            return np.full(len(counts), self.base)
        return _sigmoid(self.slope * _log_odds(self.means(features, sizes, counts)) + self.shift)

    def marginals(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        forward, backward = messages(with_neighbours(features, counts) @ self.weights, counts, self.bonus)
        return _sigmoid(forward + backward)

    def means(self, features: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The share of good text in each document."""
        good, weight = self.marginals(features, counts), np.maximum(sizes, 1)
        text = np.repeat(np.arange(len(counts)), counts)
        return np.bincount(text, good * weight, len(counts)) / np.maximum(np.bincount(text, weight, len(counts)), 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", usable: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on a bounded sample; features of its lines reach the driver."""
    sample = labelled_sample(docs, labels, label, sample_rows, usable)
    sample = sample.select("label", F.col("text").cast("binary").alias(_TEXT))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, _TEXT):
                features, sizes, counts = line_features(data, offsets)
                ends = np.cumsum(counts)
                spans = [slice(e - n, e) for e, n in zip(ends, counts)]
                columns = [pa.array([x[s].tobytes() for s in spans], pa.binary()) for x in (features.astype(np.float32), sizes)]
                yield pa.RecordBatch.from_arrays([part.column("label"), *columns], ["label", "features", "sizes"])

    rows = sample.mapInArrow(extract, "label int, features binary, sizes binary").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["label"], r["features"]))
    good = np.array([r["label"] > 0 for r in rows])
    if not len(good) or good.all() or not good.any():
        return Model(None, base=float(good.mean()) if len(good) else 1.0)
    sizes = [np.frombuffer(r["sizes"], np.int64) for r in rows]
    features = [np.frombuffer(r["features"], np.float32).reshape(len(s), -1) for r, s in zip(rows, sizes)]
    return fit_rows(np.concatenate(features).astype(np.float64), np.concatenate(sizes), np.array([len(s) for s in sizes]), good)


def fit_rows(features: np.ndarray, sizes: np.ndarray, counts: np.ndarray, good: np.ndarray, rounds: int = 3) -> Model:
    text = np.repeat(np.arange(len(counts)), counts)
    target = good[text].astype(float)
    model = Model(np.zeros(3 * features.shape[1] + 1))
    for _ in range(rounds):
        _climb(model, features, counts, target, good)
        marginal = model.marginals(features, counts)
        target = np.where(good[text], 1.0, (marginal > 0.5).astype(float))
    odds = _log_odds(model.means(features, sizes, counts))
    weight = np.where(good, 0.5 / good.sum(), 0.5 / (~good).sum())
    for _ in range(2000):  # logistic regression of the labels on one number
        error = weight * (good - _sigmoid(model.slope * odds + model.shift))
        model.slope += 0.1 * float((error * odds).sum()) - 1e-4 * model.slope
        model.shift += 0.1 * float(error.sum())
    return model


def _climb(model: Model, features: np.ndarray, counts: np.ndarray, target: np.ndarray, good: np.ndarray, steps: int = 120) -> None:
    """Raise the likelihood of the line labels, both kinds of texts weighing the same, by Adam steps."""
    inputs = with_neighbours(features, counts)
    text = np.repeat(np.arange(len(counts)), counts)
    share = np.bincount(good[text].astype(int), minlength=2)
    weight = 0.5 / np.maximum(share, 1)[good[text].astype(int)]
    inner = np.ones(len(text), bool)
    inner[np.cumsum(counts)[counts > 0] - 1] = False
    inner = np.flatnonzero(inner)
    theta = np.append(model.weights, model.bonus)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        scores = inputs @ theta[:-1]
        forward, backward = messages(scores, counts, theta[-1])
        error = weight * (target - _sigmoid(forward + backward))
        u, w = forward[inner], scores[inner + 1] + backward[inner + 1]
        agree = theta[-1] + np.logaddexp(0.0, u + w)
        agree = _sigmoid(agree - np.logaddexp(u, w))
        same = (target[inner] == target[inner + 1]).astype(float)
        gradient = np.append(inputs.T @ error, (weight[inner] * (same - agree)).sum()) - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model.weights, model.bonus = theta[:-1], float(theta[-1])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents, without text, with ``quality_score``."""
    docs = docs.drop("quality_score", _TEXT)
    others = [c for c in docs.columns if c != text_col]
    schema = StructType([*(f for f in docs.schema.fields if f.name != text_col), StructField("quality_score", DoubleType())])
    rows = docs.select(*[f"`{c}`" for c in others], F.col(text_col).cast("string").cast("binary").alias(_TEXT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, _TEXT):
                kept = part.select(others)
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(model.score(data, offsets))], schema.names)

    return rows.mapInArrow(run, schema)
