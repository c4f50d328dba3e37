"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

A document has a severity grade from 0 (clean) to 3. All grades share one weight vector, and each step
between grades has a threshold of its own: ``P(grade <= k) = sigmoid(threshold_k - w . x)`` with ascending
thresholds. The features are words and the first four and five letters of words, each with the
logarithm of how often it occurs; a penalty on the absolute weights leaves few of them. The expected
severity is the sum of ``P(grade > k)``.

Labels only tell toxic from clean. Grades 1 to 3 come from them: a feature counts as evidence if several
toxic documents of the sample have it and no clean one does, and the toxic documents are split into
thirds by how often they show evidence.

Defined results: a null or empty text has no features, hence the severity that the thresholds give; long
texts are scored whole; rows are scored each by itself, so repeated rows get equal scores; without toxic
labels nothing is toxic; an empty table gives an empty result; other columns pass through, but
one with the name of an added column is replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from sessionflow.llm.labelled import labelled_sample
from sessionflow.workdir import write_table

#: Labelled documents that are fitted on, at most.
SAMPLE_ROWS = 12_000
HASH_BITS = 22
LEAST_DOCUMENTS = 4
GRADES = 4
PENALTY = 1e-3
#: A feature has to be so much more frequent in toxic documents.
LEAST_RATIO = 4.0
#: And stand in this share of them, so that what only copies of a few texts have does not count.
LEAST_SHARE = 0.01
_EDGES = re.compile(r"^\W+|\W+$")


def word_features(word: str) -> tuple[int, ...]:
    """Feature numbers of a word as it stands between blanks."""
    plain = _EDGES.sub("", word.lower())
    if not plain:
        return ()
    names = [f"w {plain}"] + [f"{n} {plain[:n]}" for n in (4, 5) if len(plain) > n]
    return tuple({zlib.crc32(n.encode()) & ((1 << HASH_BITS) - 1) for n in names})


def text_features(text: str) -> Counter:
    found: Counter = Counter()
    for word, n in Counter(text.split()).items():
        for feature in word_features(word):
            found[feature] += n
    return found


@dataclass
class Model:
    """Weights of the features that have one, and the ascending thresholds between grades."""

    weights: dict[int, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = (40.0,) * (GRADES - 1)

    def above(self, score: float) -> list[float]:
        """The probabilities of more than grade 0, 1, ..."""
        return [1.0 / (1.0 + math.exp(min(max(t - score, -700.0), 700.0))) for t in self.thresholds]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on a bounded sample; only counts of features that tell toxic documents apart reach the driver."""
    sample = labelled_sample(docs, labels, label, sample_rows)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_features(t or "") for t in batch.column("text").to_pylist()]
            features = pa.array([list(f) for f in found], pa.list_(pa.int32()))
            counts = pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), features, counts], ["label", "features", "counts"])

    rows = write_table(sample.mapInArrow(extract, "label int, features array<int>, counts array<int>"), "toxicity-sample")
    toxic = F.col("label") > 0
    size = rows.agg(F.count_if(toxic).alias("toxic"), F.count_if(~toxic).alias("clean")).first()
    if not size["toxic"]:
        return Model()
    by_feature = rows.select(toxic.alias("bad"), F.explode("features").alias("feature")).groupBy("feature")
    counted = by_feature.agg(F.count_if("bad").alias("seen"), F.count_if(~F.col("bad")).alias("clean"))
    telling = counted.where(_telling(F.col("seen"), F.col("clean"), size["toxic"], size["clean"]))
    used = np.sort(telling.select("feature").toArrow().column(0).to_numpy())

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("features").to_pylist(), batch.column("counts").to_pylist())
            kept = [[(a, b) for a, b, k in zip(f, n, np.isin(f, used)) if k] for f, n in pairs]
            columns = [pa.array([[p[i] for p in k] for k in kept], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), *columns], ["label", "features", "counts"])

    # ordered, so that sums of floats come out the same each time
    found = rows.mapInArrow(select, rows.schema).toArrow().to_pylist()
    found.sort(key=lambda r: (r["label"], r["features"], r["counts"]))
    features, counts = ([np.array(r[c], np.int32) for r in found] for c in ("features", "counts"))
    return fit_rows(features, counts, np.array([r["label"] > 0 for r in found]))


def _telling(seen, clean, n_toxic: int, n_clean: int):
    """Whether a feature that so many toxic and clean documents have is worth a weight."""
    enough = seen >= max(LEAST_DOCUMENTS, LEAST_SHARE * n_toxic)
    return enough & ((seen + 0.5) / (n_toxic + 1) >= LEAST_RATIO * (clean + 0.5) / (n_clean + 1))


def grades(doc: np.ndarray, feature: np.ndarray, count: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Severity grades from the amount of evidence in the toxic documents."""
    size = int(feature.max(initial=0)) + 1
    clean = np.bincount(feature[~toxic[doc]], minlength=size)
    seen = np.bincount(feature[toxic[doc]], minlength=size)
    evident = (clean == 0) & (seen >= LEAST_DOCUMENTS)
    amount = np.bincount(doc, weights=count * evident[feature], minlength=len(toxic))
    limits = np.quantile(amount[toxic], [1 / 3, 2 / 3])
    return np.where(toxic, 1 + np.searchsorted(limits, amount, side="left"), 0)


def fit_rows(features: list[np.ndarray], counts: list[np.ndarray], toxic: np.ndarray) -> Model:
    """A penalised fit chooses the features, and a second fit without the penalty sets their weights."""
    doc = np.repeat(np.arange(len(features)), [len(f) for f in features])
    feature, count = np.concatenate(features).astype(np.int64), np.concatenate(counts)
    seen = np.bincount(feature[toxic[doc]], minlength=int(feature.max(initial=0)) + 1)
    clean = np.bincount(feature[~toxic[doc]], minlength=len(seen))
    used = np.flatnonzero(_telling(seen, clean, int(toxic.sum()), int((~toxic).sum())))
    if not len(used):
        return Model()
    keep = np.isin(feature, used)
    doc, column, count = doc[keep], np.searchsorted(used, feature[keep]), count[keep]
    grade = grades(doc, column, count, toxic)
    weights, _ = _descend(doc, column, count, grade, len(used), PENALTY)
    chosen = np.flatnonzero(weights > 0)
    keep = np.isin(column, chosen)
    used, doc, column, count = used[chosen], doc[keep], np.searchsorted(chosen, column[keep]), count[keep]
    weights, gaps = _descend(doc, column, count, grade, len(used), PENALTY / 100, steps=3000)
    return Model({int(f): float(w) for f, w in zip(used, weights) if w}, tuple(map(float, gaps)))


def _descend(doc, column, count, grade, n_columns: int, penalty: float, steps: int = 600) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds, by proximal gradient steps with momentum on the mean log-likelihood."""
    value = np.log2(1.0 + count)
    n, toxic = len(grade), grade > 0
    # toxic documents weigh as much as clean ones, so that few labels are enough
    weight = np.where(toxic, 0.5 / toxic.sum(), 0.5 / max((~toxic).sum(), 1))
    share = np.clip([np.sum(weight[grade <= k]) for k in range(GRADES - 1)], 1e-6, 1 - 1e-6)
    gaps = np.log(share / (1 - share))
    w, ahead, momentum = np.zeros(n_columns), np.zeros(n_columns), 1.0
    rate = 1.0 / max(1.0, 0.25 * float(np.bincount(doc, value**2, n) @ weight))
    at = np.arange(n)
    for _ in range(steps):
        score = np.bincount(doc, weights=value * ahead[column], minlength=n)
        below = 1.0 / (1.0 + np.exp(-np.clip(gaps[None, :] - score[:, None], -30, 30)))
        cumulated = np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], axis=1)
        slope = cumulated * (1 - cumulated)
        p = np.maximum(cumulated[at, grade + 1] - cumulated[at, grade], 1e-12)
        upper, lower = slope[at, grade + 1] / p, slope[at, grade] / p
        by_score = weight * (upper - lower)  # slope of the negative log-likelihood
        new = ahead - rate * np.bincount(column, weights=value * by_score[doc], minlength=n_columns)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0.0)
        after = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead, w, momentum = new + (momentum - 1) / after * (new - w), new, after
        for k in range(GRADES - 1):
            gaps[k] += rate * ((weight * upper)[grade == k].sum() - (weight * lower)[grade == k + 1].sum())
        gaps = np.maximum.accumulate(gaps)
    return w, gaps


def score(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The documents with ``tox_severity`` (0 to 3), ``tox_probability`` and ``tox_rejected``."""
    names = ["tox_severity", "tox_probability", "tox_rejected"]
    docs = docs.drop(*names)
    kinds = [DoubleType(), DoubleType(), BooleanType()]
    schema = StructType([*docs.schema.fields, *(StructField(n, k) for n, k in zip(names, kinds))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            severities, chances = [], []
            for text in batch.column(text_col):
                above = model.above(_text_score(text.as_py() or "", model, known))
                severities.append(sum(above))
                chances.append(above[0])
            added = [pa.array(severities, pa.float64()), pa.array(chances, pa.float64()), pa.array([c >= limit for c in chances], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *names])

    return docs.withColumn(text_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def _text_score(text: str, model: Model, known: dict[str, tuple[int, ...]], most: int = 1 << 18) -> float:
    """``w . x``; ``known`` keeps the weighted features of words that were seen."""
    found: Counter = Counter()
    for word, n in Counter(text.split()).items():
        features = known.get(word)
        if features is None:
            if len(known) >= most:
                known.clear()
            features = known[word] = tuple(f for f in word_features(word) if f in model.weights)
        for feature in features:
            found[feature] += n
    return sum(model.weights[f] * math.log2(1 + n) for f, n in sorted(found.items()))
