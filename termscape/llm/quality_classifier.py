"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One vector of hashed-text weights is shared by all grades; ordered thresholds cut its score:
``P(grade <= k) = logistic(threshold_k - score)``. A document gets its expected grade and the probability of
the best grade, by which it is selected.

Features: lower-cased words without punctuation around them, their first four letters, word shapes
(``Aa``, ``AA!``, ``a&``), and the level of repetition, all hashed to ``2 ** HASH_BITS`` weights; values are
logarithms of 1 + the count, scaled to length 1. Words are parted at white space.

The model is fitted on at most ``MAX_TRAINING`` labelled rows, those whose ids hash lowest; only their
features reach the driver. Scoring reads each document once, without a shuffle.

Defined cases: null is empty; a text without words scores on the intercept alone; labels without a
document, documents without a label, null grades and repeated labels do no harm (a document
with several labels counts once with its lowest grade). Where all labels have one grade, every document
is expected to have it, as the best there is; without any usable label the results are null. An empty table gives no rows.
Texts go through whole, whatever their length, one at a time; a training text sends at most three buckets per distinct
word to the driver. Repeated rows are scored each. Columns other than id and text are ignored.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscape.llm.common import bounded_batches

HASH_BITS = 18
MAX_TRAINING = 8192
#: A bucket gets a weight if so many training documents have it.
MIN_DOCS = 5
#: A document is kept if its probability of the best grade is at least this.
MIN_TAIL = 0.5
STEPS = 600
RATE = 0.02
PENALTY = 1e-3

_RUN = re.compile(r"(.)\1+")
_MAX_CACHE = 200_000


def shape(word: str) -> str:
    """Kinds of characters of a word, runs as one: A upper, a lower, 0 digit, others as they are."""
    if word.isalpha():
        if word.islower():
            return "a"
        if word[0].isupper() and word[1:].islower():
            return "Aa"
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word[:32])
    return _RUN.sub(r"\1", kinds)[:8]


class _Buckets(dict):
    """Bucket of a value, remembered; ``kind`` keeps kinds of values apart."""

    def __init__(self, kind: int):
        super().__init__()
        self._kind = kind

    def __missing__(self, value: str) -> int:
        found = xxhash.xxh64_intdigest(value.encode(), seed=self._kind) >> (64 - HASH_BITS)
        if len(self) < _MAX_CACHE:
            self[value] = found
        return found


class Hasher(dict):
    """The three buckets of a word, packed into one number and remembered up to a bound."""

    def __init__(self) -> None:
        super().__init__()
        self._word, self._start, self._shape, self._repeat = (_Buckets(kind) for kind in range(1, 5))

    def __missing__(self, word: str) -> int:
        core = word.lower().strip(string.punctuation)
        kinds = self._word.__missing__(core), self._start[core[:4]], self._shape[shape(word)]
        found = kinds[0] << 2 * HASH_BITS | kinds[1] << HASH_BITS | kinds[2]
        if len(self) >= _MAX_CACHE:
            self.clear()
        self[word] = found
        return found

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and values of a text."""
        counts = Counter((text or "").split())
        if not counts:
            return np.zeros(0, np.int32), np.zeros(0, np.float32)
        times = np.fromiter(counts.values(), np.int64, len(counts))
        packed = np.fromiter(map(self.__getitem__, counts), np.int64, len(counts))
        mask = (1 << HASH_BITS) - 1
        level = self._repeat[str(int(2 * math.log2(times.sum() / len(times))))]
        places = np.concatenate([packed >> 2 * HASH_BITS, packed >> HASH_BITS & mask, packed & mask, [level]])
        buckets, inverse = np.unique(places, return_inverse=True)
        held = np.log1p(np.bincount(inverse, weights=np.concatenate([times, times, times, [times.sum()]])))
        return buckets.astype(np.int32), (held / np.linalg.norm(held)).astype(np.float32)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k, one row per score."""
        return _logistic(np.asarray(scores)[:, None] - self.thresholds[None, :])


def fit_ordinal(index: np.ndarray, value: np.ndarray, sizes: np.ndarray, grades: np.ndarray, steps: int = STEPS) -> OrdinalModel:
    """Maximum likelihood by Adam over the whole sample in each step; thresholds stay ordered by construction.

    ``index`` and ``value`` hold the features of all rows, ``sizes`` of them for each.
    """
    n_grades, n_rows = int(grades.max()) + 1, len(sizes)
    value = value.astype(np.float64)
    owner = np.repeat(np.arange(n_rows, dtype=np.int32), sizes)
    used, column, seen = np.unique(index, return_inverse=True, return_counts=True)
    known = (seen >= MIN_DOCS)[column]  # what one document alone has would only be learnt by heart
    value, owner, column = value[known], owner[known], column[known]
    weights = np.zeros(len(used))
    base = np.zeros(n_grades - 1)  # first threshold, then logarithms of the gaps
    shares = np.cumsum(np.bincount(grades, minlength=n_grades) / len(grades))[:-1]
    cuts = np.log(np.clip(shares, 1e-3, 1 - 1e-3) / (1 - np.clip(shares, 1e-3, 1 - 1e-3)))
    base[0] = cuts[0]
    base[1:] = np.log(np.maximum(np.diff(cuts), 1e-2))
    state = [np.zeros(len(weights)), np.zeros(len(weights)), np.zeros(len(base)), np.zeros(len(base))]
    for step in range(1, steps + 1):
        thresholds = np.concatenate([base[:1], base[0] + np.cumsum(np.exp(base[1:]))])
        score = np.bincount(owner, weights=value * weights[column], minlength=n_rows)
        below = np.concatenate([np.zeros((n_rows, 1)), _logistic(thresholds[None, :] - score[:, None]), np.ones((n_rows, 1))], axis=1)
        each = np.arange(n_rows)
        high, low = below[each, grades + 1], below[each, grades]
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        d_score = (d_high - d_low) / n_rows  # of the negative log likelihood
        d_cut = np.zeros(len(thresholds))
        np.add.at(d_cut, grades[grades < n_grades - 1], -d_high[grades < n_grades - 1] / n_rows)
        np.add.at(d_cut, grades[grades > 0] - 1, d_low[grades > 0] / n_rows)
        d_base = np.array([d_cut.sum(), *[d_cut[k:].sum() * np.exp(base[k]) for k in range(1, len(base))]])
        d_weights = np.bincount(column, weights=value * d_score[owner], minlength=len(weights)) + PENALTY * weights
        for i, (parameter, slope) in enumerate(((weights, d_weights), (base, d_base))):
            mean, square = state[2 * i], state[2 * i + 1]
            mean += 0.1 * (slope - mean)
            square += 0.001 * (slope * slope - square)
            parameter -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-10)
    thresholds = np.concatenate([base[:1], base[0] + np.cumsum(np.exp(base[1:]))])
    full = np.zeros(1 << HASH_BITS)
    full[used] = weights
    return OrdinalModel(full, thresholds)


def _featurised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in batches:
        found = [hasher.features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("grade"), pa.array([b for b, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.list_(pa.float32()))],
            names=["grade", "buckets", "values"],
        )


def training_rows(docs: DataFrame, grades: DataFrame, max_rows: int = MAX_TRAINING) -> DataFrame:
    """Text and grade of at most ``max_rows`` labelled documents, chosen by a hash of the id.

    Of several texts or grades of one id the least counts, so that the data alone fix the sample.
    """
    chosen = grades.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("grade").alias("grade"))


def fit(docs: DataFrame, grades: DataFrame, max_rows: int = MAX_TRAINING) -> OrdinalModel:
    """Fit on ``docs(doc_id, text)`` and ``grades(doc_id, grade)``, grades counted from 0.

    One grade alone gives thresholds that every score exceeds; no label gives a threshold that is no number.
    """
    bounded_batches(docs.sparkSession)
    rows = training_rows(docs, grades, max_rows).select(F.col("grade").cast("int"), "text")
    found = rows.mapInArrow(_featurised, "grade int, buckets array<int>, values array<float>").toArrow()
    labels = np.array(found.column("grade").to_pylist(), np.int64)
    if len(set(labels.tolist())) < 2:  # nothing to tell apart
        return OrdinalModel(np.zeros(1 << HASH_BITS), np.full(labels[0], -np.inf) if len(labels) else np.array([np.nan]))
    buckets, values = (found.column(c).combine_chunks() for c in ("buckets", "values"))
    sizes = buckets.value_lengths().to_numpy(zero_copy_only=False)
    return fit_ordinal(buckets.flatten().to_numpy(), values.flatten().to_numpy(), sizes, labels)


def score(docs: DataFrame, model: OrdinalModel, min_tail: float = MIN_TAIL) -> DataFrame:
    """doc_id, expected_grade, p_best (probability of the best grade), kept."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** HASH_BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, hasher = shared.value, Hasher()
        for batch in batches:
            scores = []
            for text in batch.column("text").to_pylist():
                buckets, values = hasher.features(text)
                scores.append(float(own.weights[buckets] @ values))
            above = own.above(np.array(scores, np.float64))
            best = above[:, -1] if above.shape[1] else np.ones(len(above))
            unknown = np.isnan(best)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(above.sum(axis=1), mask=unknown), pa.array(best, mask=unknown), pa.array(best >= min_tail, mask=unknown)],
                names=["doc_id", "expected_grade", "p_best", "kept"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, expected_grade double, p_best double, kept boolean")


def grades_of(labels: DataFrame) -> DataFrame:
    """0: poor; 1: sound but toxic; 2: good. A missing toxic mark counts as none."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) > 0
    grade = F.when(F.col("quality") <= 0, 0).when(F.col("quality") > 0, F.when(toxic, 1).otherwise(2))
    return labels.select("doc_id", grade.alias("grade"))
