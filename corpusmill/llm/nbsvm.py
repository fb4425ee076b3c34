"""Quality classifier: naive Bayes log-count ratios as feature scales of a linear SVM.

Features are indicators of word n-grams (one and two words) and of word-shape n-grams (one to
three), hashed into ``2 ** BITS`` places. Each indicator is scaled by the log ratio of its
smoothed counts in the two classes; rows are brought to length one; a hinge-loss model without
kernel is fitted by dual coordinate descent. Margins become probabilities by a logistic curve
fitted on rows the descent did not see.

The model is fitted on at most ``max_rows`` labelled rows, those of smallest id hash; all rows
are scored, whole.

Defined cases: a null text is empty; an empty text has no features and gets the score of the
intercept; rows with a null label are not learned from; repeated rows are scored each; with one
class only, every score is that class's smoothed share; extra columns are kept by
:func:`scored` unless they are called ``score``, which is replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.common import byte_texts, slices
from corpusmill.llm.token_ids import release_encoders

BITS = 18
MAX_TRAIN_ROWS = 8_000
WORD_MEMO = 300_000

_CLASSES = bytes(
    ord("a") if chr(c).islower() or c >= 128 else ord("A") if chr(c).isupper() else ord("0") if chr(c).isdigit() else c
    for c in range(256)
)
_RUNS = re.compile(rb"(.)\1+", re.S)


class _Words(dict):
    """Word to its own hash (upper half) and its shape's hash (lower half)."""

    def __missing__(self, word: bytes) -> int:
        shape = _RUNS.sub(rb"\1", word.translate(_CLASSES))[:32]
        value = zlib.crc32(word.lower()) << 32 | zlib.crc32(shape)
        if len(self) >= WORD_MEMO:
            self.clear()
        self[word] = value
        return value


def _mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    keys = (keys + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    keys ^= keys >> np.uint64(29)
    keys *= np.uint64(0xBF58476D1CE4E5B9)
    return (keys >> np.uint64(64 - BITS)).astype(np.int32)


def features(text: bytes, memo: _Words) -> np.ndarray:
    """Sorted places of the indicators present in a text."""
    words = text.split()
    n = len(words)
    if not n:
        return np.empty(0, np.int32)
    both = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
    word, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    # A word equal to the one before it has a shape of its own.
    shape[1:][both[1:] == both[:-1]] = 1
    step = np.uint64(0x100000001B3)
    two = shape[:-1] * step + shape[1:]
    found = [
        _mixed(word, 1),
        _mixed(word[:-1] * step + word[1:], 2),
        _mixed(shape, 3),
        _mixed(two, 4),
        _mixed(two[:-1] * step + shape[2:], 5),
    ]
    return np.unique(np.concatenate(found))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = _Words()
    for batch in slices(batches, 1000):
        rows = [features(t, memo) for t in byte_texts(batch)]
        yield pa.record_batch(
            [batch.column("label"), pa.array(rows, pa.list_(pa.int32()))], ["label", "places"]
        )


@dataclass(frozen=True)
class NbSvm:
    """``weights`` per place, already scaled; the score is the logistic of slope and shift."""

    weights: np.ndarray
    intercept: float
    slope: float
    shift: float

    def margin(self, places: np.ndarray) -> float:
        if not len(places):
            return self.intercept
        picked = self.weights[places]
        return float(picked.sum()) / float(np.sqrt(len(places))) + self.intercept

    def score(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50))))


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    counts = np.full((2, 1 << BITS), alpha)
    for places, label in zip(rows, labels):
        counts[label, places] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_coordinate_descent(
    rows: list[np.ndarray],
    values: list[np.ndarray],
    signs: np.ndarray,
    cost: float = 1.0,
    rounds: int = 15,
    seed: int = 7,
) -> tuple[np.ndarray, float]:
    """Weights and intercept of the hinge-loss model; one dual variable changes at a time."""
    weights, intercept = np.zeros(1 << BITS), 0.0
    duals = np.zeros(len(rows))
    squares = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            places, x, y = rows[i], values[i], signs[i]
            slack = y * (weights[places] @ x + intercept) - 1
            fresh = min(max(duals[i] - slack / squares[i], 0.0), cost)
            change = (fresh - duals[i]) * y
            if change:
                duals[i] = fresh
                weights[places] += change * x
                intercept += change
                moved = max(moved, abs(change))
        if moved < 1e-3:
            break
    return weights, intercept


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps on smoothed targets."""
    ones = labels.sum()
    goal = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -50, 50)))
        spread = np.maximum(p * (1 - p), 1e-9)
        grad = np.array([((p - goal) * margins).sum(), (p - goal).sum()])
        curve = np.array(
            [
                [(spread * margins**2).sum() + 1e-6, (spread * margins).sum()],
                [(spread * margins).sum(), spread.sum() + 1e-6],
            ]
        )
        step = np.linalg.solve(curve, grad)
        slope, shift = slope - step[0], shift - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(slope), float(shift)


def fit_rows(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0) -> NbSvm:
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(set(labels.tolist())) < 2:
        return NbSvm(np.zeros(1 << BITS, np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    ratio = log_count_ratio(rows, labels)
    values = [ratio[r] / np.sqrt(max(len(r), 1)) for r in rows]
    place = np.arange(len(rows))
    held = (place % 5 == 4) if len(rows) >= 50 else np.zeros(len(rows), bool)
    learn = [i for i in place if not held[i]]
    signs = np.where(labels == 1, 1.0, -1.0)
    weights, intercept = dual_coordinate_descent(
        [rows[i] for i in learn], [values[i] for i in learn], signs[learn], cost
    )
    model = NbSvm((weights * ratio).astype(np.float32), intercept, 1.0, 0.0)
    judged = place[held] if held.any() and len(set(labels[held].tolist())) == 2 else place
    margins = np.array([model.margin(rows[i]) for i in judged])
    slope, shift = logistic_curve(margins, labels[judged])
    return NbSvm(model.weights, intercept, slope, shift)


def fit(docs: DataFrame, labels: DataFrame, label: str, max_rows: int = MAX_TRAIN_ROWS) -> NbSvm:
    """Fit on labelled documents; ``labels`` has ``doc_id`` and the 0/1 column ``label``."""
    chosen = (
        labels.filter(F.col(label).isin(0, 1))
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "label")
        .limit(max_rows)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").drop("doc_id")
    found = texts.mapInArrow(_feature_rows, "label int, places array<int>").limit(max_rows).toArrow()
    truth = found.column("label").to_numpy().astype(np.int64)
    rows = [np.asarray(p.values) for p in found.column("places")]
    # Tasks may come in any order; the fit must not follow it.
    order = sorted(range(len(rows)), key=lambda i: (zlib.crc32(rows[i].tobytes()), truth[i]))
    return fit_rows([rows[i] for i in order], truth[order])


def scored(docs: DataFrame, model: NbSvm) -> DataFrame:
    """Add ``score``, the probability of label 1."""
    docs = docs.drop("score")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        memo = _Words()
        for batch in slices(batches, 1000):
            found = [model.score(model.margin(features(t, memo))) for t in byte_texts(batch)]
            yield pa.record_batch([*batch.columns, pa.array(found, pa.float64())], names)

    return docs.mapInArrow(run, schema)


def quality_model(
    docs: DataFrame, labels: DataFrame, learn_from: Callable[[DataFrame], DataFrame] | None = None
) -> NbSvm:
    """The model of ``labels.quality``; ``learn_from`` may narrow the labels."""
    return fit(docs, learn_from(labels) if learn_from else labels, "quality")
