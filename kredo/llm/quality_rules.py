"""Quality rules: hashed n-gram logistic regression, calibrated, scored in Arrow batches.

The model is trained in numpy on at most ``sample`` labelled rows (a documented bound; features
are made on the executors).  Two thirds of them fit the weights, the rest fit a calibration of
the margin (Platt).  Every whole text is then scored.  A document is kept if it passes the base
rules and its calibrated probability reaches the fixed threshold.

Defined results: a null or empty text has no words and fails the base rules; without labels of
both classes the probability is the share of good labels (1 without labels), so only the base
rules decide; repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kredo.llm import ngrams
from kredo.llm.common import arrow_rows, id_and_text

#: Labelled rows that are used at most.
SAMPLE = 2400
#: Calibrated probability of good quality from which a document is kept.
THRESHOLD = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, probability double, kept boolean")
_ARROW = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    ("base_failed", pa.bool_()), ("probability", pa.float64()), ("kept", pa.bool_())])


@dataclass
class Model:
    """Probability = sigmoid(slope * (features . weights + bias) + shift)."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, text: str) -> float:
        margin = ngrams.linear(text, self.weights) + self.bias
        return float(ngrams.sigmoid(self.slope * margin + self.shift))


def fit_logistic(x: ngrams.Matrix, y: np.ndarray, steps: int = 150, rate: float = 0.05,
                 decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights (for unscaled features) and bias."""
    scale = x.scales()
    w, b, adam = np.zeros(ngrams.DIMENSIONS), 0.0, ngrams.Adam(ngrams.DIMENSIONS + 1, rate)
    for _ in range(steps):
        r = (ngrams.sigmoid(x.dot(w * scale) + b) - y) / x.n
        g = np.append(x.back(r) * scale + decay * w, r.sum())
        step = adam.step(np.append(w, b), g)
        w, b = step[:-1], step[-1]
    return w * scale, float(b)


def calibrate(margin: np.ndarray, y: np.ndarray, steps: int = 300) -> tuple[float, float]:
    """Platt scaling with smoothed targets, by Newton steps."""
    pos, neg = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a = np.array([1.0, 0.0])
    z = np.stack([margin, np.ones_like(margin)])
    for _ in range(steps):
        p = ngrams.sigmoid(a @ z)
        g = z @ (p - t) + np.array([1e-3 * (a[0] - 1), 0])
        h = (z * (p * (1 - p))) @ z.T + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(h, g)
        a = a - step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a[0], 1e-3)), float(a[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """docs: doc_id, text.  labels: doc_id, target (1 good, 0 bad)."""
    rows, y = ngrams.collected_rows(ngrams.labelled_sample(docs, labels, sample))
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 1) if len(y) else 1.0
        return Model(np.zeros(ngrams.DIMENSIONS), 0.0, 1.0, float(np.log(share / max(1 - share, 1e-9))))
    order = np.random.default_rng(8).permutation(len(y))
    third = len(y) // 3
    held, used = np.sort(order[:third]), np.sort(order[third:])
    w, b = fit_logistic(ngrams.Matrix.of_rows(rows, used), y[used])
    slope, shift = calibrate(ngrams.Matrix.of_rows(rows, held).dot(w) + b, y[held])
    return Model(w, b, slope, shift)


def duplicate_lines(text: str) -> int:
    lines = [s for s in text.split("\n") if s.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def judge(text: str | None, model: Model, threshold: float) -> tuple:
    """n_words to kept, in schema order."""
    text = text or ""
    words = ngrams.words_of(text)
    n, repeats = int(words.hashes.size), ngrams.repeated_words(words.hashes, REPEAT_WINDOW)
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    p = model.probability(text)
    return n, words.word_chars, words.n_symbols, duplicate_lines(text), repeats, failed, p, not failed and p >= threshold


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """The base counts, the calibrated probability and the verdict of every document."""
    def run(batches):
        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    yield (doc_id, *judge(text.as_py(), model, threshold))
        yield from arrow_rows(rows(), _ARROW)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; nothing is shuffled."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array([judge(t.as_py(), model, threshold)[-1] for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def quality_labels(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("target"))
