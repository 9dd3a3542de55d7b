"""Positive-unlabelled quality classifier with the non-negative unbiased risk.

Trusted positives are rows labelled good; the other side is unlabelled web text, whose labels (if
any) are never looked at.  With class prior p the risk is

    p * E_pos[loss(+)] + max(0, E_unl[loss(-)] - p * E_pos[loss(-)])

and where the second term turns negative its gradient is reversed, which keeps the model from
fitting the positives by rote.  The prior is estimated from a positive-against-unlabelled model:
over regions where it scores high, the smallest ratio of the unlabelled share to the positive share.

Features of a whole text: square roots of the shares of adjacent character-class pairs (a class is
upper case, lower case, digit, blank, line break, one ASCII sign, or other) and word statistics
(repeated windows, adjacent equal words, distinct words, length).

Both samples are bounded (``SAMPLE`` rows each, a documented parameter); every whole text is scored.
Defined results: a null or empty text has zero features and scores by the bias; without positives or
unlabelled rows the score is 0.5; repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kredo.llm import ngrams
from kredo.llm.common import among_lowest, arrow_rows, fold, id_and_text

#: Positive rows, and unlabelled rows, that are used at most.
SAMPLE = 2000
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2


N_CLASSES = ngrams.N_CLASSES
DIMENSIONS = N_CLASSES * N_CLASSES + 4


def features(text: str) -> np.ndarray:
    pairs = np.zeros(N_CLASSES * N_CLASSES)
    last = np.zeros(0, np.int64)
    for part in ngrams.segments(text):
        kinds = np.concatenate((last, ngrams.classes_of(ngrams.codes_of(part))))
        pairs += np.bincount(kinds[:-1] * N_CLASSES + kinds[1:], minlength=pairs.size)
        last = kinds[-1:]
    h = ngrams.words_of(text).hashes
    n = max(1, h.size)
    words = [ngrams.repeated_words(h) / n, np.count_nonzero(h[1:] == h[:-1]) / n, np.unique(h).size / n,
             min(1.0, np.log1p(h.size) / 10)]
    return np.concatenate((np.sqrt(pairs / max(1, pairs.sum())), words)).astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, text: str | None) -> float:
        return float(ngrams.sigmoid(features(text or "") @ self.weights + self.bias))


def scales(x: np.ndarray) -> np.ndarray:
    return 1 / (np.sqrt((x.astype(float) ** 2).mean(axis=0)) + 1e-2)


def separate(x: np.ndarray, y: np.ndarray, steps: int = 80, rate: float = 0.05, decay: float = 0.05):
    """Plain logistic regression: weights and bias."""
    scale, w, b, adam = scales(x), np.zeros(x.shape[1]), 0.0, ngrams.Adam(x.shape[1] + 1, rate)
    for _ in range(steps):
        r = (ngrams.sigmoid(x @ (w * scale) + b) - y) / len(y)
        step = adam.step(np.append(w, b), np.append((r @ x) * scale + decay * w, r.sum()))
        w, b = step[:-1], step[-1]
    return w * scale, b


def estimate_prior(pos: np.ndarray, unl: np.ndarray, seed: int = 7) -> float:
    """Fit positives against unlabelled rows on one half of each; on the other half take the smallest
    ratio of shares above a score, over scores that at least half of the positives reach."""
    rng = np.random.default_rng(seed)
    p, u = rng.permutation(len(pos)), rng.permutation(len(unl))
    if min(len(p), len(u)) < 2:
        return 0.5
    w, b = separate(np.concatenate((pos[p[::2]], unl[u[::2]])), np.repeat([1.0, 0.0], [len(p[::2]), len(u[::2])]))
    sp, su = pos[p[1::2]] @ w + b, unl[u[1::2]] @ w + b
    ratios = [(np.mean(su >= t) + 1 / su.size) / np.mean(sp >= t) for t in np.quantile(sp, np.linspace(0, 0.5, 26))]
    return float(np.clip(min(ratios), 0.05, 0.95))


def fit_risk(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = 200, rate: float = 0.01,
             decay: float = 0.05) -> tuple[np.ndarray, float]:
    """Minimise the non-negative risk with the logistic loss."""
    scale, w, b = scales(unl), np.zeros(unl.shape[1]), 0.0
    adam = ngrams.Adam(w.size + 1, rate)
    for _ in range(steps):
        zp, zu = pos @ (w * scale) + b, unl @ (w * scale) + b
        as_good = -ngrams.sigmoid(-zp) / len(pos)              # derivative of loss(+) on the positives
        as_bad_p, as_bad_u = ngrams.sigmoid(zp) / len(pos), ngrams.sigmoid(zu) / len(unl)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp, gu = (prior * (as_good - as_bad_p), as_bad_u) if negative >= 0 else (prior * as_bad_p, -as_bad_u)
        step = adam.step(np.append(w, b), np.append((gp @ pos + gu @ unl) * scale + decay * w, gp.sum() + gu.sum()))
        w, b = step[:-1], step[-1]
    return w * scale, float(b)


def feature_rows(rows: DataFrame) -> np.ndarray:
    """Features of a bounded sample, made on the executors, in the order of id and features."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.binary())])

    def run(batches):
        yield from arrow_rows(((i, features(t or "").tobytes()) for batch in batches for i, t in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist())), schema, weigh=lambda r: len(r[1]))

    got = rows.select("doc_id", "text").mapInArrow(run, "doc_id long, row binary").toPandas()
    got = got.sort_values(["doc_id", "row"])
    return np.frombuffer(b"".join(got["row"]), np.float32).reshape(-1, DIMENSIONS)


def unlabelled_sample(docs: DataFrame, limit: int, seed: int = 42) -> DataFrame:
    """At most ``limit`` documents: those with the smallest hash of their id.

    The row count (from file footers) sets a hash below which about twice the limit falls, so only
    those ids are sorted.
    """
    n = max(1, docs.count())
    low = among_lowest(F.xxhash64("doc_id", F.lit(seed)), 2 * limit / n)
    ids = docs.where(low & F.col("doc_id").isNotNull()).select("doc_id").withColumn("target", F.lit(0))
    return ngrams.labelled_sample(docs, ids, limit)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """docs: doc_id, text (the unlabelled rows are drawn from them).  labels: doc_id, target; only target 1 is used."""
    pos = feature_rows(ngrams.labelled_sample(docs, labels.where("target = 1"), sample))
    unl = feature_rows(unlabelled_sample(docs, sample))
    if not len(pos) or not len(unl):
        return Model(np.zeros(DIMENSIONS), 0.0, 0.5)
    prior = estimate_prior(pos, unl)
    return Model(*fit_risk(pos, unl, prior), prior)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Every document's score and class."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
                        ("predicted", pa.int32())])

    def run(batches):
        def rows():
            for batch in batches:
                for doc_id, text, held in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                    s = model.score(text.as_py())
                    yield doc_id, held, s, int(s >= threshold)
        yield from arrow_rows(rows(), schema)

    rows = id_and_text(docs, id_col, text_col).withColumn("held_out", fold("doc_id", FOLDS) == HELD_OUT)
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
