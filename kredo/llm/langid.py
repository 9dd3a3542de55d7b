"""Language identification by a byte convolutional network, trained in numpy.

Bytes are folded into classes (letters without case, white space, digits, other ASCII; bytes from
128 up stay apart) and embedded.  Filters of several widths run over fixed-length windows, the
maximum over the window feeds a softmax.  A text's language is the one with the largest mean log
probability over all its windows, each weighted by its bytes; the score is that mean's softmax.

For scoring, the filters are folded into two tables of byte pairs, so a window costs two row
look-ups a byte whatever the number of widths.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text
when there are no labelled rows; repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kredo.llm import ngrams
from kredo.llm.common import arrow_rows, fold, id_and_text

#: Labelled documents used at most, and windows taken from each.
SAMPLE, WINDOWS_PER_DOC = 2400, 3
WINDOW = 256
WIDTHS, FILTERS, EMBED = (2, 3, 4), 8, 8
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
#: Windows that are scored together.
TOGETHER = 2048

_LETTER = re.compile(r"[A-Za-z]")


def byte_classes() -> np.ndarray:
    """Class of each byte; 0 is padding."""
    out = np.full(256, 1, np.int32)
    out[[9, 10, 11, 12, 13, 32]] = 2
    out[48:58] = 3
    for k in range(26):
        out[65 + k] = out[97 + k] = 4 + k
    out[128:] = 30 + np.arange(128)
    return out


_CLASSES = byte_classes()
N_CLASSES = 158


def windows_of(text: str) -> np.ndarray:
    """All bytes of a text as class windows, the last one padded."""
    data = _CLASSES[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    out = np.zeros((-(-max(1, data.size) // WINDOW), WINDOW), np.int32)
    out.reshape(-1)[:data.size] = data
    return out


def has_letter(text: str) -> bool:
    return bool(_LETTER.search(text)) or any(map(str.isalpha, text))


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray                 # classes x EMBED
    filters: dict[int, np.ndarray]    # width -> (width, EMBED, FILTERS)
    offset: np.ndarray                # one per filter, all widths
    out: np.ndarray                   # filters x languages
    bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Response at i = first[pair at i] + second[pair at i + 2]; a narrow filter has zeros there."""
        parts = np.zeros((max(WIDTHS), N_CLASSES, len(WIDTHS) * FILTERS), np.float32)
        for k, w in enumerate(WIDTHS):
            for o in range(w):
                parts[o, :, k * FILTERS:(k + 1) * FILTERS] = self.embed @ self.filters[w][o]
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(-1, a.shape[1])
        return pair(parts[0], parts[1]), pair(parts[2], parts[3])

    def log_probabilities(self, windows: np.ndarray, tables) -> np.ndarray:
        first, second = tables
        padded = np.concatenate((windows, np.zeros((len(windows), max(WIDTHS) - 1), np.int32)), axis=1).T
        pairs = padded[:-1] * N_CLASSES + padded[1:]
        best = np.full((len(windows), first.shape[1]), -np.inf, np.float32)
        for i in range(WINDOW):
            np.maximum(best, first[pairs[i]] + second[pairs[i + 2]], out=best)
        return log_softmax(np.maximum(best + self.offset, 0) @ self.out + self.bias)


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def train(windows: np.ndarray, target: np.ndarray, languages: list[str], epochs: int = 8, batch: int = 64,
          rate: float = 0.01, seed: int = 10) -> Network:
    """Adam on the cross entropy; gradients flow through the positions that gave each maximum."""
    rng = np.random.default_rng(seed)
    net = Network(languages, rng.normal(0, 0.5, (N_CLASSES, EMBED)),
                  {w: rng.normal(0, 0.3, (w, EMBED, FILTERS)) for w in WIDTHS},
                  np.zeros(len(WIDTHS) * FILTERS), rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(languages))),
                  np.zeros(len(languages)))
    net.embed[0] = 0
    params = [net.embed, *net.filters.values(), net.offset, net.out, net.bias]
    adams = [ngrams.Adam(p.size, rate) for p in params]
    n_positions = WINDOW
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            rows = np.sort(order[at:at + batch])
            idx = np.concatenate((windows[rows], np.zeros((len(rows), max(WIDTHS) - 1), np.int32)), axis=1)
            x = net.embed[idx]
            peaks, places = [], []
            for w in WIDTHS:
                z = sum(x[:, o:o + n_positions] @ net.filters[w][o] for o in range(w))
                place = z.argmax(axis=1)
                places.append(place)
                peaks.append(np.take_along_axis(z, place[:, None, :], 1)[:, 0])
            pooled = np.concatenate(peaks, axis=1) + net.offset
            active = np.maximum(pooled, 0)
            p = np.exp(log_softmax(active @ net.out + net.bias))
            p[np.arange(len(rows)), target[rows]] -= 1
            p /= len(rows)
            g_pool = (p @ net.out.T) * (pooled > 0)
            g_embed = np.zeros_like(net.embed)
            g_filters = []
            each = np.arange(len(rows))[:, None]
            for k, w in enumerate(WIDTHS):
                g, g_f = g_pool[:, k * FILTERS:(k + 1) * FILTERS], np.zeros_like(net.filters[w])
                for o in range(w):
                    cell = idx[each, places[k] + o]                                   # rows x filters
                    g_f[o] = np.einsum("rfe,rf->ef", net.embed[cell], g)
                    np.add.at(g_embed, cell, g[:, :, None] * net.filters[w][o].T[None])
                g_filters.append(g_f)
            g_embed[0] = 0
            grads = [g_embed, *g_filters, g_pool.sum(axis=0), active.T @ p, p.sum(axis=0)]
            for q, g, a in zip(params, grads, adams):
                q[...] = a.step(q.reshape(-1), g.reshape(-1)).reshape(q.shape)
    return net


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Network | None:
    """Train on windows of at most ``sample`` labelled documents outside the held-out fold.

    The windows (evenly spaced, at most WINDOWS_PER_DOC a document) are cut on the executors.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where((fold("doc_id", FOLDS) != HELD_OUT) & F.col("lang").isNotNull())
    ids = rows.select("doc_id", F.lit(1).alias("target"))
    chosen = ids.where(F.col("doc_id").isNotNull()).dropDuplicates().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    picked = rows.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id", "text"), "doc_id").limit(sample)
    schema = pa.schema([("lang", pa.string()), ("window", pa.binary())])

    def run(batches):
        def out():
            for batch in batches:
                for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if not text or not has_letter(text):
                        continue
                    w = windows_of(text)
                    for k in sorted({(len(w) - 1) * j // max(1, WINDOWS_PER_DOC - 1) for j in range(WINDOWS_PER_DOC)}):
                        yield lang, w[k].astype("<u1").tobytes()
        yield from arrow_rows(out(), schema)

    got = picked.select("text", "lang").mapInArrow(run, "lang string, window binary").toPandas()
    if not len(got):
        return None
    got = got.sort_values(["lang", "window"], kind="stable")
    languages = sorted(set(got["lang"]))
    windows = np.stack([np.frombuffer(w, np.uint8) for w in got["window"]]).astype(np.int32)
    return train(windows, np.searchsorted(languages, got["lang"].to_numpy(str)), languages)


def predict(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's language and score."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                        ("score", pa.float64())])

    def run(batches):
        tables = net.tables() if net else None

        def settle(waiting, windows):
            """One row per waiting document; windows: (document, windows, bytes in the last one)."""
            total = np.zeros((len(waiting), len(net.languages) if net else 1))
            weight = np.zeros(len(waiting))
            if windows:
                all_windows = np.concatenate([w for _, w in windows])
                owner = np.repeat([d for d, _ in windows], [len(w) for _, w in windows])
                for at in range(0, len(all_windows), TOGETHER):
                    part = all_windows[at:at + TOGETHER]
                    filled = np.count_nonzero(part, axis=1).astype(float)
                    np.add.at(total, owner[at:at + TOGETHER], net.log_probabilities(part, tables) * filled[:, None])
                    np.add.at(weight, owner[at:at + TOGETHER], filled)
            for (doc_id, held), t, n in zip(waiting, total, weight):
                if not n:
                    yield doc_id, held, UNKNOWN, 0.0
                    continue
                p = np.exp(log_softmax(t[None] / n))[0]
                yield doc_id, held, net.languages[int(p.argmax())], float(p.max())

        def rows():
            waiting, windows, n = [], [], 0
            for batch in batches:
                for doc_id, text, held in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                    text = text.as_py()
                    if net and text and has_letter(text):
                        w = windows_of(text)
                        windows.append((len(waiting), w))
                        n += len(w)
                    waiting.append((doc_id, held))
                    if n >= TOGETHER or len(waiting) >= TOGETHER:
                        yield from settle(waiting, windows)
                        waiting, windows, n = [], [], 0
            yield from settle(waiting, windows)

        yield from arrow_rows(rows(), schema)

    rows = id_and_text(docs, id_col, text_col).withColumn("held_out", fold("doc_id", FOLDS) == HELD_OUT)
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
