"""Hashed word and character n-grams of whole texts, and sparse linear models over them, in numpy.

A text is walked in segments that end at a blank, so memory follows the longest segment and the
number of words.  Words are runs of anything but blank, tab and line breaks.  A word's hash is
multilinear over its code points with fixed 64-bit coefficients.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kredo.llm.common import arrow_rows

SEGMENT = 1 << 18
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_SYMBOLS = np.zeros(128, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finisher on unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_coefficients = np.zeros(0, np.uint64)


def coefficients(n: int) -> np.ndarray:
    """The first n fixed odd coefficients."""
    global _coefficients
    if _coefficients.size < n:
        steps = (np.arange(max(n, 256), dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        _coefficients = mix(steps) | np.uint64(1)
    return _coefficients[:n]


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """Consecutive parts of the text, each ending just after a blank (the last at the end)."""
    at, n = 0, len(text)
    while at < n:
        if n - at <= size:
            yield text[at:] if at else text
            return
        m = _BLANK.search(text, at + size)
        end = m.end() if m else n
        yield text[at:end]
        at = end


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


@dataclass
class Words:
    """hashes: one per word; word_chars: code points in words; n_symbols: of ``#*$%&|<>``."""

    hashes: np.ndarray
    word_chars: int
    n_symbols: int


def segment_words(codes: np.ndarray, word: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """Word hashes of a segment and its code points in words; ``word`` marks them (default: all but blanks)."""
    if word is None:
        word = ~((codes == 32) | (codes - np.uint32(9) <= 4))
    starts = np.flatnonzero(word & ~np.concatenate(([False], word[:-1])))
    if not starts.size:
        return np.zeros(0, np.uint64), 0
    first = starts[0]
    codes, word, starts = codes[first:], word[first:], starts - first
    place = np.arange(codes.size, dtype=np.int64) - np.repeat(starts, np.diff(np.append(starts, codes.size)))
    terms = (codes.astype(np.uint64) + np.uint64(1)) * coefficients(int(place.max()) + 1)[place]
    terms *= word
    return mix(np.add.reduceat(terms, starts)), int(np.count_nonzero(word))


def words_of(text: str) -> Words:
    hashes, chars, symbols = [], 0, 0
    for part in segments(text):
        codes = codes_of(part)
        h, n = segment_words(codes)
        hashes.append(h)
        chars += n
        symbols += int(np.count_nonzero(_SYMBOLS[codes[codes < 128]]))
    return Words(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), chars, symbols)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of n word hashes."""
    if hashes.size < n:
        return np.zeros(0, np.uint64)
    k = coefficients(n)
    out = hashes[:hashes.size - n + 1] * k[0]
    for j in range(1, n):
        out += hashes[j:hashes.size - n + 1 + j] * k[j]
    return mix(out)


def repeated_words(hashes: np.ndarray, n: int = 8) -> int:
    """Words that lie in a window of n words which occurs at least twice in the text."""
    runs = windows(hashes, n)
    if runs.size < 2:
        return 0
    order = np.argsort(runs, kind="stable")
    ordered = runs[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
    edge = np.zeros(hashes.size + 1, np.int64)
    np.add.at(edge, order[twice], 1)
    np.add.at(edge, order[twice] + n, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


# ---- character classes -----------------------------------------------------------------------

def character_classes() -> np.ndarray:
    """Class of each code point up to 127, then of Latin letters and of the rest."""
    signs = [c for c in range(33, 127) if not chr(c).isalnum()]
    out = np.full(128, 5 + len(signs))
    for c in range(128):
        ch = chr(c)
        if ch.isalnum():
            out[c] = 2 if ch.isdigit() else 0 if ch.isupper() else 1
    out[[9, 32]] = 3
    out[10:14] = 4
    out[signs] = 5 + np.arange(len(signs))
    return np.append(out, [6 + len(signs), 7 + len(signs)])


_CLASSES = character_classes()
N_CLASSES = int(_CLASSES.max()) + 1


def classes_of(codes: np.ndarray) -> np.ndarray:
    """Upper case, lower case, digit, blank, line break, one class for each ASCII sign, control, letter, other."""
    at = codes.astype(np.int64)
    return _CLASSES[np.where(at < 128, at, np.where(at < 0xC0, 129, 128))]


# ---- hashed features -------------------------------------------------------------------------

#: Buckets of the character and of the word features.
CHAR_BITS = WORD_BITS = 13
CHAR_SIZES, WORD_SIZES = (2, 3), (1, 2)
DIMENSIONS = (1 << CHAR_BITS) + (1 << WORD_BITS)
_ROLL = [np.uint32(m) for m in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


def char_buckets(codes: np.ndarray, n: int) -> np.ndarray:
    if codes.size < n:
        return np.zeros(0, np.uint32)
    out = codes[:codes.size - n + 1] * _ROLL[0]
    for j in range(1, n):
        out = (out ^ (out >> np.uint32(15))) * _ROLL[2] + codes[j:codes.size - n + 1 + j] * _ROLL[1]
    out += np.uint32(n)
    out ^= out >> np.uint32(16)
    out *= _ROLL[0]
    return out >> np.uint32(32 - CHAR_BITS)


def bucket_groups(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """(group, buckets): groups are the n-gram sizes, characters first; a group may come in parts."""
    hashes, carry = [], np.zeros(0, np.uint32)
    for part in segments(text):
        codes = codes_of(part)
        hashes.append(segment_words(codes)[0])
        for g, n in enumerate(CHAR_SIZES):
            yield g, char_buckets(np.concatenate((carry[max(0, carry.size - n + 1):], codes)), n)
        carry = codes[-(max(CHAR_SIZES) - 1):]
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    for g, n in enumerate(WORD_SIZES, len(CHAR_SIZES)):
        yield g, (windows(words, n) >> np.uint64(64 - WORD_BITS)).astype(np.uint32) + np.uint32(1 << CHAR_BITS)


GROUPS = len(CHAR_SIZES) + len(WORD_SIZES)


def sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: every group's counts as shares of the group."""
    counts = np.zeros((GROUPS, DIMENSIONS), np.float32)
    for g, b in bucket_groups(text):
        counts[g] += np.bincount(b, minlength=DIMENSIONS)
    total = counts.sum(axis=1, keepdims=True)
    row = (counts / np.maximum(total, 1)).sum(axis=0)
    at = np.flatnonzero(row)
    return at.astype(np.int32), row[at]


def linear(text: str, weights: np.ndarray) -> float:
    """The weights' product with the text's features, without building them."""
    sums, ns = np.zeros(GROUPS), np.zeros(GROUPS)
    for g, b in bucket_groups(text):
        sums[g] += weights[b].sum(dtype=np.float64)
        ns[g] += b.size
    return float((sums / np.maximum(ns, 1)).sum())


_FEATURES = pa.schema([("doc_id", pa.int64()), ("target", pa.int32()), ("at", pa.binary()), ("value", pa.binary())])


def features(rows: DataFrame) -> DataFrame:
    """rows: doc_id, text, target.  One row of sparse features each: buckets (int32) and values (float32) as bytes."""
    def run(batches):
        def out():
            for batch in batches:
                for doc_id, text, target in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    at, value = sparse(text or "")
                    yield doc_id, target, at.tobytes(), value.tobytes()
        yield from arrow_rows(out(), _FEATURES, weigh=lambda r: 2 * len(r[2]))

    return rows.select("doc_id", "text", "target").mapInArrow(
        run, "doc_id long, target int, at binary, value binary")


def collected_rows(rows: DataFrame) -> tuple[list[tuple[bytes, bytes]], np.ndarray]:
    """Features as bytes and targets of a bounded sample, in the order of id and features."""
    table = features(rows).toArrow()
    got = sorted((i is not None, i or 0, at, value, target) for i, target, at, value in zip(
        *(table.column(k).to_pylist() for k in ("doc_id", "target", "at", "value"))))
    return [r[2:4] for r in got], np.asarray([r[4] for r in got], float)


@dataclass
class Matrix:
    """Rows of sparse features, row after row."""

    at: np.ndarray
    value: np.ndarray
    starts: np.ndarray
    n: int

    @staticmethod
    def of(at: list, value: list) -> Matrix:
        sizes = np.asarray([len(a) for a in at], np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if len(parts) else np.zeros(0, kind)
        return Matrix(join(at, np.int32), join(value, np.float32), starts, len(at))

    @staticmethod
    def of_rows(rows: list[tuple[bytes, bytes]], numbers) -> Matrix:
        """The numbered rows, whose features are given as bytes."""
        return Matrix.of([np.frombuffer(rows[k][0], np.int32) for k in numbers],
                         [np.frombuffer(rows[k][1], np.float32) for k in numbers])

    def take(self, rows: np.ndarray) -> Matrix:
        return Matrix.of([self.at[self.starts[r]:self.starts[r + 1]] for r in rows],
                         [self.value[self.starts[r]:self.starts[r + 1]] for r in rows])

    def dot(self, w: np.ndarray) -> np.ndarray:
        terms = w[self.at] * self.value
        out = np.zeros(self.n)
        full = np.flatnonzero(np.diff(self.starts))
        if full.size:
            out[full] = np.add.reduceat(terms, self.starts[full])
        return out

    def back(self, r: np.ndarray) -> np.ndarray:
        """The transposed product."""
        return np.bincount(self.at, weights=self.value * np.repeat(r, np.diff(self.starts)), minlength=DIMENSIONS)

    def scales(self) -> np.ndarray:
        """One over the root mean square of every bucket (0 for unseen buckets)."""
        square = np.bincount(self.at, weights=np.square(self.value), minlength=DIMENSIONS) / max(1, self.n)
        return np.where(square > 0, 1 / (np.sqrt(square) + 1e-4), 0)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


class Adam:
    def __init__(self, n: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(n), np.zeros(n), 0, rate

    def step(self, w: np.ndarray, g: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * g
        self.v = 0.999 * self.v + 0.001 * g * g
        return w - self.rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """doc_id, text, target of at most ``limit`` labelled documents: those with the smallest hash of their id.

    labels: doc_id, target.  Both limits are top-k by hash, so the broadcast side has at most
    ``limit`` rows and repeated ids cannot enlarge the result.
    """
    chosen = (labels.where("target IS NOT NULL AND doc_id IS NOT NULL").dropDuplicates(["doc_id"])
                    .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    return (docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "target")
                .orderBy(F.xxhash64("doc_id", "text"), "doc_id").limit(limit))
