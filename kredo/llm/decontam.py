"""Benchmark decontamination: SimHash of item-sized windows, multi-index lookup, exact verification.

Texts are read as lower-cased words of letters and digits and as shingles of five words.  For every
item length a window of that many shingles slides over each whole document.  A window can reach the
similarity only if enough of its shingles occur in some item, so only such windows get a SimHash
fingerprint.  Item fingerprints are indexed by blocks of bits: with b blocks, a fingerprint within
the radius agrees in some block up to radius // b bits.  Each item is entered once a block; a window
looks up all values that near its own and so finds every item of that length within the radius.  What
is found is verified by the exact weighted
Jaccard similarity of the two shingle multisets.

The items are a stated query set.  They reach the tasks in blocks whose index has a bounded number of
bytes, one pass over the documents a block; nothing is shuffled.  A Python worker builds the index
from the block's texts and keeps the last one.  With several blocks the results of each are written
before the next is fetched, so the driver and a worker hold one block.

Defined results: texts or items without a word match nothing; an item of fewer than five words is one
shingle of all its words; a text shorter than an item is one window; repeated rows and repeated items
are matched each; empty tables give no rows; further columns are kept by ``drop_contaminated`` only.
"""

from __future__ import annotations

import functools
import math
import uuid
from collections import defaultdict
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kredo.llm import ngrams
from kredo.llm.common import arrow_rows, id_and_text, written

SHINGLE, SIMILARITY = 5, 0.8
#: Bits that the fingerprints of similar windows may differ in, and index blocks.  At the least
#: similarity equal-sized windows share 8/9 of their shingles: about 10 of 64 bits differ, 24 are
#: five standard deviations away.
RADIUS, BLOCKS = 24, 8
#: Bytes that the index of a block of items may have (``index_bytes`` bounds them before it is built).
INDEX_BYTES = 128 << 20

SCHEMA = "doc_id long, item_id long, start_word long, n_words long, distance int, similarity double"
_ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()),
                    ("n_words", pa.int64()), ("distance", pa.int32()), ("similarity", pa.float64())])


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Lower-case code point of each letter or digit of the basic plane, 0 for all else."""
    out = np.zeros(1 << 16, np.uint32)
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isalnum():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def word_hashes(text: str) -> np.ndarray:
    parts = []
    for part in ngrams.segments(text):
        codes = ngrams.codes_of(part)
        low = letters()[np.minimum(codes, 0xFFFF)]
        high = np.flatnonzero(codes > 0xFFFF)
        if high.size:
            low = low.copy()
            low[high] = [ord(chr(c).lower()[0]) if chr(c).isalnum() else 0 for c in codes[high]]
        parts.append(ngrams.segment_words(low, low > 0)[0])
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def bit_rows(hashes: np.ndarray) -> np.ndarray:
    """64 columns of bits, most significant first."""
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def fingerprint_of(ones: np.ndarray, n) -> np.ndarray:
    """Majority bits as unsigned 64-bit integers; ones: rows of 64 counts."""
    packed = np.packbits(2 * ones > np.reshape(n, (-1, 1)), axis=1)
    return np.ascontiguousarray(packed).view(">u8").reshape(-1).astype(np.uint64)


@functools.cache
def near_masks(width: int, bits: int) -> np.ndarray:
    """All values of ``width`` bits with at most ``bits`` set."""
    return np.asarray([sum(1 << b for b in c) for k in range(bits + 1) for c in combinations(range(width), k)], np.uint64)


class BlockIndex:
    """Which of some fingerprints lie within ``radius`` bits of a query.

    One array holds the fingerprints' numbers sorted by (block, value), another where each value begins: with
    the default blocks 32 bytes a fingerprint and 8 KiB in all.  The query enumerates the near values, not the index.
    """

    def __init__(self, fingerprints: np.ndarray, radius: int = RADIUS, blocks: int = BLOCKS):
        self.fingerprints, self.radius = np.asarray(fingerprints, np.uint64), radius
        width = 64 // blocks
        self.masks = near_masks(width, radius // blocks)
        self.shifts = np.arange(blocks, dtype=np.uint64) * np.uint64(width)
        self.low, self.tags = np.uint64((1 << width) - 1), np.arange(blocks, dtype=np.uint64) << np.uint64(width)
        keys = self.keys(self.fingerprints).ravel()
        self.numbers = (np.argsort(keys, kind="stable") // blocks).astype(np.int32)
        self.begins = np.zeros((blocks << width) + 1, np.int32)
        np.cumsum(np.bincount(keys.astype(np.int64), minlength=blocks << width), out=self.begins[1:])

    def keys(self, fingerprints: np.ndarray) -> np.ndarray:
        """A row a fingerprint: its value in each block, with the block's number above it."""
        return fingerprints[:, None] >> self.shifts & self.low | self.tags

    @property
    def nbytes(self) -> int:
        return self.fingerprints.nbytes + self.numbers.nbytes + self.begins.nbytes

    def near(self, queries: np.ndarray):
        """(query's number, number, distance) of all fingerprints within the radius, in this order."""
        n = self.fingerprints.size
        step = max(1, min(256, (1 << 20) // n))
        for first in range(0, queries.size, step):
            part = queries[first:first + step]
            wanted = (self.keys(part)[:, :, None] ^ self.masks).reshape(part.size, -1).astype(np.int64)
            begin = self.begins[wanted]
            many = self.begins[wanted + 1] - begin
            query, at = np.nonzero(many)
            many, begin = many[query, at], begin[query, at]
            seen = np.zeros((part.size, n), bool)
            places = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())
            seen[np.repeat(query, many), self.numbers[places]] = True
            query, number = np.nonzero(seen)
            distance = np.bitwise_count(self.fingerprints[number] ^ part[query])
            inside = distance <= self.radius
            yield from zip((query[inside] + first).tolist(), number[inside].tolist(), distance[inside].tolist())


def multiset(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values and their counts."""
    values, counts = np.unique(hashes, return_counts=True)
    return values, counts.astype(np.int32)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    at = np.minimum(np.searchsorted(b[0], a[0]), b[0].size - 1)
    both = int(np.minimum(a[1], b[1][at])[b[0][at] == a[0]].sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


class Multisets:
    """The multisets of many items in three arrays: values, counts and where each item begins."""

    def __init__(self, sets: list[tuple[np.ndarray, np.ndarray]]):
        self.values, self.counts = np.concatenate([v for v, _ in sets]), np.concatenate([c for _, c in sets])
        self.ends = np.cumsum([0, *(v.size for v, _ in sets)])

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.ends[i], self.ends[i + 1])
        return self.values[part], self.counts[part]

    @property
    def nbytes(self) -> int:
        return self.values.nbytes + self.counts.nbytes + self.ends.nbytes


@dataclass
class Length:
    """Items of one length: ``size`` shingles."""

    size: int
    items: list
    sets: Multisets
    index: BlockIndex


class Items:
    """The items of one block, by words in a shingle and number of shingles."""

    def __init__(self, rows: list[tuple]):
        groups = defaultdict(list)
        for item_id, text in rows:
            words = word_hashes(text or "")
            if words.size:
                k = min(SHINGLE, words.size)
                shingles = ngrams.windows(words, k)
                groups[k, shingles.size].append((item_id, shingles))
        self.sizes: dict[int, list[Length]] = defaultdict(list)
        known = defaultdict(list)
        for (k, size), items in sorted(groups.items()):
            fps = fingerprint_of(np.stack([bit_rows(s).sum(axis=0, dtype=np.int64) for _, s in items]), size)
            self.sizes[k].append(Length(size, [i for i, _ in items], Multisets([multiset(s) for _, s in items]), BlockIndex(fps)))
            known[k] += [s for _, s in items]
        self.known = {k: np.unique(np.concatenate(s)) for k, s in known.items()}
        self.rough = {}
        for k, values in self.known.items():
            self.rough[k] = np.zeros(1 << 20, bool)
            self.rough[k][(values & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    @property
    def nbytes(self) -> int:
        """Of all arrays that grow with the items."""
        return (sum(v.nbytes for v in self.known.values())
                + sum(x.sets.nbytes + x.index.nbytes for lengths in self.sizes.values() for x in lengths))

    def hits(self, shingles: np.ndarray, k: int) -> np.ndarray:
        """Which shingles occur in some item."""
        out = self.rough[k][(shingles & np.uint64((1 << 20) - 1)).astype(np.int64)]
        at = np.flatnonzero(out)
        if at.size:
            values = self.known[k]
            out[at] = values[np.minimum(np.searchsorted(values, shingles[at]), values.size - 1)] == shingles[at]
        return out

    def matches(self, text: str | None):
        """(item_id, start_word, n_words, distance, similarity) of each item's best window in the text."""
        words = word_hashes(text or "")
        for k, lengths in self.sizes.items():
            shingles = ngrams.windows(words, k)
            if not shingles.size:
                continue
            hit = self.hits(shingles, k)
            if not hit.any():
                continue
            upto = np.concatenate(([0], np.cumsum(hit)))
            for length in lengths:
                size = min(length.size, shingles.size)
                inside = upto[size:] - upto[:-size]
                starts = np.flatnonzero(inside >= math.ceil(SIMILARITY * length.size - 1e-9))
                if starts.size:
                    yield from self.verify(shingles, k, length, size, starts)

    @staticmethod
    def verify(shingles, k: int, length: Length, size: int, starts: np.ndarray):
        best: dict[int, tuple] = {}
        sets: dict[int, tuple] = {}
        for group in np.split(starts, np.flatnonzero(np.diff(starts) > size) + 1):
            lo = int(group[0])
            ones = np.concatenate((np.zeros((1, 64), np.int64), np.cumsum(
                bit_rows(shingles[lo:int(group[-1]) + size]), axis=0, dtype=np.int64)))
            at = group - lo
            for q, i, distance in length.index.near(fingerprint_of(ones[at + size] - ones[at], size)):
                start = int(group[q])
                if start not in sets:
                    sets = {start: multiset(shingles[start:start + size])}
                s = weighted_jaccard(sets[start], length.sets[i])
                if s >= SIMILARITY and (i not in best or s > best[i][-1]):
                    best[i] = (length.items[i], start, size + k - 1, distance, s)
        yield from best.values()


def index_bytes(text):
    """At least the bytes of an item's entries in the index: a shingle a word, a word for every second character at most,
    20 bytes a shingle (its value, count, and place among the known), and 48 bytes of fingerprint, blocks and offset.  What
    is left pays for the 8 KiB of a length once it has many items."""
    return 96 + 10 * F.octet_length(text)


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text"):
    """Lists of items whose index has about INDEX_BYTES bytes or less.  Equal items share a block."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    items = items.where(F.col("text").isNotNull())
    total = items.agg(F.sum(index_bytes("text"))).first()[0] or 0
    n = max(1, -(-total // INDEX_BYTES))
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield k + 1 == n, sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


_built: tuple = (None, None)


def built(key: str, rows: list[tuple]) -> Items:
    """The index of a block, built once a Python worker; the last one is kept."""
    global _built
    if _built[0] != key:
        _built = (None, None)                   # the old one goes before the new one is built
        _built = (key, Items(rows))
    return _built[1]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id and the best window of every item that a document holds."""
    def find(block: list[tuple]):
        key = uuid.uuid4().hex

        def run(batches):
            def rows():
                for batch in batches:
                    items = built(key, block)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                        for match in items.matches(text.as_py()):
                            yield (doc_id, *match)
            yield from arrow_rows(rows(), _ARROW)
        return run

    rows, parts = id_and_text(docs, id_col, text_col), []
    for last, block in item_blocks(benchmark):
        found = rows.mapInArrow(find(block), SCHEMA)
        parts.append(found if last and not parts else written(found, "contaminated"))
    return functools.reduce(DataFrame.unionAll, parts)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; nothing is shuffled.  With several blocks of
    items the rows that are left are written after each block but the last."""
    at = docs.columns.index(text_col)

    def without(block: list[tuple]):
        key = uuid.uuid4().hex

        def run(batches):
            for batch in batches:
                items = built(key, block)
                clean = [next(items.matches(t.as_py()), None) is None for t in batch.column(at)]
                yield batch.filter(pa.array(clean, pa.bool_()))
        return run

    for last, block in item_blocks(benchmark):
        docs = docs.mapInArrow(without(block), docs.schema)
        docs = docs if last else written(docs, "decontaminated")
    return docs
