"""Length buckets of integer vectors with sorted coordinate lists, and exact searches in them.

A query looks for rows whose inner product is at least a bound.  Over the lengths of the query and of
the longest row in a bucket that is a bound on the cosine, so a bucket of short rows falls away whole.
In any other, the angle between query and row is at most that bound's, and so is the difference of
their angles to each axis: for the query's focus coordinates (its largest ones) this gives a range of
values that a row's coordinate can have.  The range is a stretch of the bucket's sorted list of that
coordinate.  The shortest stretch is taken, the others are intersected with it, and the exact
integer product decides on what is left.
"""

from __future__ import annotations

import numpy as np

#: Coordinates of a query whose ranges are intersected.
FOCUS = 5
#: Slack of the ranges, far above what rounding of unit vectors can be.
SLACK = 1e-6
NONE = np.iinfo(np.int64).max


def number_type(a: np.ndarray, b: np.ndarray):
    """The narrowest type in which all inner products of rows of a and b are exact."""
    if not a.size or not b.size:
        return np.float64
    most = longest(a) * longest(b) * (1 + 1e-9)
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def longest(a: np.ndarray) -> float:
    return float(np.sqrt((a.astype(np.float64) ** 2).sum(axis=1)).max())


def exact_products(a: np.ndarray, b: np.ndarray, kind) -> np.ndarray:
    """Inner products of integer rows (of a type from ``number_type``) as longs; beyond a long: the nearest long."""
    got = a @ b.T
    if kind is object:
        top = np.iinfo(np.int64)
        return np.array([[min(max(int(v), top.min), top.max) for v in row] for row in got], np.int64).reshape(got.shape)
    return got.astype(np.int64)


def widened(v: np.ndarray, dim: int) -> np.ndarray:
    """Rows with zeros up to ``dim`` coordinates."""
    return v if v.shape[1] == dim else np.pad(v, ((0, 0), (0, dim - v.shape[1])))


class Bucket:
    """Rows of similar length: vectors (int64), ids and labels, with each coordinate's sorted list."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, order: np.ndarray | None = None):
        self.vectors, self.ids, self.labels = vectors, ids, labels
        wide = vectors.astype(np.float64)
        lengths = np.sqrt((wide ** 2).sum(axis=1))
        self.shortest, self.longest = float(lengths.min()), float(lengths.max())
        units = wide / np.maximum(lengths, 1e-300)[:, None]
        # order[f]: row numbers by the value of coordinate f
        self.order = np.argsort(units, axis=0, kind="stable").T.astype(np.uint16) if order is None else order
        self.values = np.take_along_axis(units.T, self.order.astype(np.int64), axis=1)
        rank = np.empty(self.order.shape, np.int32)
        np.put_along_axis(rank, self.order.astype(np.int64), np.arange(len(ids), dtype=np.int32)[None, :], axis=1)
        self.rank = rank

    def feasible(self, units: np.ndarray, focus: np.ndarray, lengths: np.ndarray, bounds: np.ndarray):
        """(whether the bucket can hold a hit, first and last place in the focus coordinates' lists) per query."""
        n, f = focus.shape
        size = np.where(bounds >= 0, self.longest, self.shortest) * lengths
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(size > 0, bounds / size, np.where(bounds > 0, 2.0, -1.0))
        alive = cosine <= 1 + SLACK
        reach = np.arccos(np.clip(cosine - SLACK, -1, 1))
        axis = np.arccos(np.clip(np.take_along_axis(units, focus, axis=1), -1, 1))
        # no bound on the angle: all rows
        least = np.where(reach[:, None] >= np.pi, -2.0, np.cos(np.minimum(axis + reach[:, None], np.pi)) - SLACK)
        most = np.where(reach[:, None] >= np.pi, 2.0, np.cos(np.maximum(axis - reach[:, None], 0)) + SLACK)
        first, last = np.zeros((n, f), np.int64), np.zeros((n, f), np.int64)
        flat = focus.ravel()
        by = np.argsort(flat, kind="stable")
        edges = np.flatnonzero(np.diff(flat[by], prepend=-1))
        for part in np.split(by, edges[1:]):
            if part.size:
                column = self.values[flat[part[0]]]
                first.ravel()[part] = np.searchsorted(column, least.ravel()[part], "left")
                last.ravel()[part] = np.searchsorted(column, most.ravel()[part], "right")
        return alive & (last > first).all(axis=1), first, last

    def candidates(self, focus: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Rows in the stretches of all focus coordinates of one query."""
        sizes = last - first
        at = int(np.argmin(sizes))
        rows = self.order[focus[at], first[at]:last[at]].astype(np.int64)
        for k in np.argsort(sizes):
            if k != at and sizes[k] < len(self.ids):
                rank = self.rank[focus[k], rows]
                rows = rows[(rank >= first[k]) & (rank < last[k])]
        return rows


class Queries:
    """A block of anchors with what they look for so far."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.vectors, self.ids, self.labels = vectors, ids, labels

    def prepare(self, dim: int) -> None:
        self.vectors = widened(self.vectors, dim)
        wide = self.vectors.astype(np.float64)
        self.lengths = np.sqrt((wide ** 2).sum(axis=1))
        self.units = wide / np.maximum(self.lengths, 1e-300)[:, None]
        self.focus = np.argsort(-np.abs(self.units), axis=1, kind="stable")[:, :FOCUS]

    def hits(self, bucket: Bucket, bounds: np.ndarray, same_label: bool):
        """(anchor number, rows, scores) of the bucket's rows of the same label, or of other labels, that reach the
        anchor's bound; the anchor itself is none.  ``bounds`` may rise while this runs."""
        dim = max(self.vectors.shape[1], bucket.vectors.shape[1])
        if dim > self.vectors.shape[1] or not hasattr(self, "units"):
            self.prepare(dim)
        if dim > bucket.vectors.shape[1]:
            bucket.__init__(widened(bucket.vectors, dim), bucket.ids, bucket.labels)
        kind = number_type(self.vectors, bucket.vectors)
        mine = self.vectors.astype(kind)
        theirs = bucket.vectors.astype(kind)
        alive, first, last = bucket.feasible(self.units, self.focus, self.lengths, bounds)
        for k in np.flatnonzero(alive):
            rows = bucket.candidates(self.focus[k], first[k], last[k])
            same = bucket.labels[rows] == self.labels[k]
            rows = rows[same & (bucket.ids[rows] != self.ids[k])] if same_label else rows[~same]
            if not rows.size:
                continue
            scores = exact_products(mine[k:k + 1], theirs[rows], kind)[0]
            good = scores >= bounds[k]
            if good.any():
                yield int(k), rows[good], scores[good]


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores, ties by smaller id."""
    if len(scores) > 8 * n:
        cut = np.partition(scores, len(scores) - n)[len(scores) - n]
        near = np.flatnonzero(scores >= cut)
        return near[np.lexsort((ids[near], -scores[near]))[:n]]
    return np.lexsort((ids, -scores))[:n]


class TopSearch:
    """The n best rows of the anchor's label."""

    def __init__(self, queries: Queries, n: int):
        self.q, self.n = queries, n
        self.bounds = np.full(len(queries.ids), -np.inf)
        self.found: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def visit(self, bucket: Bucket) -> None:
        for k, rows, scores in self.q.hits(bucket, self.bounds, True):
            ids = bucket.ids[rows]
            if k in self.found:
                ids, scores = np.append(self.found[k][0], ids), np.append(self.found[k][1], scores)
            top = best(scores, ids, self.n)
            self.found[k] = ids[top], scores[top]
            if len(top) == self.n:
                self.bounds[k] = max(self.bounds[k], scores[top[-1]])

    def rows(self):
        """(anchor id, row id, score)"""
        for k, (ids, scores) in self.found.items():
            for i, s in zip(ids.tolist(), scores.tolist()):
                yield int(self.q.ids[k]), i, s


class WindowSearch:
    """The n best rows of other labels in each of an anchor's windows of scores.

    windows: anchors x positives x (least, most); least > most where there is none.
    """

    def __init__(self, queries: Queries, windows: np.ndarray, n: int):
        self.q, self.n, self.windows = queries, n, windows
        self.least = windows[:, :, 0].copy()                       # rises as windows fill
        self.least[windows[:, :, 0] > windows[:, :, 1]] = NONE
        self.bounds = self.least.min(axis=1, initial=NONE).astype(np.float64)
        self.found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def visit(self, bucket: Bucket) -> None:
        for k, rows, scores in self.q.hits(bucket, self.bounds, False):
            ids = bucket.ids[rows]
            for w, (least, most) in enumerate(zip(self.least[k].tolist(), self.windows[k, :, 1].tolist())):
                good = (scores >= least) & (scores <= most)
                if least == NONE or not good.any():
                    continue
                mine, reached = ids[good], scores[good]
                if (k, w) in self.found:
                    mine, reached = np.append(self.found[k, w][0], mine), np.append(self.found[k, w][1], reached)
                top = best(reached, mine, self.n)
                self.found[k, w] = mine[top], reached[top]
                if len(top) == self.n:
                    self.least[k, w] = reached[top[-1]]
            self.bounds[k] = float(self.least[k].min())

    def rows(self):
        """(anchor id, window number, row id, score)"""
        for (k, w), (ids, scores) in self.found.items():
            for i, s in zip(ids.tolist(), scores.tolist()):
                yield int(self.q.ids[k]), w, i, s
