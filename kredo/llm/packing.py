"""Sum-of-squares packing of tokenised documents into fixed windows.

Each scan task tokenises its documents and packs them on the fly, so no text or id is shuffled.
A document is cut into full windows and one remainder; the remainder goes to the fill level that
makes the sum of squared counts of partly filled windows smallest.  The counts live in a level
array (``levels[h]`` = open windows holding h ids).  At the end of a task, or when more than
``max_open`` windows are open, the open windows are topped up by cutting pieces from the emptiest
ones, so at most one of them stays partly filled.

Defined results: a null or empty text is a document of its end id alone; rows that repeat (same
id, same text) are packed as often as they occur; an empty table gives no rows; further columns
are not read.  Results are the same on every retry because a task's rows are (file split order).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from kredo.llm import tokens
from kredo.llm.common import arrow_rows, id_and_text

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

Piece = tuple  # (doc_id, start, ids as bytes, doc_tokens)


class SumOfSquares:
    """Online packing of pieces into windows of ``window`` ids."""

    def __init__(self, window: int, max_open: int):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list[Piece]]] = defaultdict(list)
        self.n_open = 0

    def choose(self, size: int) -> int:
        """The level (0: a new window) whose use gives the smallest sum of squares; ties go to the fullest.

        Moving one window from level h to h + size changes the sum by
        2 (levels[h + size] - levels[h]) + 2; a window that is filled leaves it (-2 levels[h] + 1);
        a new one enters it (2 levels[size] + 1).
        """
        w, n = self.window, self.levels
        used = np.flatnonzero(n[1:w - size + 1]) + 1
        best, best_change = 0, 2 * int(n[size]) + 1
        if used.size:
            target = used + size
            change = np.where(target == w, 1 - 2 * n[used], 2 * (n[target] - n[used]) + 2)
            k = used.size - 1 - int(np.argmin(change[::-1]))
            if change[k] <= best_change:
                best = int(used[k])
        return best

    def place(self, piece: Piece) -> Iterator[list[Piece]]:
        size = len(piece[2]) // 4
        if size == self.window:
            yield [piece]
            return
        h = self.choose(size)
        if h:
            pieces = self.open[h].pop()
            self.levels[h] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if h + size == self.window:
            yield pieces
        else:
            self.open[h + size].append(pieces)
            self.levels[h + size] += 1
            self.n_open += 1
            if self.n_open > self.max_open:
                yield from self.flush()

    def flush(self) -> Iterator[list[Piece]]:
        """Close every open window: the fullest are topped up with ends cut off the emptiest."""
        waiting = [(fill, pieces) for fill in sorted(self.open, reverse=True) for pieces in self.open[fill]]
        self.open.clear()
        self.levels[:] = 0
        self.n_open = 0
        lo, hi = 0, len(waiting) - 1
        while lo <= hi:
            fill, pieces = waiting[lo]
            while fill < self.window and hi > lo:
                rest_fill, rest = waiting[hi]
                doc, start, ids, total = rest.pop()
                n = len(ids) // 4
                take = min(n, self.window - fill)
                if take < n:
                    rest.append((doc, start, ids[:(n - take) * 4], total))
                pieces.append((doc, start + n - take, ids[(n - take) * 4:], total))
                fill += take
                waiting[hi] = (rest_fill - take, rest)
                if not rest:
                    hi -= 1
            yield pieces
            lo += 1


def cut(doc_id, ids: bytes, window: int) -> Iterator[Piece]:
    """Full windows, then the remainder."""
    total = len(ids) // 4
    for start in range(0, total, window):
        yield (doc_id, start, ids[start * 4:(start + window) * 4], total)


def pack(docs: DataFrame, tokenizer_path: str | None = None, window: int = 4096, end_id: int | None = 2,
         max_open: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: its ids, where it starts in its document, and its window and place there.

    ``ids`` holds little-endian unsigned 32-bit ids.  ``sequence_id`` is unique over the whole
    result (task number times 2**32 plus the window's number in the task).  A task holds at most
    ``max_open`` open windows.  Documents without any id (no end id and no token) give no piece.
    """
    path = tokenizer_path or tokens.default_path()
    tail = tokens.end_bytes(end_id)

    def run(batches):
        encode = tokens.encoder(path)
        packer = SumOfSquares(window, max_open)
        base = TaskContext.get().partitionId() << 32

        def windows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for piece in cut(doc_id, encode.ids(text.as_py()) + tail, window):
                        yield from packer.place(piece)
            yield from packer.flush()

        def rows():
            for number, pieces in enumerate(windows()):
                offset = 0
                for doc_id, start, ids, total in pieces:
                    n = len(ids) // 4
                    yield doc_id, start, n, ids, total, base + number, offset
                    offset += n

        yield from arrow_rows(rows(), _ARROW, weigh=lambda r: len(r[3]))

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
