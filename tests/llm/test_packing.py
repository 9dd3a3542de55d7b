import random

import numpy as np

from kredo.llm import packing, tokens
from tests.llm.tables import ROWS, awkward, nothing


def check_pieces(rows, expected, window):
    """rows: pieces; expected: list of (doc_id, ids) documents, repeats included."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    wanted = {}
    for doc, ids in expected:
        wanted.setdefault(doc, []).append(ids)
    assert set(by_doc) == set(wanted)
    for doc, pieces in by_doc.items():
        assert all(len(set(map(bytes, wanted[doc]))) == 1 for _ in pieces)
        ids, copies = wanted[doc][0], len(wanted[doc])
        covered = np.zeros(len(ids) // 4, int)
        for p in pieces:
            assert bytes(p["ids"]) == ids[p["start"] * 4:(p["start"] + p["length"]) * 4]
            assert p["doc_tokens"] == len(ids) // 4
            covered[p["start"]:p["start"] + p["length"]] += 1
        assert (covered == copies).all()
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window


def test_awkward_rows_round_trip(spark):
    rows = packing.pack(awkward(spark).coalesce(2), window=64).collect()
    encode, tail = tokens.encoder(tokens.default_path()), tokens.end_bytes(2)
    check_pieces(rows, [(r[0], encode.ids(r[1]) + tail) for r in ROWS], 64)


def test_empty_table(spark):
    assert packing.pack(nothing(spark)).count() == 0


def test_choice_is_the_brute_force_minimum():
    rng = random.Random(3)
    p = packing.SumOfSquares(24, max_open=10_000)
    for k in range(400):
        size = rng.randint(1, 23)
        changes = {}
        for h in range(0, 24 - size + 1):
            if h and not p.levels[h]:
                continue
            n = p.levels.copy()
            if h:
                n[h] -= 1
            if h + size < 24:
                n[h + size] += 1
            changes[h] = int((n[1:24] ** 2).sum())
        h = p.choose(size)
        assert changes[h] == min(changes.values())
        list(p.place((k, 0, b"\0" * 4 * size, size)))


def test_flush_leaves_one_partly_filled_window_and_bounds_the_open_ones():
    p = packing.SumOfSquares(16, max_open=8)
    done = []
    for k in range(100):
        done += p.place((k, 0, bytes(4 * 11), 11))
        assert p.n_open <= 8
    done += p.flush()
    fills = [sum(len(x[2]) // 4 for x in w) for w in done]
    assert sum(fills) == 1100 and all(0 < f <= 16 for f in fills)
    assert sum(f < 16 for f in fills) <= 100 // 8 + 1
