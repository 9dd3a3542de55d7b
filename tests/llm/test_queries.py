"""The registered queries over a whole small table, against brute force, round trips or held-out labels."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from kredo.llm import pii, tokens
from kredo.llm.queries import QUERIES
from tests.llm.test_pii import plain
from tests.llm.test_quality import plain_counts
from tests.llm.test_simhash import brute_components, plain_fingerprint


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids(docs):
    tok = tokens.encoder(tokens.default_path()).tok
    return {d: np.asarray(tok.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4") for d, r in docs.items()}


def run(spark, sf_dir, n):
    name = next(q for q in QUERIES if q.startswith(f"op{n}_"))
    return QUERIES[name](spark, sf_dir).collect()


def test_op1(spark, sf_dir, docs):
    rows = run(spark, sf_dir, 1)
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {
        (d, len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for d, r in docs.items()}
    assert len(rows) == len(docs) and {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for shard in range(40):
        mine = [r for r in rows if r["shard"] == shard]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        assert abs(sum(r["size"] for r in mine) - total / 40) <= 3 * largest


def test_op2(spark, sf_dir, docs):
    import re
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    shingles = lambda w: [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []
    want = set()
    for item in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        goal = Counter(shingles(words(item["text"])))
        n = sum(goal.values())
        for d, r in docs.items():
            here = shingles(words(r["text"] or ""))
            size = min(n, len(here))
            if not size or not set(here) & set(goal):
                continue
            for j in range(len(here) - size + 1):
                both = sum((Counter(here[j:j + size]) & goal).values())
                if both >= 0.8 * (n + size - both):
                    want.add((d, item["item_id"]))
                    break
    assert want and {(r["doc_id"], r["item_id"]) for r in run(spark, sf_dir, 2)} == want


def test_op3(spark, sf_dir, ids):
    rows = run(spark, sf_dir, 3)
    covered = {d: np.zeros(len(i), int) for d, i in ids.items()}
    windows = {}
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(own[r["start"]:r["start"] + r["length"]].tobytes())
        covered[r["doc_id"]][r["start"]:r["start"] + r["length"]] += 1
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all((c == 1).all() for c in covered.values())
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(map(len, ids.values()))
    assert len(windows) * 4096 - total < 4096 * 9


def test_op4(spark, sf_dir, docs):
    rows = run(spark, sf_dir, 4)
    assert len(rows) == len(docs)
    for r in rows:
        base = plain(docs[r["doc_id"]]["text"] or "")
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in range(4)]
        said = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(base)]
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert set(said) <= set(r["spans"].split(",") if r["spans"] else [])


def test_op5(spark, sf_dir):
    rows = run(spark, sf_dir, 5)
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert Counter((r["page_id"], r["warc_type"]) for r in rows) == Counter(
        (p, k) for p in pages for k in ("metadata", "conversion"))
    assert all(r["error"] is None and r["digest_ok"] and r["target_uri"] == pages[r["page_id"]]["url"] for r in rows)
    assert len({r["record_id"] for r in rows}) == len(rows)
    assert len({(r["page_id"], r["refers_to"]) for r in rows}) == len(pages)


def test_op6(spark, sf_dir, docs):
    rows = run(spark, sf_dir, 6)
    plain_fps = [(d, plain_fingerprint(r["text"])) for d, r in docs.items()]
    want = {d: (f"{f:016x}", c) for (d, f), c in zip(plain_fps, brute_components(plain_fps, 3))}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == want and len(rows) == len(docs)


def test_op7(spark, sf_dir, docs):
    rows = {r["doc_id"]: r for r in run(spark, sf_dir, 7)}
    assert set(rows) == set(docs)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    held = [d for d in labels if rows[d]["held_out"]]
    assert np.mean([rows[d]["predicted"] == labels[d] for d in held]) > 0.85


def test_op8(spark, sf_dir, docs):
    rows = run(spark, sf_dir, 8)
    assert len(rows) == len(docs)
    for r in rows:
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == plain_counts(docs[r["doc_id"]]["text"])
        assert r["kept"] == (not r["base_failed"] and r["probability"] >= 0.5)


def test_op9(spark, sf_dir, ids):
    at = 0
    for r, d in zip(sorted(run(spark, sf_dir, 9), key=lambda r: r["start"]), sorted(ids), strict=True):
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (d, at, len(ids[d]))
        assert r["ids_crc32"] == zlib.crc32(ids[d].tobytes())
        at += len(ids[d])


def test_op10(spark, sf_dir, docs):
    rows = {r["doc_id"]: r for r in run(spark, sf_dir, 10)}
    assert set(rows) == set(docs)
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    held = [d for d in docs if rows[d]["held_out"]]
    assert np.mean([rows[d]["lang_pred"] == docs[d]["lang"] for d in held]) > 0.9


def test_the_library_works_without_this_package():
    """Nothing outside imports it, and the entry point guards its one import."""
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[2]
    outside = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts
               and p.name not in ("corpus_pipeline.py", "__spark_entry__.py")]
    assert not [p for p in outside if "kredo.llm" in p.read_text()]
