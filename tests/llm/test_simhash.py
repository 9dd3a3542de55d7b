import random

import xxhash

from kredo.llm import simhash
from tests.llm.tables import PROSE, ROWS, awkward, nothing


def brute_components(rows, radius):
    """rows: (doc_id, fp); smallest id reachable over links of at most radius bits."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if ((rows[i][1] ^ rows[j][1]) & (2 ** 64 - 1)).bit_count() <= radius:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    out = {}
    for i, (d, _) in enumerate(rows):
        out.setdefault(find(i), []).append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in out.items()}
    return [least[find(i)] for i in range(len(rows))]


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), seed=42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_of_awkward_texts(spark):
    got = {(r["doc_id"], r["fp"] % 2 ** 64) for r in simhash.fingerprints(awkward(spark)).collect()}
    assert got == {(r[0], plain_fingerprint(r[1])) for r in ROWS}


def test_awkward_rows_against_brute_force(spark):
    rows = [(r[0], plain_fingerprint(r[1])) for r in ROWS]
    want = sorted(zip((str(r[0]) for r in rows), map(str, brute_components(rows, 3))))
    got = simhash.near_duplicates(awkward(spark)).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == want


def test_every_distance_up_to_the_radius_is_linked(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base:
        for k in range(1, 7):
            for _ in range(3):
                fps.add(b ^ sum(1 << i for i in rng.sample(range(64), k)))
    rows = [(k, f) for k, f in enumerate(sorted(fps))]
    signed = lambda f: f - 2 ** 64 if f >= 2 ** 63 else f
    for radius in (2, 3):
        frame = spark.createDataFrame([(signed(f),) for _, f in rows], "fp long")
        links = simhash.links(frame, radius)
        edges = [(r["a"], r["b"]) for r in links.collect()]
        assert all(((a ^ b) & (2 ** 64 - 1)).bit_count() <= radius for a, b in edges)
        ids = {signed(f): k for k, f in rows}
        label = {k: k for k, _ in rows}
        for _ in range(len(rows)):
            changed = False
            for a, b in edges:
                low = min(label[ids[a]], label[ids[b]])
                changed |= label[ids[a]] != low or label[ids[b]] != low
                label[ids[a]] = label[ids[b]] = low
            if not changed:
                break
        assert [label[k] for k, _ in rows] == brute_components(rows, radius)


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).selectExpr("id AS a", "id + 1 AS b").union(spark.sql("SELECT 1000L AS a, 1001L AS b"))
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert {roots[k] for k in range(61)} == {0} and roots[1001] == roots[1000] != 0


def test_keep_first(spark):
    kept = simhash.keep_first(awkward(spark))
    assert kept.columns == awkward(spark).columns
    got = kept.collect()
    ids = sorted((r["doc_id"] for r in got if r["doc_id"] is not None))
    rows = [(r[0], plain_fingerprint(r[1])) for r in ROWS]
    assert ids == sorted({d for d, c in zip((r[0] for r in rows), brute_components(rows, 3)) if d is not None and d == c})
    assert sum(r["doc_id"] is None for r in got) == 1


def test_one_row_of_each_component_where_ids_repeat(spark):
    other = "a wholly different text about ships and harbours in the cold northern sea at night " * 3
    docs = spark.createDataFrame([(1, PROSE), (1, PROSE), (1, other), (2, PROSE), (3, other), (4, "x y z w"), (4, "x y z w")],
                                 "doc_id long, text string")
    got = sorted(map(tuple, simhash.keep_first(docs).collect()))
    assert got == sorted([(1, PROSE), (1, other), (4, "x y z w")])


def test_empty_table(spark):
    assert simhash.near_duplicates(nothing(spark)).count() == 0
    assert simhash.keep_first(nothing(spark)).count() == 0
