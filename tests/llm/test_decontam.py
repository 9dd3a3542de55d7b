import random
from collections import Counter

from pyspark.sql import functions as F

from kredo.llm import decontam
from tests.llm.tables import awkward, nothing

ITEM = "what is the boiling point of water at sea level in degrees celsius on a clear day in spring"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(docs, bench):
    return {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()}


def test_awkward_rows_and_items(spark):
    bench = items(spark, [(1, "THE quick, brown fox jumps: over the lazy dog near the river bank"), (2, None), (3, ""),
                          (4, "solo"), (5, "solo"), (None, "unknown words here that no text holds at all")])
    assert found(awkward(spark), bench) == {(1, 1), (2, 1), (3, 1), (-3, 4), (-3, 5)}
    clean = decontam.drop_contaminated(awkward(spark), bench)
    assert clean.columns == awkward(spark).columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter([4, 5, None, 6, 7, 8, 8, 9])


def test_empty_tables(spark):
    bench = items(spark, [(1, ITEM)])
    assert found(nothing(spark), bench) == set()
    assert found(awkward(spark), bench.where("false")) == set()
    assert decontam.drop_contaminated(nothing(spark), bench).count() == 0
    assert decontam.drop_contaminated(awkward(spark), bench.where("false")).count() == awkward(spark).count()


def test_every_window_against_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"v{k}" for k in range(400)]
    bench = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(3, 70)))) for k in range(25)]
    docs = []
    for d in range(90):
        words = rng.choices(vocabulary, k=rng.randint(0, 120))
        for _, text in rng.sample(bench, 2):
            part = text.split()
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                part[rng.randrange(len(part))] = rng.choice(vocabulary)
            at = rng.randint(0, len(words))
            words[at:at] = part[:rng.randint(len(part) * 3 // 4, len(part))]
        docs.append((d, " ".join(words)))
    want = set()
    for d, text in docs:
        words = text.split()
        for i, item in bench:
            own = item.split()
            k = min(5, len(own))
            goal = Counter(tuple(own[j:j + k]) for j in range(len(own) - k + 1))
            here = [tuple(words[j:j + k]) for j in range(len(words) - k + 1)]
            size = min(len(here), sum(goal.values()))
            for j in range(len(here) - size + 1 if size else 0):
                window = Counter(here[j:j + size])
                both = sum((window & goal).values())
                if both >= 0.8 * (sum(goal.values()) + size - both):
                    want.add((d, i))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert len(want) > 15
    assert found(frame, items(spark, bench)) == want


def test_index_returns_all_within_the_radius():
    rng = random.Random(9)
    import numpy as np
    fps = np.asarray([rng.getrandbits(64) for _ in range(200)], np.uint64)
    for radius, blocks in ((24, 8), (10, 8), (3, 4)):
        index = decontam.BlockIndex(fps, radius, blocks)
        queries = [int(fps[rng.randrange(200)]) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius + 3)))
                   for _ in range(300)]
        want = [(k, i, (int(f) ^ q).bit_count()) for k, q in enumerate(queries) for i, f in enumerate(fps)
                if (int(f) ^ q).bit_count() <= radius]
        assert list(index.near(np.asarray(queries, np.uint64))) == want


def test_items_come_in_blocks_of_bounded_bytes(spark, monkeypatch):
    bench = items(spark, [(k, f"{ITEM} {k}") for k in range(6)])
    docs = spark.createDataFrame([(k, f"before {ITEM} {k} after", "x") for k in range(6)] + [(9, "clean text", "x")],
                                 "doc_id long, text string, extra string")
    whole, kept = found(docs, bench), decontam.drop_contaminated(docs, bench).collect()
    assert {(k, k) for k in range(6)} <= whole and [r["doc_id"] for r in kept] == [9]
    monkeypatch.setattr(decontam, "INDEX_BYTES", 3000)
    blocks = list(decontam.item_blocks(bench))
    assert len(blocks) > 1 and sorted(i for _, b in blocks for i, _ in b) == list(range(6))
    assert [last for last, _ in blocks] == [False] * (len(blocks) - 1) + [True]
    assert found(docs, bench) == whole
    assert decontam.drop_contaminated(docs, bench).collect() == kept


def test_index_bytes_are_bounded_before_it_is_built(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 90)))) for k in range(3000)]
    rows += [(k, " ".join(f"word{rng.randrange(9999)}" for _ in range(rng.randint(1, 90)))) for k in range(3000, 6000)]
    bound = items(spark, rows).agg(F.sum(decontam.index_bytes("text"))).first()[0]
    assert decontam.Items(rows).nbytes <= bound
