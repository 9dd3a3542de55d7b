import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kredo.llm import mixing
from tests.llm.tables import ROWS, awkward, nothing


def plain_targets(sizes, most=3):
    """The shares as written down: excess reshared by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    goal, free, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            goal[s] += left * weight[s] / total
        left = sum(max(0.0, goal[s] - most * sizes[s]) for s in free)
        for s in [s for s in free if goal[s] >= most * sizes[s]]:
            goal[s] = float(most * sizes[s])
            free.discard(s)
    return goal


def check(docs, **options):
    rows = docs.select("doc_id", "text", "source").collect()
    out = mixing.mix(docs, **options).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((str(r["doc_id"]), r["size"], str(r["source"])) for r in out) == sorted(
        (str(r["doc_id"]), words(r["text"]), str(r["source"])) for r in rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert r["taken"] == r["copies"] * r["size"]
        assert not r["size"] or rate - 1 < r["copies"] < rate + 1 and r["copies"] <= 3
    goal = plain_targets(sizes)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(goal[r["source"]], abs=1e-6)
    return out, goal, taken


def test_awkward_rows(spark):
    out, goal, taken = check(awkward(spark))
    assert all(r["taken"] <= 3 * r["size"] for r in out)
    assert sum(goal.values()) == pytest.approx(sum(r["size"] for r in out))


def test_nothing_and_no_words(spark):
    assert mixing.mix(nothing(spark)).count() == 0
    out, _, _ = check(awkward(spark).where("text IS NULL OR doc_id = 9"))
    assert {(r["target"], r["taken"]) for r in out} == {(0.0, 0)}


def corpus(spark, n):
    size = F.pmod(F.xxhash64("id"), F.lit(60)) + F.when(F.col("id") % 97 == 0, 3000).otherwise(0)
    return spark.range(n).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), size.cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
            F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"))


def test_words_come_near_the_targets_through_a_tree_of_leaves(spark):
    docs = corpus(spark, 6000)
    out, goal, taken = check(docs, leaf=50, fan=4)
    for s in goal:
        assert abs(taken[s] - goal[s]) <= 0.002 * goal[s] + 5


def test_reruns_agree_however_the_rows_lie(spark):
    docs = corpus(spark, 1500)
    key = lambda df: sorted(tuple(r) for r in mixing.mix(df, leaf=100, fan=4).select("doc_id", "taken").collect())
    first = key(docs)
    assert first == key(docs.repartition(7)) == key(docs.orderBy(F.rand(3)))


def test_each_document_keeps_its_expected_copies(spark):
    """Over many seeds the mean of a document's extra copies is its fraction, whatever its size."""
    rng = random.Random(5)
    sizes = [rng.choice([3, 10, 40, 200]) for _ in range(24)]
    p, runs = 0.3, 3000
    got = [0.0] * len(sizes)
    for seed in range(runs):
        node, out = mixing.Node(seed), []
        docs = [[k, s, 0, 0, k, 0, p, False] for k, s in sorted(enumerate(sizes), key=lambda x: -x[1])]
        words = sum(d[1] * d[6] for d in docs)
        for d in docs:
            out += node.add(d)
        out += node.close()
        assert sum(d[1] * d[6] for d in out) == pytest.approx(words)
        assert sum(0 < d[6] < 1 for d in out) <= 1
        for d in out:
            got[d[0]] += d[6]
    assert all(abs(g / runs - p) < 0.05 for g in got)


def test_targets_stop_at_three_times_a_source(spark):
    sizes = {"a": 1, "b": 1000, "c": 2, None: 30, "d": 0}
    rows = spark.createDataFrame([(s, 1, n) for s, n in sizes.items()], "source string, rows long, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))
    assert got["a"] == 3.0 and got["c"] == 6.0 and sum(got.values()) == pytest.approx(1033)
