"""Merging of segments, held against the step by step rule."""

import random

import pytest

from kredo.operators.segments import merge_segments

PATH = ["a", "b", "c"]


def stepwise(rows, k):
    """Take the smallest node without nodes under it and give its rows to its parent, until k groups are left."""
    tree, held = set(), {}
    for *path, n in rows:
        parts = tuple("" if p is None else "=" + p for p in path)
        tree.update(parts[:level] for level in range(len(parts) + 1))
        held.setdefault(parts, []).append((path, n))
    while len(held) > k:
        tips = [t for t in tree if t and not any(u != t and u[:len(t)] == t for u in tree)]
        total = {t: sum(n for _, n in held.get(t, [])) for t in tips}
        low = min(total.values())
        deep = max(len(t) for t in tips if total[t] == low)
        tip = max(t for t in tips if total[t] == low and len(t) == deep)
        held.setdefault(tip[:-1], []).extend(held.pop(tip, []))
        tree.remove(tip)
    return sorted(((*path, n, len(key), "/".join(key), sum(m for _, m in group)) for key, group in held.items()
                   for path, n in group), key=str)


@pytest.mark.parametrize("seed, k", [(1, 1), (2, 5), (3, 9), (4, 1000)])
def test_merge_equals_the_step_by_step_rule(spark, seed, k):
    draw = random.Random(seed)
    paths = sorted({(draw.choice("uvwxy"), draw.choice(["p", "q", "", None]), draw.choice(["1", "2", None]))
                    for _ in range(60)}, key=str)
    rows = [(*p, draw.randint(1, 6)) for p in paths]
    got = merge_segments(spark.createDataFrame(rows, "a string, b string, c string, n long"), PATH, k)
    assert sorted((tuple(r) for r in got.collect()), key=str) == stepwise(rows, k)
    assert got.select("group_key").distinct().count() <= k


def test_merge_of_nothing_and_of_a_hot_segment(spark):
    schema = "a string, b string, c string, n long"
    assert merge_segments(spark.createDataFrame([], schema), PATH, 3).count() == 0
    rows = [("x", "p", "1", 10 ** 12)] + [(f"s{i}", "p", "1", 1) for i in range(50)]
    got = merge_segments(spark.createDataFrame(rows, schema), PATH, 2)
    assert {(r["group_key"], r["group_n"]) for r in got.collect()} == {("=x/=p/=1", 10 ** 12), ("", 50)}


def test_the_census_is_made_once(spark):
    """The census is read once, though nodes and members both need it."""
    from pyspark.sql import functions as F
    from kredo.operators import segments
    seen = spark.sparkContext.accumulator(0)
    rows = spark.sparkContext.parallelize([("a", "x", 3), ("a", "y", 2), ("b", "x", 1)], 1)

    def counted(part):
        for r in part:
            seen.add(1)
            yield r

    counts = spark.createDataFrame(rows.mapPartitions(counted), "p string, q string, n bigint")
    got = segments.merge_segments(counts, ["p", "q"], 2).agg(F.sum("n")).first()[0]
    assert got == 6 and seen.value == 3
