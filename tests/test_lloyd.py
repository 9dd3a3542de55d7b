import random

import pytest

from kredo.operators import segments


def brute(rows):
    means = {}
    for c in sorted({r[0] for r in rows if r[0] is not None}):
        own = [r for r in rows if r[0] == c]
        means[c] = [sum(r[k] for r in own) / len(own) for k in (1, 2)]
    return [min((sum((r[k] - m[k - 1]) ** 2 for k in (1, 2)), c) for c, m in means.items()) for r in rows]


def test_step_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(rng.choice([3, 5, 9, None]), rng.gauss(0, 2), rng.gauss(1, 3), k) for k in range(400)]
    df = spark.createDataFrame(rows, "c int, x double, y double, id int")
    got = {r["id"]: (r["distance"], r["nearest"]) for r in segments.lloyd_step(df, "c", ["x", "y"]).collect()}
    for r, (d, c) in zip(rows, brute(rows)):
        assert got[r[3]][1] == c and got[r[3]][0] == pytest.approx(d)


def test_fixed_point_ties_and_no_rows(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 1.0), (2, 10.0), (2, 11.0)], "c int, x double")
    facts = {r["cluster"]: r for r in segments.step_facts(segments.lloyd_step(df, "c", ["x"]), "c").collect()}
    assert {c: (r["n"], r["moved"], r["share"]) for c, r in facts.items()} == {1: (2, 0, 0.5), 2: (2, 0, 0.5)}
    same = spark.createDataFrame([(4, 1.0), (2, 1.0), (None, 1.0)], "c int, x double")
    assert {r["nearest"] for r in segments.lloyd_step(same, "c", ["x"]).collect()} == {2}
    assert segments.step_facts(segments.lloyd_step(df.where("false"), "c", ["x"]), "c").count() == 0
    flat = segments.standardised(spark.createDataFrame([(1, 5.0), (2, None), (3, 5.0)], "c int, x double"), ["x"])
    assert [r["x"] for r in flat.collect()] == [0.0, 0.0, 0.0]
