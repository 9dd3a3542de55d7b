"""Boosted trees against a brute-force split finder and against separate fits."""

import math
import random

import pytest
from pyspark.sql import functions as F

from kredo.operators import boosting

P = boosting.Params(trees=2, depth=3, rate=0.3, subsample=1.0, colsample=1.0, bins=8, min_hessian=0.5)


def made(n, seed, groups=1):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        bins = [0 if rng.random() < 0.15 else rng.randint(1, 6) for _ in range(4)]
        risky = bins[0] > 3 or (bins[1] == 0 and bins[2] < 3)
        out.append((f"g{k % groups}", k, "train" if k % 5 else "eval", int(rng.random() < (0.8 if risky else 0.2)),
                    rng.choice([1.0, 2.0]), bins))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "grp string, rid long, role string, y int, w double, bins array<int>")


def brute(rows, p):
    """Margins of one group's rows by trying every split."""
    margin = {r[1]: 0.0 for r in rows}
    for _ in range(p.trees):
        step = dict.fromkeys(margin, 0.0)

        def grow(mine, depth):
            def sums(part):
                g = h = 0.0
                for _, k, role, y, w, _ in part:
                    if role == "train":
                        q = 1 / (1 + math.exp(-margin[k]))
                        g, h = g + w * (q - y), h + w * q * (1 - q)
                return g, h
            G, H = sums(mine)
            best = None
            for f in range(4):
                for t in sorted({r[5][f] for r in mine if r[2] == "train"}):
                    for side in (False, True):
                        left = [r for r in mine if (side if r[5][f] == 0 else r[5][f] <= t)]
                        GL, HL = sums(left)
                        GR, HR = G - GL, H - HL
                        if HL < p.min_hessian or HR < p.min_hessian:
                            continue
                        gain = round((GL ** 2 / (HL + p.l2) + GR ** 2 / (HR + p.l2) - G ** 2 / (H + p.l2)) / 2, 10)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = gain, left, [r for r in mine if r not in left]
            if depth == 0 or best is None:
                for r in mine:
                    step[r[1]] = -G / (H + p.l2)
                return
            grow(best[1], depth - 1)
            grow(best[2], depth - 1)

        grow(rows, p.depth)
        margin = {k: m + p.rate * step[k] for k, m in margin.items()}
    return margin


def margins(state):
    return {r["rid"]: r["margin"] for r in state.collect()}


def test_trees_equal_a_brute_force_split_finder_and_groups_equal_separate_fits(spark):
    rows = made(500, 1, groups=2)
    _, state = boosting.fit(frame(spark, rows), 4, P)
    got = margins(state)
    for g in ("g0", "g1"):
        mine = [r for r in rows if r[0] == g]
        assert {k: got[k] for _, k, *_ in mine} == pytest.approx(brute(mine, P), abs=1e-8)
    loss = state.where("role = 'eval'").agg(F.avg(boosting.log_loss())).first()[0]
    assert loss < math.log(2) - 0.02


def test_binning_keeps_missing_apart_and_orders_categories_by_target(spark):
    rows = [(k, float(k % 10) if k % 7 else None, f"c{k % 50:02d}", int(k % 50 >= 25), "train" if k < 900 else "eval") for k in range(1000)]
    rows += [(2000, float("nan"), "unseen", 0, "eval"), (2001, 100.0, None, 0, "eval")]
    df = spark.createDataFrame(rows, "k long, x double, c string, y int, role string").withColumn("w", F.lit(1.0))
    out, names = boosting.binned(df, ["x"], ["c"], "y", "w", "role", ["k"], p=boosting.Params(bins=8))
    assert names == ["x", "c"]
    got = {r["rid"]: (r["y"], r["bins"]) for r in out.collect()}
    ids = {r[0]: r[1] for r in df.select("k", F.xxhash64("k")).collect()}
    assert got[ids[0]][1][0] == 0 and got[ids[2000]][1] == [0, 0] and got[ids[2001]][1][1] == 0
    by = [got[ids[k]] for k in range(1000)]
    assert max(b[1] for y, b in by if y == 0) < min(b[1] for y, b in by if y == 1)       # the order separates them
    assert {b[1] for _, b in by} == set(range(1, 9)) and max(b[0] for _, b in by) <= 8


def test_growth_ends_when_validation_stops_improving_and_importance_counts_splits(spark):
    rows = [(g, k, "valid" if role == "eval" else role, y, w, b) for g, k, role, y, w, b in made(400, 3)]
    trees, _ = boosting.fit(frame(spark, rows), 4, boosting.Params(trees=12, depth=1, rate=1.0, bins=8, tolerance=0.2, patience=1))
    assert trees.agg(F.max("tree")).first()[0] < 11
    imp = boosting.importance(trees, ["a", "b", "c", "d"])
    assert imp.agg(F.sum("weight")).first()[0] == trees.where("gain IS NOT NULL").count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_not_exchanged_by_category_or_node_and_every_pass_has_all_tasks(spark):
    """Few categories and nodes must not leave the rows in few tasks."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "20000", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = spark.range(0, 4000, 1, 1).selectExpr("id AS k", "concat('c', id % 3) AS c", "CAST(id % 3 = 0 AS INT) AS y",
                                                   "IF(id % 5 = 0, 'eval', 'train') AS role", "CAST(1 AS DOUBLE) AS w")
        rows, names = boosting.binned(df, [], ["c"], "y", "w", "role", ["k"], p=boosting.Params(bins=8))
        assert "BroadcastHashJoin" in plan(rows) and "Exchange hashpartitioning" not in plan(rows)
        trees, state = boosting.fit(rows, len(names), boosting.Params(trees=1, depth=1, bins=8, subsample=1.0, colsample=1.0))
        assert trees.count() == 1 and trees.first()["gain"] > 0
        found = [r["count"] for r in state.groupBy(F.spark_partition_id()).count().collect()]
        assert len(found) == 4 and max(found) < 2000
        now = state.withColumns({"node": F.lit(0).cast("long"), "value": F.lit(0.0), "open": F.lit(True)})
        assert "Exchange hashpartitioning" not in plan(boosting.descended(now, trees))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
