import math
import random

import numpy as np
import pytest

from kredo.operators import metrics, segments


def _auc_brute(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_roc_auc_matches_pairwise_count(spark):
    rnd = random.Random(3)
    rows = [(round(rnd.random(), 2), rnd.randint(0, 1)) for _ in range(400)]      # many ties
    df = spark.createDataFrame([("g", s, y) for s, y in rows], "g string, score double, label long")
    got = metrics.roc_auc(df, ["g"]).first()["roc_auc"]
    assert got == pytest.approx(_auc_brute(rows), abs=1e-12)


def test_confusion_metrics(spark):
    rows = [(0.9, 1), (0.8, 0), (0.4, 1), (0.1, 0), (0.6, 1)]
    df = spark.createDataFrame([("g", s, y) for s, y in rows], "g string, score double, label long")
    r = metrics.classification_report(df, ["g"]).first()
    assert (r["tp"], r["fp"], r["tn"], r["fn"]) == (2, 1, 1, 1)
    assert r["f1"] == pytest.approx(2 * r["precision"] * r["recall"] / (r["precision"] + r["recall"]))
    p = np.clip(np.array([s for s, _ in rows]), 1e-15, 1 - 1e-15)
    y = np.array([t for _, t in rows])
    assert r["log_loss"] == pytest.approx(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)), abs=1e-9)


def test_exact_percentile_multi_pass(spark):
    rnd = np.random.default_rng(5)
    vals = np.concatenate([rnd.normal(size=3000), np.full(500, 2.5), rnd.exponential(size=500) * 1e6])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    for q in (0.99, 0.5, 0.0, 1.0):
        n = len(vals)
        pos = q * (n - 1)
        s = np.sort(vals)
        lo, hi = s[int(np.floor(pos))], s[int(np.ceil(pos))]
        expect = lo + (hi - lo) * (pos - np.floor(pos))
        got = segments.exact_percentile(df, "x", q)[1]
        assert got == expect


def test_percentiles_of_extremes_ties_and_nulls(spark):
    rows = [(1.7e308, 5.0, None), (-1.7e308, 5.0, None), (None, 5.0, None)] + [(float(k % 7), 5.0, None) for k in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = segments.exact_percentiles(df, ["a", "b", "c"], 0.5, accuracy=10)
    assert got == {"a": (202, 3.0), "b": (203, 5.0), "c": (0, None)}
    top = segments.exact_percentiles(df, ["a"], 1.0)["a"]
    assert top == (202, 1.7e308)


def test_winsorised_values_keep_null_and_nan(spark):
    df = spark.createDataFrame([(k, float(k)) for k in range(101)] + [(900, None), (901, float("nan"))], "id int, x double")
    got = {r["id"]: r["x"] for r in segments.winsorize(df, ["x"], 0.9).collect()}
    assert got[900] is None and math.isnan(got[901])
    assert all(got[k] == min(k, 90.0) for k in range(101))


def test_report_of_null_empty_and_one_class_groups(spark):
    rows = [(None, 1, 0.9), (None, 0, 0.2), (None, 0, 0.9), ("a", 1, 0.4), ("a", 1, 0.7)]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    got = {r["g"]: r for r in metrics.classification_report(df, ["g"]).collect()}
    assert got[None]["roc_auc"] == 0.75 and got[None]["n"] == 3
    assert got["a"]["roc_auc"] is None and got["a"]["tp"] == 1 and got["a"]["fn"] == 1
    none = df.where("false")
    assert metrics.classification_report(none, ["g"]).count() == 0
    row = metrics.classification_report(none, []).first()
    assert row["n"] == 0 and row["roc_auc"] is None and row["f1"] is None


def test_running_total_over_one_large_group(spark):
    from kredo.operators import ranges
    df = spark.range(5000).selectExpr("if(id < 4900, 'hot', NULL) AS g", "id AS k", "id % 5 AS v")
    total = {"hot": 0, None: 0}
    for r in sorted(ranges.running_total(df, ["g"], "k", "v", "upto").collect(), key=lambda r: r["k"]):
        total[r["g"]] += r["v"]
        assert r["upto"] == total[r["g"]]
