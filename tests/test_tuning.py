import math
import random

from pyspark.sql import functions as F

from kredo.operators import models, tuning
from kredo.operators.tuning import Parzen, Range

SPACE = {"a": Range(0.0, 1.0), "b": Range(0.001, 1.0, log=True), "n": Range(1, 9, digits=0)}


def peak(values, share):
    return -(values["a"] - 0.3) ** 2 - (math.log10(values["b"]) + 1.0) ** 2 / 9 - (values["n"] - 6) ** 2 / 64 - 0.1 * (1 - share)


def test_ranges_hold_and_trials_repeat():
    a, b = (tuning.search(peak, SPACE, 30, seed=5) for _ in range(2))
    assert a == b and [t.number for t in a] == list(range(30))
    assert all(0 <= t.values["a"] <= 1 and 0.001 <= t.values["b"] <= 1 and t.values["n"] in range(1, 10) for t in a)
    assert tuning.search(peak, SPACE, 30, seed=6) != a


def test_proposals_beat_random_draws():
    found, drawn = [], []
    for seed in range(20):
        found.append(tuning.best(tuning.search(peak, SPACE, 40, seed=seed, share=1.0)).score)
        drawn.append(max(peak(tuning.propose([], SPACE, n, 1000 + seed, 0), 1.0) for n in range(40)))
    assert sum(found) > 0.6 * sum(drawn) and sum(f > d for f, d in zip(found, drawn)) >= 13


def test_poor_trials_end_early_and_the_best_is_a_full_one():
    calls = []

    def counted(values, share):
        calls.append(share)
        return peak(values, share)
    done = tuning.search(counted, SPACE, 40, seed=1)
    assert calls.count(0.25) == 40 and calls.count(1.0) == 20
    assert tuning.best(done).share == 1.0
    assert tuning.best(done).score == max(peak(t.values, 1.0) for t in done if t.share == 1.0)


def test_trials_without_a_score_rank_last():
    done = tuning.search(lambda v, s: None if v["n"] < 5 else peak(v, s), SPACE, 24, seed=2)
    assert tuning.best(done).values["n"] >= 5
    assert tuning.best(tuning.search(lambda v, s: None, SPACE, 5, seed=2)).score is None


def test_density_is_one_in_all():
    p = Parzen([[0.0, 0.5], [0.4, 1.0], [0.95, 0.2]])
    at = [(k + 0.5) / 150 for k in range(150)]
    assert abs(sum(p.density([x, y]) for x in at for y in at) / len(at) ** 2 - 1) < 1e-3
    rng = random.Random(1)
    assert all(0 <= x <= 1 for _ in range(500) for x in p.draw(rng, 2))


def test_search_on_planted_rows(spark, monkeypatch):
    from pyspark.ml.feature import VectorAssembler
    rows = spark.range(1500).select("*", *[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(1000)) / 1000.0).alias(c) for c in "xyz"])
    rows = rows.withColumn(models.LABEL, ((F.col("x") > 0.7) != (F.col("y") > 0.6)).cast("int")).withColumn(models.WEIGHT, F.lit(1.0))
    rows = rows.withColumn(models.VALID, F.pmod(F.col("id"), F.lit(5)) == 0)
    ready = VectorAssembler(inputCols=["x", "y", "z"], outputCol="features").transform(rows).checkpoint()
    monkeypatch.setattr(models, "vectors", lambda train: ([ready], ["x", "y", "z"]))
    (n, a), (m, b) = (models.search_tpe(rows, trials=4, seed=3, max_iter=8) for _ in range(2))
    assert n == m and a.collect() == b.collect()
    best = a.where(F.col("trial") == n).first()
    assert best["max_iter"] == 8 and best["roc_auc"] > 0.9
