import duckdb
import numpy as np
from pyspark.sql import functions as F

from kredo.llm import hard_negatives, lemp
from kredo.llm.queries import ORACLE, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, extra string"


def brute(rows, every=5, positives=5, negatives=3):
    """rows: vec_id, whole-number vector, label."""
    out = set()
    for a, v, label in rows:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m == label) for i, w, m in rows if i != a)
        for s, i, _ in [x for x in scored if x[2]][:positives]:
            good = [(-t, j) for t, j, same in scored if not same and 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out |= {(a, i, k + 1, j, -s, t) for k, (t, j) in enumerate(good)}
    return out


def mined(spark, rows, every=5):
    df = spark.createDataFrame([(i, [float(x) for x in v] if v is not None else None, m, "c") for i, v, m in rows], SCHEMA)
    return {tuple(r) for r in hard_negatives.mine(hard_negatives.usable(df), F.col("vec_id") % every == 0).collect()}


def made(n, dim, seed, kind):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    out = []
    for i in range(n):
        v = centres[rng.integers(4)] + rng.normal(size=dim) * (0.3 if kind == "groups" else 2)
        v *= rng.choice([0.01, 1, 30]) if kind == "lengths" else 1
        if kind == "copies" and i % 3:
            v = centres[0]
        out.append((i, np.float32(v), int(rng.integers(3))))
    return out


def whole(rows):
    return [(i, [int(np.floor(256 * float(x))) for x in v], m) for i, v, m in rows]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET", 32)
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    for seed, kind in enumerate(("groups", "lengths", "copies")):
        rows = made(240, 8, seed, kind)
        want = brute(whole(rows))
        assert want and mined(spark, rows) == want


def test_awkward_rows_take_no_part_or_are_defined(spark):
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.4], 1), (2, [0.7, 0.2], 2), (3, [0.6], 2), (4, None, 1), (5, [0.0, 0.0], 1),
            (6, [1.0, float("nan")], 2), (7, [float("inf"), 1.0], 2), (None, [0.7, 0.2], 2), (8, [0.7, 0.2], None),
            (9, [], 2), (2, [0.7, 0.2], 2), (10, [-1.0, -0.5], 1)]
    kept = [(i, list(v) + [0.0] * (2 - len(v)), m) for i, v, m in rows if i in (0, 1, 2, 3, 5, 9, 10)][:7]
    kept = list({i: (i, v, m) for i, v, m in kept + [(9, [0.0, 0.0], 2), (10, [-1.0, -0.5], 1)]}.values())
    assert mined(spark, rows) == brute(whole(kept))
    with_null = spark.createDataFrame([(0, [1.0, None], 1, "c"), (1, [1.0, 1.0], 1, "c")], SCHEMA)
    assert hard_negatives.usable(with_null).count() == 1
    assert mined(spark, rows[4:5]) == set()


def test_values_beyond_doubles_are_exact(spark):
    big = float(1 << 22)
    rows = [(0, [big, 1.0], 1), (1, [big, 0.5], 1), (2, [big * 0.875, 0.25], 2), (3, [big * 0.875, 0.25 + 1 / 256], 2)]
    assert mined(spark, rows) == brute(whole(rows)) != set()


def test_no_row_above_the_bound_is_pruned():
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(size=(300, 12)) * rng.choice([1, 40, 900], (300, 1))).astype(np.int64)
    ids, labels = np.arange(300), np.zeros(300, np.int64)
    b, q = lemp.Bucket(v, ids, labels), lemp.Queries(v[:60], ids[:60], labels[:60])
    full = v[:60] @ v.T
    pruned = 0
    for share in (1.0, 0.9, 0.5, 0.0, -0.5):
        bounds = full.max(axis=1) * share
        got = {(k, int(i)) for k, rows, _ in q.hits(b, bounds, True) for i in rows}
        assert got == {(k, i) for k in range(60) for i in range(300) if i != k and full[k, i] >= bounds[k]}
        alive, first, last = b.feasible(q.units, q.focus, q.lengths, bounds)
        pruned += sum(300 - b.candidates(q.focus[k], first[k], last[k]).size if alive[k] else 300 for k in range(60))
    assert pruned > 30 * 300                                # the ranges do cut


def test_the_query_equals_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = con.execute(ORACLE["op11_lemp_hard_negatives"]).fetchall()
    got = QUERIES["op11_lemp_hard_negatives"](spark, sf_dir)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


def test_blocks_and_buckets_are_never_broadcast(spark):
    rows = hard_negatives.usable(spark.range(60).selectExpr("id AS vec_id", "array(float(id % 7), float(id % 5)) AS embedding",
                                                            "int(id % 3) AS label"))
    packed = hard_negatives.buckets(rows, 3)
    pairs = hard_negatives.met(hard_negatives.blocks(rows, 60), packed, 3)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
