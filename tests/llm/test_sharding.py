import zlib
from collections import Counter

from kredo.llm import sharding
from tests.llm.tables import ROWS, awkward, nothing


def test_awkward_rows_are_all_placed_once(spark):
    out = [tuple(r) for r in sharding.kd_shards(awkward(spark), shards=4).collect()]
    size = lambda t: len((t or "").encode()) + 16
    assert Counter((i, s, c) for i, s, c, _, _ in out) == Counter(
        (r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in ROWS)
    for shard in {r[3] for r in out}:
        slots = sorted(r[4] for r in out if r[3] == shard)
        assert slots == list(range(len(slots)))


def test_empty_table_and_a_single_row(spark):
    assert sharding.kd_shards(nothing(spark), shards=5).count() == 0
    one = sharding.kd_shards(awkward(spark).where("doc_id = 1"), shards=5).collect()
    assert len(one) == 1 and one[0]["slot"] == 0


def test_shards_are_equal_to_the_nearest_row_and_follow_the_tree(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "repeat('x', int(pmod(id * 37, 90))) AS text",
                                        "pmod(id * 37, 90) AS n_chars", "'s' AS source", "'en' AS lang")
    out = sharding.kd_shards(docs, shards=8).groupBy("shard").sum("size").collect()
    sums = [r[1] for r in out]
    assert len(sums) == 8 and max(sums) - min(sums) <= 3 * 106


def test_one_hot_value_is_split_by_id(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'same text' AS text", "CAST(9 AS BIGINT) AS n_chars",
                                        "'hot' AS source", "'en' AS lang")
    out = sharding.kd_shards(docs, shards=7).groupBy("shard").count().collect()
    assert sorted(r[1] for r in out) == sorted([428] * 3 + [429] * 4)


def test_target_bytes_sets_the_count_and_wide_ids_do_not_overflow(spark):
    docs = spark.createDataFrame([(-(2 ** 63), "a"), (2 ** 63 - 1, "b"), (0, "c"), (5, None)], "doc_id long, text string")
    out = sharding.kd_shards(docs, target_bytes=34).collect()
    assert {r["doc_id"] for r in out} == {-(2 ** 63), 2 ** 63 - 1, 0, 5}
    assert len({r["shard"] for r in out}) == 2


def test_no_python_on_the_main_path(spark, capsys):
    out = sharding.kd_shards(awkward(spark), shards=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
