import numpy as np
import pytest

from kredo.llm import token_store, tokens
from kredo.llm.common import fresh_path
from tests.llm.tables import ROWS, awkward, nothing

ENCODE, TAIL = tokens.encoder(tokens.default_path()), tokens.end_bytes(2)


def test_round_trip_order_and_starts(spark):
    path = fresh_path(spark, "t")
    token_store.write_store(awkward(spark), path, block_ids=50, partitions=3)
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in token_store.read_store(spark, path).collect()))
    docs = sorted(((r[0] is not None, r[0] or 0) for r in ROWS))
    assert [(d is not None, d or 0) for _, d, _, _ in got] == docs
    at = 0
    for start, _, n, ids in got:
        assert start == at and len(ids) == 4 * n
        at += n
    assert sorted(ids for _, _, _, ids in got) == sorted(ENCODE.ids(r[1]) + TAIL for r in ROWS)


def test_single_documents_are_found_through_the_index(spark):
    path = fresh_path(spark, "t")
    token_store.write_store(awkward(spark), path, block_ids=50, partitions=3)
    found = token_store.read_documents(spark, path, [6, 8, 5, 12345])
    assert found[6] == [ENCODE.ids(ROWS[6][1]) + TAIL]
    assert found[8] == [ENCODE.ids(ROWS[8][1]) + TAIL] * 2
    assert found[5] == [TAIL] and 12345 not in found


def test_empty_store(spark):
    path = fresh_path(spark, "t")
    token_store.write_store(nothing(spark), path)
    assert token_store.read_store(spark, path).count() == 0


def test_another_dictionary_is_refused():
    block = token_store.build_block([(1, 1, 4, TAIL)], b"a" * 32)
    with pytest.raises(ValueError):
        token_store.Block(block, b"b" * 32)


def test_wide_ids_keep_four_bytes():
    ids = np.asarray([70000, 1], "<u4").tobytes()
    data, width = token_store.narrow(ids)
    assert width == 4 and token_store.widen(data, width) == ids
    assert token_store.widen(*token_store.narrow(TAIL)) == TAIL


def test_a_frequent_id_and_a_frequent_row_lie_in_several_shards(spark):
    from pyspark.sql import functions as F
    docs = spark.range(4000).select(F.lit(5).cast("long").alias("doc_id"), F.when(F.col("id") < 2000, "same").otherwise(
        F.concat(F.lit("word "), "id")).alias("text"))
    path = fresh_path(spark, "t")
    token_store.write_store(docs, path, partitions=8)
    shards = spark.read.parquet(f"{path}/blocks").groupBy("shard").sum("n_docs").collect()
    assert len(shards) >= 6 and max(r[1] for r in shards) < 1500
    got = token_store.read_store(spark, path).collect()
    assert len(got) == 4000 and sum(bytes(r["ids"]) == ENCODE.ids("same") + TAIL for r in got) == 2000
