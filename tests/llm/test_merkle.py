import hashlib
import zlib

from kredo.llm import merkle
from pyspark.sql import functions as F
from tests.llm.tables import awkward, nothing


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def part(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, text):
    return h(*[part(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])


def climb(nodes):
    """Levels of a tree, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(*now[k:k + 16]) for k in range(0, len(now), 16)])
    return levels


def beside(levels, place):
    out = []
    for nodes in levels[:-1]:
        a = place // 16 * 16
        out += [(place - a, nodes[a:a + 16])]
        place //= 16
    return out


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded) of every row, one at a time."""
    null_first = lambda v: (v is not None, v if not isinstance(v, str) else v.encode())
    sources = sorted({r["source"] for r in rows}, key=null_first)
    trees = {}
    for s in sources:
        mine = sorted(((null_first(r["doc_id"]), leaf_of(r, r["text"]), r) for r in rows if r["source"] == s),
                      key=lambda x: x[:2])
        trees[s] = ([r for _, _, r in mine], climb([leaf for _, leaf, _ in mine]))
    top = climb([trees[s][1][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        mine, levels = trees[s]
        for place, r in enumerate(mine):
            way = beside(levels, place) + beside(top, k)
            proof = h(*[x for at, run in way for n, x in enumerate(run) if n != at])
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now = leaf_of(r, text)
            for at, run in way:
                now = h(*run[:at], now, *run[at + 1:])
            out.append((r["doc_id"], levels[0][place], levels[-1][0], top[-1][0], proof, now))
    return out


def check(docs):
    got = merkle.manifest(docs).collect()
    want = plain_manifest(docs.collect())
    key = lambda t: tuple(str(v) for v in t)
    assert sorted((tuple(r[:6]) for r in got), key=key) == sorted(want, key=key)
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in got)
    return got


def test_awkward_rows_against_one_at_a_time(spark):
    check(awkward(spark))


def test_nothing_and_a_single_row(spark):
    assert merkle.manifest(nothing(spark)).count() == 0
    one = check(awkward(spark).where("doc_id = 1"))[0]
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == h()


def test_one_source_and_many_sources_of_uneven_depth(spark):
    rows = spark.range(700).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text No "), "id").alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 21).cast("string"))).alias("source"),
        F.col("id").alias("n_chars"))
    got = check(rows)
    assert {r["doc_id"] for r in got if not r["verified"]} == {i for i in range(700) if zlib.crc32(str(i).encode()) % 5 == 0}
    check(rows.where("source = 'hot'"))
    check(rows.withColumn("source", F.col("doc_id").cast("string")))       # lone leaves only


def test_a_repeated_row_is_a_leaf_each_time_and_a_change_shows(spark):
    rows = spark.range(40).select(F.lit(5).cast("long").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"),
                                  F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    assert len(check(rows)) == 40
    text = rows.withColumn("text", F.lit("y"))
    assert merkle.manifest(text).first()["root"] != merkle.manifest(rows).first()["root"]


def test_the_whole_table(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))
