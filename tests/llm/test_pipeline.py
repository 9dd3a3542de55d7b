"""The stages on a small corpus whose right outcome is known."""

import random

import corpus_pipeline
from kredo.llm.common import fresh_path
from tests.llm.tables import awkward, nothing


def make(spark, folder):
    rng = random.Random(11)
    words = [f"{a}{b}" for a in "ka lo mi nu pe ra so ti vu".split() for b in "n r s t l m".split()]
    line = lambda n: " ".join(rng.choices(words, k=n))
    bench = [(k, line(30)) for k in range(5)]
    docs, labels = [], []
    for k in range(240):
        junk = k % 6 == 5
        text = " ".join(w + "$$$" for w in line(60).split()) if junk else line(60)
        docs.append((k, text))
        labels.append((k, 0 if junk else 1))
    docs += [(1000 + k, docs[k][1]) for k in (0, 1, 2)]
    docs += [(2000 + k, f"{line(30)} {bench[k][1]} {line(10)}") for k in range(5)]
    docs += [(3000, f"{line(40)} bob@example.com {line(10)}"), (3001, "too short")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return {i for i, t in docs if i < 240 and i % 6 != 5} | {3000}


def test_stages_take_out_what_they_should(spark):
    folder = fresh_path(spark, "corpus")
    clean = make(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.dtypes == docs.dtypes
            docs = out.checkpoint()
            seen[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert 3001 not in seen["quality rules"] and all(i % 6 != 5 for i in seen["quality rules"] if i < 240)
    assert not seen["SimHash near-dedup"] & {1000, 1001, 1002}
    assert seen["benchmark decontamination"] == seen["PII"] == clean
    row = docs.where("doc_id = 3000").first()
    assert "bob@" not in row["text"] and "[EMAIL]" in row["text"] and row["n_chars"] == len(row["text"])
    pieces = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == clean


def test_stages_on_awkward_and_empty_tables(spark):
    folder = fresh_path(spark, "corpus")
    make(spark, folder)
    for docs in (awkward(spark), nothing(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            assert name == "packing" or out.dtypes == docs.dtypes
            assert out.count() <= max(1, docs.count()) * 400
