import random
import re
from collections import Counter

import numpy as np
import pytest

from kredo.llm import ngrams, quality_pu, quality_rules
from tests.llm.tables import LONG, ROWS, awkward, nothing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if runs[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def corpus(spark, n=400, seed=1):
    rng = random.Random(seed)
    words = "stone river harbour lantern winter garden copper silent meadow orchard the of and".split()
    docs, labels = [], []
    for k in range(n):
        body = rng.choices(words, k=rng.randint(30, 80))
        good = rng.random() < 0.7
        text = " ".join(body) + "." if good else " ".join(w + rng.choice(["$$$", "###", "%%%"]) for w in body)
        docs.append((k, text))
        labels.append((k, int(good)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, target int"), dict(docs), dict(labels))


def test_base_counts_on_awkward_and_random_texts():
    rng = random.Random(4)
    texts = [r[1] for r in ROWS] + [LONG, "a b c d e f g h " * 9, "x\ny\nx\n\n \nx", "\x1c \x85a\xa0b é😀 <|#>"]
    texts += ["".join(rng.choice("ab \n\t#|é") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    texts += [" ".join(rng.choices("ab", k=rng.randint(0, 60))) for _ in range(200)]
    model = quality_rules.Model(np.zeros(ngrams.DIMENSIONS), 0.0, 1.0, 9.0)
    for t in texts:
        assert quality_rules.judge(t, model, 0.5)[:6] == plain_counts(t)


def test_segments_change_nothing(monkeypatch):
    text = LONG[:20_000] + "\nsame line here\nsame line here\n"
    whole = (ngrams.words_of(text).hashes.tolist(), ngrams.sparse(text)[1].tolist(), quality_pu.features(text).tolist())
    monkeypatch.setattr(ngrams.segments, "__defaults__", (97,))
    parts = (ngrams.words_of(text).hashes.tolist(), ngrams.sparse(text)[1].tolist(), quality_pu.features(text).tolist())
    assert parts == whole


def test_scoring_equals_the_sparse_product():
    rng = np.random.default_rng(2)
    w = rng.normal(size=ngrams.DIMENSIONS)
    for r in ROWS:
        at, value = ngrams.sparse(r[1] or "")
        assert abs(ngrams.linear(r[1] or "", w) - float((w[at] * value).sum())) < 1e-4


def test_matrix_products():
    rng = np.random.default_rng(5)
    rows = [np.sort(rng.choice(ngrams.DIMENSIONS, k, replace=False)) for k in (0, 3, 7, 0, 1)]
    m = ngrams.Matrix.of(rows, [rng.normal(size=len(r)) for r in rows])
    w, r = rng.normal(size=ngrams.DIMENSIONS), rng.normal(size=5)
    dense = np.zeros((5, ngrams.DIMENSIONS))
    for k in range(5):
        dense[k, m.at[m.starts[k]:m.starts[k + 1]]] = m.value[m.starts[k]:m.starts[k + 1]]
    assert np.allclose(m.dot(w), dense @ w) and np.allclose(m.back(r), r @ dense)
    assert np.allclose(m.take(np.array([2, 0])).dot(w), dense[[2, 0]] @ w)


def test_rules_model_separates_and_is_calibrated(spark):
    docs, labels, texts, truth = corpus(spark)
    model = quality_rules.fit(docs, labels, sample=300)
    fresh_docs, _, _, fresh = corpus(spark, 200, seed=2)
    got = {r["doc_id"]: r for r in quality_rules.score(fresh_docs, model).collect()}
    assert np.mean([(got[k]["probability"] >= 0.5) == bool(fresh[k]) for k in fresh]) > 0.97
    assert abs(np.mean([got[k]["probability"] for k in fresh]) - np.mean(list(fresh.values()))) < 0.05
    kept = {r["doc_id"] for r in quality_rules.keep(fresh_docs, model).collect()}
    assert kept == {k for k in got if got[k]["kept"]}


def test_rules_on_awkward_rows_and_without_labels(spark):
    docs, labels, _, _ = corpus(spark, 40)
    for model in (quality_rules.fit(docs, labels), quality_rules.fit(docs, labels.where("target = 1")),
                  quality_rules.fit(docs, labels.where("false"))):
        out = quality_rules.score(awkward(spark), model).collect()
        assert len(out) == len(ROWS)
        assert all(r["base_failed"] and not r["kept"] for r in out if r["doc_id"] in (4, 5, 9, -3))
        kept = quality_rules.keep(awkward(spark), model)
        assert kept.columns == awkward(spark).columns
        assert quality_rules.score(nothing(spark), model).count() == 0 == quality_rules.keep(nothing(spark), model).count()
    none = quality_rules.score(awkward(spark), quality_rules.fit(docs, labels.where("false"))).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in none)


def test_sample_is_bounded_and_ignores_repeats(spark):
    docs, labels, _, _ = corpus(spark, 50)
    many = docs.union(docs).union(docs)
    assert ngrams.labelled_sample(many, labels.union(labels), 20).count() == 20
    assert ngrams.labelled_sample(docs, labels.withColumn("target", labels.target * 0 + None), 20).count() == 0


def test_pu_separates_without_seeing_a_negative(spark):
    docs, labels, _, _ = corpus(spark, 600)
    seen = []
    model = quality_pu.fit(docs, labels.where("target = 1"), sample=300)
    assert 0.55 < model.prior < 0.9
    fresh_docs, _, _, fresh = corpus(spark, 200, seed=3)
    got = {r["doc_id"]: r for r in quality_pu.score(fresh_docs, model).collect()}
    assert np.mean([got[k]["predicted"] == fresh[k] for k in fresh]) > 0.95 and not seen


def test_pu_fold_and_awkward_rows(spark):
    import zlib
    model = quality_pu.Model(np.zeros(quality_pu.DIMENSIONS), 0.0, 0.5)
    out = quality_pu.score(awkward(spark), model).collect()
    assert len(out) == len(ROWS) and all(r["score"] == 0.5 and r["predicted"] == 0 for r in out)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out if r["doc_id"] is not None)
    assert quality_pu.score(nothing(spark), model).count() == 0
    empty = quality_pu.fit(nothing(spark).select("doc_id", "text"),
                           spark.createDataFrame([], "doc_id long, target int"))
    assert empty.score("anything") == 0.5 == empty.score(None)


@pytest.mark.parametrize("share", [0.3, 0.6])
def test_prior_estimate(share):
    rng = np.random.default_rng(6)
    pos = rng.normal(1, 0.3, (600, 4))
    unl = np.where(rng.random((900, 1)) < share, rng.normal(1, 0.3, (900, 4)), rng.normal(-1, 0.3, (900, 4)))
    assert abs(quality_pu.estimate_prior(pos, unl) - share) < 0.08


def test_the_fit_uses_2400_labelled_rows(spark, monkeypatch):
    docs = spark.range(2600).selectExpr("id AS doc_id", "concat('text of row ', id, if(id % 3 = 0, ' #$ bad', ' good')) AS text")
    labels = docs.selectExpr("doc_id", "if(doc_id % 3 = 0, 0, 1) AS target")
    seen = {}
    logistic, platt = quality_rules.fit_logistic, quality_rules.calibrate
    monkeypatch.setattr(quality_rules, "fit_logistic", lambda x, y: seen.update(fitted=x.n) or logistic(x, y))
    monkeypatch.setattr(quality_rules, "calibrate", lambda margin, y: seen.update(held=len(y)) or platt(margin, y))
    quality_rules.fit(docs, labels)
    assert seen == {"fitted": 1600, "held": 800}
