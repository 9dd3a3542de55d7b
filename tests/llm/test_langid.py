import random

import numpy as np

from kredo.llm import langid
from tests.llm.tables import LONG, ROWS, awkward, nothing

WORDS = {"en": "the house with this and water think should there".split(),
         "de": "das haus mit nicht und wasser straße über schön".split(),
         "fr": "la maison avec cette être où français après déjà".split()}


def corpus(spark, n, seed):
    rng = random.Random(seed)
    rows = [(k, " ".join(rng.choices(WORDS[g], k=rng.randint(5, 200))), g) for k in range(n)
            for g in [rng.choice(sorted(WORDS))]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), {r[0]: r[2] for r in rows}


def test_held_out_accuracy_and_folds(spark):
    docs, truth = corpus(spark, 600, 1)
    net = langid.fit(docs)
    got = langid.predict(docs, net).collect()
    import zlib
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    assert len(held) > 100 and np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    odd = {(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(awkward(spark), net).collect()
           if r["doc_id"] in (4, 5, 9)}
    assert odd == {(4, "und", 0.0), (5, "und", 0.0), (9, "und", 0.0)}
    assert langid.predict(awkward(spark), net).count() == len(ROWS)
    assert langid.predict(nothing(spark), net).count() == 0


def test_without_labels_all_is_unknown(spark):
    assert langid.fit(nothing(spark)) is None
    assert {r["lang_pred"] for r in langid.predict(awkward(spark), None).collect()} == {"und"}


def test_tables_equal_the_filters():
    rng = np.random.default_rng(1)
    net = langid.Network(["a", "b"], rng.normal(size=(langid.N_CLASSES, langid.EMBED)),
                         {w: rng.normal(size=(w, langid.EMBED, langid.FILTERS)) for w in langid.WIDTHS},
                         rng.normal(size=len(langid.WIDTHS) * langid.FILTERS),
                         rng.normal(size=(len(langid.WIDTHS) * langid.FILTERS, 2)), rng.normal(size=2))
    windows = langid.windows_of("Der Fluß é " * 60)
    x = net.embed[np.concatenate((windows, np.zeros((len(windows), 3), int)), axis=1)]
    peaks = [sum(x[:, o:o + langid.WINDOW] @ net.filters[w][o] for o in range(w)).max(axis=1) for w in langid.WIDTHS]
    want = langid.log_softmax(np.maximum(np.concatenate(peaks, axis=1) + net.offset, 0) @ net.out + net.bias)
    assert np.allclose(net.log_probabilities(windows, net.tables()), want, atol=1e-3)


def test_windows_hold_every_byte():
    for text in (LONG, "é", "x" * langid.WINDOW, "x" * (langid.WINDOW + 1)):
        assert np.count_nonzero(langid.windows_of(text)) == len(text.encode())
