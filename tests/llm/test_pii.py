import random
import re

import numpy as np
import pytest

from kredo.llm import crf, ngrams, pii
from tests.llm.tables import ROWS, awkward, nothing

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain(text):
    out = []
    for kind, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = (kind == 0 or kind == 1 and all(int(x) <= 255 for x in m.group().split("."))
                    or kind == 2 and 16 <= len(digits) <= 19 and pii.luhn(digits)
                    or kind == 3 and 8 <= len(digits) <= 15)
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("ab1234567890..@@-+() _%,") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text)[0] == plain(text), text
    card = "4111111111111111"
    assert pii.base_spans(f"x {card}1 {card}")[0] == plain(f"x {card}1 {card}")


@pytest.mark.parametrize("text", ["1" * 200_000, "1." * 100_000, "+" * 100_000, "+1 " * 50_000, "a@" * 50_000,
                                  "@a." * 50_000, "a" * 200_000 + "@", "1 " * 100_000])
def test_long_runs_take_linear_time(text):
    pii.base_spans(text)


@pytest.fixture(scope="module")
def tagger(spark):
    rng = random.Random(4)
    words = "the old mill by river was quiet and nobody came until late spring 12 7".split()
    rows = []
    for k in range(260):
        datum = rng.choice([f"u{rng.randint(10, 99)}@mail{rng.randint(1, 9)}.example.com",
                            ".".join(str(rng.randint(0, 255)) for _ in range(4)),
                            f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}",
                            "4111111111111111"])
        rows.append((k, " ".join(rng.choices(words, k=8)) + f" {datum} " + " ".join(rng.choices(words, k=8))))
    return pii.fit(spark.createDataFrame(rows, "doc_id long, text string"), sample=260)


def test_added_spans_leave_base_and_clean_text_alone(tagger):
    texts = [r[1] or "" for r in ROWS]
    for text, (base, added) in zip(texts, pii.scan(texts, tagger)):
        assert base == plain(text)
        for kind, a, b in added:
            assert all(b <= x or a >= y for _, x, y in base)
    clean = ["the old mill by the river was quiet", "nobody came until late spring " * 20]
    assert all(base == [] and added == [] for base, added in pii.scan(clean, tagger))


def test_reconciliation_takes_the_surest_and_nothing_that_overlaps():
    found = [(0.95, 3, 0, 10), (0.99, 3, 5, 14), (0.99, 0, 20, 30), (0.5, 0, 40, 60), (0.99, 2, 100, 110)]
    assert pii.reconcile(found, [(105, 106)]) == [(0, 20, 30), (3, 5, 14)] or \
        sorted(pii.reconcile(found, [(105, 106)])) == [(0, 20, 30), (3, 5, 14)]


def test_awkward_rows(spark, tagger):
    for model in (None, tagger):
        out = {r["doc_id"]: r for r in pii.find(awkward(spark), model).collect()}
        assert len(out) == 11 and pii.find(awkward(spark), model).count() == len(ROWS)
        assert [out[8][f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1]
        assert out[5]["spans"] == "" and out[5]["base_sha256"] == out[4]["base_sha256"]
    masked = pii.mask(awkward(spark), None)
    assert masked.columns == awkward(spark).columns
    row = masked.where("doc_id = 8").first()
    assert row["text"] == "mail [EMAIL] or call [PHONE], host [IP], card [CARD]" and row["n_chars"] == len(row["text"])
    assert masked.where("doc_id = 5").first()["text"] is None


def test_empty_table_and_no_labelled_spans(spark):
    assert pii.find(nothing(spark), None).count() == 0
    assert pii.mask(nothing(spark), None).count() == 0
    assert pii.fit(nothing(spark).select("doc_id", "text")) is None


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = crf.Tagger.fresh(5, 3, 4, seed=1)
    x, y = rng.integers(0, 5, (6, 3)), rng.integers(0, 4, (6, 3))

    def loss():
        e, _ = net.emissions(x)
        total = 0.0
        for b in range(3):
            score = net.first[y[0, b]] + e[0, b, y[0, b]]
            a = net.first + e[0, b]
            for t in range(1, 6):
                score += net.moves[y[t - 1, b], y[t, b]] + e[t, b, y[t, b]]
                a = e[t, b] + np.log(np.exp(a[:, None] + net.moves).sum(axis=0))
            total += np.log(np.exp(a).sum()) - score
        return total / 3

    for p, g in zip(net.params(), net.gradients(x, y)):
        for k in rng.choice(p.size, min(6, p.size), replace=False):
            old = p.flat[k]
            p.flat[k] = old + 1e-5
            up = loss()
            p.flat[k] = old - 1e-5
            down = loss()
            p.flat[k] = old
            assert abs((up - down) / 2e-5 - g.flat[k]) < 1e-5


def test_decoding_is_the_best_path_with_its_posteriors():
    rng = np.random.default_rng(3)
    net = crf.Tagger.fresh(5, 3, 3, seed=2)
    net.moves[...] = rng.normal(0, 1, (3, 3))
    x = rng.integers(0, 5, (4, 2))
    path, sure = net.decode(x)
    e, _ = net.emissions(x)
    from itertools import product
    for b in range(2):
        scores = {p: net.first[p[0]] + sum(e[t, b, p[t]] for t in range(4)) + sum(
            net.moves[p[t - 1], p[t]] for t in range(1, 4)) for p in product(range(3), repeat=4)}
        best = max(scores, key=scores.get)
        assert tuple(path[:, b]) == best
        z = sum(np.exp(s) for s in scores.values())
        for t in range(4):
            share = sum(np.exp(s) for p, s in scores.items() if p[t] == best[t]) / z
            assert abs(share - sure[t, b]) < 1e-9


def test_symbols_keep_letters_apart():
    assert pii.symbols_of("aZ9 \n").tolist() == [97, 122, 57, 32, 10]
    assert (pii.symbols_of("at é中") >= pii.ASCII).tolist() == [False, False, False, True, True]
    assert pii.symbols_of("é中\U0001f600").max() < pii.PAD


def test_pieces_that_go_through_an_overlap_become_one_span():
    w, step = pii.WINDOW, pii.STEP
    sees = lambda a, b, s: (0.9, 0, max(a, s), min(b, s + w), a < s, b > s + w)
    for a, b in ((10, 20), (10, w + 5), (step - 1, w + 1), (step + 1, w + 1), (5, step + w + 30), (0, 3 * w), (w - 1, w + 2)):
        length = 3 * w
        spans = [sees(a, b, s)[:4] + (a < s, b > s + w and s + w < length) for s in pii.window_starts(length)
                 if a < s + w and b > s]
        assert set(pii.joined(spans)) == {(0.9, 0, a, b)}, (a, b)
    # the next window does not agree: nothing is made up
    assert pii.joined([(0.9, 0, 5, w, False, True), (0.9, 1, step, w + 3, True, False)]) == []


def letters_only(spark):
    """Texts with e-mail addresses of letters only, and some without any; and sentences with such addresses spelled out."""
    rng = random.Random(7)
    words = "the old mill by river was quiet and nobody came until late spring we met at a bridge".split()
    name = lambda n: "".join(rng.choice("abdegiklmnoprstu") for _ in range(n))
    some = lambda: " ".join(rng.choices(words, k=9))
    docs = [(k, f"{some()} write to {name(5)}.{name(6)}@{name(7)}.com {some()}" if k % 3 else f"{some()} {some()} {some()}")
            for k in range(900)]
    spelled = []
    for k in range(90):
        value = f"{name(5)}.{name(6)}{('[at]', ' (at) ', ' at ')[k % 3]}{name(7)}.com"
        before = " ".join(some() for _ in range(k % 5)) + " write to "
        spelled.append((before + value + " " + some(), (0, len(before), len(before) + len(value))))
    return spark.createDataFrame(docs, "doc_id long, text string"), spelled


def test_spelled_out_emails_without_digit_or_at_sign_are_added(spark):
    docs, spelled = letters_only(spark)
    model = pii.fit(docs, sample=600)
    assert not any(re.search("[0-9@]", text) for text, _ in spelled)
    got = pii.scan([text for text, _ in spelled], model)
    for shape in range(3):
        hit = [span in added for (_, span), (_, added) in list(zip(spelled, got))[shape::3]]
        assert sum(hit) >= 27, (shape, sum(hit))                    # recall of 0.9 for each shape
    assert sum(len(added) for _, added in got) <= 95                # precision
    clean = [r["text"] for r in docs.where("doc_id % 3 = 0").collect()]
    assert sum(bool(added) for _, added in pii.scan(clean, model)) <= 3


def test_windows_cover_the_whole_text():
    for n in (0, 1, 47, 48, 49, 255, 256, 257, 463, 464, 465, 5000):
        starts = list(pii.window_starts(n))
        assert starts == [pii.STEP * k for k in range(len(starts))] and bool(starts) == (n > 0)
        assert not n or starts[-1] < n <= starts[-1] + pii.WINDOW


def test_quick_emissions_are_the_emissions():
    net = crf.Tagger.fresh(9, 5, 4, seed=3)
    x = np.random.default_rng(1).integers(0, 9, (20, 7))
    assert np.allclose(net.quick_emissions(x), net.emissions(x)[0], atol=1e-12)


def test_windows_left_out_of_the_search_have_no_tag():
    rng = np.random.default_rng(5)
    left = 0
    for seed in range(40):
        net = crf.Tagger.fresh(5, 3, 4, seed=seed)
        net.moves[...] = rng.normal(0, 1, (4, 4))
        net.bias[0] = rng.uniform(1, 6)
        x = rng.integers(0, 5, (12, 30))
        tags, sure = net.decode(x)
        at, some, some_sure = net.decode_tagged(x)
        assert set(np.flatnonzero(tags.any(axis=0))) <= set(at)
        assert (some == tags[:, at]).all() and np.allclose(some_sure, sure[:, at])
        left += 30 - len(at)
    assert left > 100
