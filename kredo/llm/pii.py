"""Personal data: exact base rules, and a character BiLSTM-CRF that adds what they miss.

The tagger is trained in numpy from labelled spans: the base spans of a bounded sample of documents,
some of them rewritten in a shape that the rules do not know (a phone without its plus, a spelled-out
at sign, a grouped card number), and from windows of documents without a number or an at sign.  Every
character of ASCII is a symbol of its own (A-Z as a-z), others are a symbol by their class.

Every whole text is scanned, in overlapping windows that are all decoded.  Their spans are reconciled over
the whole text: a span that a window's edge cuts, and that goes through the overlap, is joined with the
next window's piece of the same kind; one that begins in the overlap is left to the next window.  Spans
are taken by falling certainty where nothing overlaps them.  A span is added if all its characters are
certain enough and it touches neither a base span nor a number that a base rule has refused.

Defined results: a null or empty text has no span; repeated rows are scanned each; without labelled
spans there is no tagger and the base spans are all; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kredo.llm import crf, ngrams
from kredo.llm.common import among_lowest, arrow_rows, id_and_text

KINDS = ("email", "ip", "card", "phone")
#: Documents whose base spans train the tagger at most, and windows of each.
SAMPLE, WINDOWS_PER_DOC = 1000, 2
#: For each of them, documents without a digit or an at sign.
PLAIN_SHARE = 0.25
#: Characters of a training window.
TRAINED = 96
#: Characters of a window that is decoded, and from one start to the next.
WINDOW, STEP = 256, 224
#: Posterior probability that every character of an added span must reach.
CERTAIN = 0.9
#: Windows decoded together.
TOGETHER = 768
#: Digits from which a refused card number bars added spans.
REFUSED_DIGITS = 12

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")

Span = tuple[int, int, int]      # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str):
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            done = m.end()
            yield start, done


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Base spans by kind and start, and the matches that the rules refused."""
    found: list[Span] = []
    refused = []
    if "@" in text:
        found += [(0, a, b) for a, b in emails(text)]
    if not re.search("[0-9]", text):
        return found, refused
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((1, m.start(), m.end()))
        else:
            refused.append(m.span())
    for m in _CARD.finditer(text):
        if m.end() - m.start() < REFUSED_DIGITS:
            continue
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
        elif len(digits) >= REFUSED_DIGITS:
            refused.append(m.span())
    for m in _PHONE.finditer(text):
        if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
            found.append((3, m.start(), m.end()))
        else:
            refused.append(m.span())
    return found, refused


# ---- windows and tags ------------------------------------------------------------------------

ASCII = 128
PAD = ASCII + ngrams.N_CLASSES
TAGS = 1 + 2 * len(KINDS)        # outside; begin and inside of each kind
_LOWER = np.arange(ASCII, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def symbols_of(text: str) -> np.ndarray:
    """The symbol of each character: ASCII as itself (A-Z as a-z), else by its class."""
    codes = ngrams.codes_of(text)
    plain = codes < ASCII
    out = _LOWER[np.where(plain, codes, 0)]
    if not plain.all():
        out[~plain] = ASCII + ngrams.classes_of(codes[~plain])
    return out


def window_starts(length: int) -> range:
    """Starts of the overlapping windows of a whole text."""
    return range(0, max(length - (WINDOW - STEP), min(length, 1)), STEP)


def padded(parts: list[np.ndarray], width: int) -> np.ndarray:
    """Windows as rows of ``width`` symbols."""
    out = np.full((len(parts), width), PAD, np.int64)
    for row, part in zip(out, parts):
        row[:len(part)] = part
    return out


def tags_of(n: int, spans: list[Span]) -> np.ndarray:
    out = np.zeros(n, np.int64)
    for kind, a, b in spans:
        out[a:b] = 2 + 2 * kind
        out[a] = 1 + 2 * kind
    return out


def reshaped(kind: int, value: str, turn: int) -> str:
    """The same datum in a shape that the base rules do not know."""
    if kind == 0:
        return value.replace("@", (" at ", "[at]", " at ", " (at) ")[turn % 4])
    if kind == 2:
        digits = re.sub("[^0-9]", "", value)
        return (".", "/")[turn % 2].join(digits[k:k + 4] for k in range(0, len(digits), 4))
    if kind == 3:
        bare = re.sub(r"^\+[0-9]{1,3}[\x20.-]*", "", value)
        return bare if turn % 2 else bare.replace(") ", ")-").replace("-", ".")
    return value


def training_windows(doc_id: int, text: str):
    """(part, kind:start:end,...) of at most WINDOWS_PER_DOC windows around a text's data, around a number or at
    sign that is none if there are none, or anywhere without those; every second datum is reshaped."""
    spans, _ = base_spans(text)
    if spans:
        middles = [(a + b) // 2 for _, a, b in spans]
    else:
        middles = [m.start() for m in _TRIGGER.finditer(text or "")] or [*range(TRAINED // 2, len(text or ""), TRAINED)]
    if not middles:
        return
    for k in sorted({(len(middles) - 1) * k // max(1, WINDOWS_PER_DOC - 1) for k in range(WINDOWS_PER_DOC)}):
        start = max(0, middles[k] - TRAINED // 2 + ((doc_id or 0) * 7 + k) % 41 - 20)
        taken, last = [], start
        for kind, a, b in sorted(spans, key=lambda s: s[1]):
            if a >= last and b <= start + TRAINED:
                taken.append((kind, a, b))
                last = b
        part, out, at = "", [], start
        for n, (kind, a, b) in enumerate(taken):
            value = text[a:b]
            turn = (doc_id or 0) + n
            if turn % 2 == 0:
                value = reshaped(kind, value, turn // 2)
            part += text[at:a]
            out.append((kind, len(part), len(part) + len(value)))
            part += value
            at = b
        part = (part + text[at:start + TRAINED])[:TRAINED]
        yield part, ",".join(f"{k}:{a}:{b}" for k, a, b in out if b <= len(part))


def fit(docs: DataFrame, sample: int = SAMPLE) -> crf.Tagger | None:
    """docs: doc_id, text.  Trained on windows of the ``sample`` documents with the smallest hash of id and length
    that hold a digit or an at sign, and of ``PLAIN_SHARE`` as many that hold none (fewer where those with a
    hash in the lowest stretch, which holds four times as many on average, are fewer); cut on the executors."""
    schema = pa.schema([("part", pa.string()), ("spans", pa.string())])

    def run(batches):
        yield from arrow_rows((w for batch in batches for i, t in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist()) for w in training_windows(i, t)), schema)

    docs = docs.where("text IS NOT NULL")
    # one pass for the least hashes of both kinds, one for the texts that have them
    held, h = F.col("text").rlike("[0-9@]"), F.xxhash64("doc_id", F.octet_length("text"))
    sizes = {True: sample, False: int(PLAIN_SHARE * sample)}
    share = {k: 4 * n / max(1, docs.count()) for k, n in sizes.items()}
    low = docs.select(held.alias("held"), h.alias("h")).where(F.when(F.col("held"), among_lowest(F.col("h"), share[True])).otherwise(
        among_lowest(F.col("h"), share[False])))
    order = F.shiftrightunsigned("h", 1)
    nth = F.row_number().over(Window.partitionBy("held").orderBy(order))
    last = {r["held"]: r["most"] for r in low.withColumn("nth", nth).where(
        F.col("nth") <= F.when(F.col("held"), sizes[True]).otherwise(sizes[False])).groupBy("held").agg(F.max(order).alias("most")).collect()}
    key = F.shiftrightunsigned(h, 1)
    least = F.when(held, key <= last.get(True, -1)).otherwise(key <= last.get(False, -1))
    chosen = docs.where(least).orderBy(key, "doc_id").limit(sum(sizes.values())).select("doc_id", "text")
    got = chosen.mapInArrow(run, "part string, spans string").toPandas().sort_values(["part", "spans"])
    if not got["spans"].str.len().sum():
        return None
    x = padded([symbols_of(p) for p in got["part"]], TRAINED)
    y = np.stack([np.pad(tags_of(len(p), [tuple(map(int, s.split(":"))) for s in spans.split(",") if s]),
                         (0, TRAINED - len(p))) for p, spans in zip(got["part"], got["spans"])])
    return crf.train(x, y, PAD + 1, TAGS)


def window_spans(tags: np.ndarray, sure: np.ndarray, start: int, length: int):
    """(certainty, kind, start, end, cut on the left, cut on the right) of a window's spans; cut are those that
    touch an edge inside the text."""
    tags = tags.tolist()
    n = min(WINDOW, length - start)
    t = 0
    while t < n:
        if tags[t] == 0:
            t += 1
            continue
        kind, end = (tags[t] - 1) // 2, t + 1
        while end < n and tags[end] == 2 + 2 * kind:
            end += 1
        yield float(sure[t:end].min()), kind, start + t, start + end, t == 0 and start > 0, end == n and start + n < length
        t = end


def joined(spans: list[tuple]) -> list[tuple]:
    """(certainty, kind, start, end) of whole spans: pieces that go through an overlap become one where the next
    window's piece is of the same kind; a piece that begins or ends in an overlap is seen whole by one window."""
    at_left = {(kind, a): (p, b, right) for p, kind, a, b, left, right in spans if left}
    out = []
    for p, kind, a, b, left, right in spans:
        if left:
            continue
        while right:
            seam = b - WINDOW + STEP                       # where the next window begins
            other = at_left.get((kind, seam)) if a <= seam else None
            if other is None:
                break
            p, b, right = min(p, other[0]), other[1], other[2]
        if not right:
            out.append((p, kind, a, b))
    return out


def reconcile(found: list[tuple], barred: list[tuple[int, int]]) -> list[Span]:
    """The added spans of a text: by falling certainty, none that overlaps another or a barred stretch."""
    taken = sorted(barred)
    out = []
    for p, kind, a, b in sorted(set(found), key=lambda f: (-f[0], f[2], f[3], f[1])):
        if p >= CERTAIN and b - a >= 6 and all(b <= x or a >= y for x, y in taken):
            taken.append((a, b))
            out.append((kind, a, b))
    return out


def scan(texts: list[str], tagger: crf.Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """(base, added) spans of each text."""
    based = [base_spans(t) for t in texts]
    found: list[list] = [[] for _ in texts]
    if tagger is not None:
        symbols = [symbols_of(t) for t in texts]
        # windows of like length go together, so that few symbols are padding
        jobs = sorted(((k, s) for k, t in enumerate(texts) for s in window_starts(len(t))),
                      key=lambda j: min(WINDOW, len(texts[j[0]]) - j[1]))
        for at in range(0, len(jobs), TOGETHER):
            part = jobs[at:at + TOGETHER]
            width = min(WINDOW, len(texts[part[-1][0]]) - part[-1][1])
            x = np.ascontiguousarray(padded([symbols[k][s:s + WINDOW] for k, s in part], width).T)
            at_part, tags, sure = tagger.decode_tagged(x)
            for j in np.flatnonzero(tags.any(axis=0)):
                k, s = part[at_part[j]]
                found[k] += window_spans(tags[:, j], sure[:, j], s, len(texts[k]))
    return [(base, reconcile(joined(f), [(a, b) for _, a, b in base] + refused)) for (base, refused), f in zip(based, found)]


def grouped(batches, column: int, size: int = 4 << 20):
    """(rows, texts) of bounded characters: rows are (batch, position)."""
    rows, texts, n = [], [], 0
    for batch in batches:
        for k, text in enumerate(batch.column(column)):
            text = text.as_py() or ""
            rows.append((batch, k))
            texts.append(text)
            n += len(text)
            if n >= size or len(rows) >= 2048:
                yield rows, texts
                rows, texts, n = [], [], 0
    yield rows, texts


def spell(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
          "n_added long")


def find(docs: DataFrame, tagger: crf.Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: base counts by kind, the base spans' digest, all spans, and how many the tagger added."""
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS),
                        ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])

    def run(batches):
        def out():
            for rows, texts in grouped(batches, 1):
                for (batch, k), (base, added) in zip(rows, scan(texts, tagger)):
                    counts = [sum(s[0] == kind for s in base) for kind in range(len(KINDS))]
                    yield (batch.column(0)[k].as_py(), *counts, hashlib.sha256(spell(base).encode()).hexdigest(),
                           spell(base + added), len(added))
        yield from arrow_rows(out(), schema, weigh=lambda r: len(r[6]))

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, tagger: crf.Tagger | None, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with all spans masked in the text, and the length column (if there is one) brought up to date."""
    at = docs.columns.index(text_col)
    length = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            changed = {}
            for rows, group in grouped([batch], at):
                for (_, k), text, (base, added) in zip(rows, group, scan(group, tagger)):
                    if base or added:
                        changed[k] = masked(text, base + added)
            if changed:
                columns = list(batch.columns)
                columns[at] = pa.array([changed.get(k, t) for k, t in enumerate(texts)], batch.schema.field(at).type)
                if length is not None:
                    old = columns[length].to_pylist()
                    columns[length] = pa.array([len(changed[k]) if k in changed else n for k, n in enumerate(old)],
                                               batch.schema.field(length).type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return docs.mapInArrow(run, docs.schema)
