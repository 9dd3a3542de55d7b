"""Property checks of the guarded casts against small Python models (hypothesis-generated inputs)."""

import math
import re

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kredo.functions import scalars as S

_NUM = re.compile(S.NUMERIC_TEXT, re.ASCII)      # as Java reads it

numeric_like = st.one_of(
    st.from_regex(r"\A\s?[+-]?[0-9]{1,12}(\.[0-9]{0,6})?([eE][+-]?[0-9]{1,3})?\s?\Z", fullmatch=True),
    st.from_regex(r"\A[+-]?\.[0-9]{1,5}\Z", fullmatch=True),
    st.sampled_from(["n/a", "", " ", "1,5", "1d", "2f", "NaN", "inf", "-Infinity", "0x10", "1e999", "--1", "1..2",
                     "١٢", "1 2", "+", "."]),
    st.text(alphabet="0123456789eE+-. dfxn/a", max_size=8),
)


def model_double(s):
    if s is None or not _NUM.match(s):
        return None
    v = float(s.strip())
    return v if math.isfinite(v) else None


@settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(numeric_like, min_size=60, max_size=60))
def test_safe_double_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r["i"]: r["v"] for r in df.select("i", S.safe_double(F.col("s")).alias("v")).collect()}
    for i, v in enumerate(values):
        assert got[i] == model_double(v), (v, got[i])


@settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64)),
                          st.one_of(st.none(), st.sampled_from([0.0, -0.0]),
                                    st.floats(allow_nan=False, allow_infinity=False, width=64))),
                min_size=60, max_size=60))
def test_safe_divide_matches_model(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a double, b double")
    got = {r["i"]: r["v"] for r in df.select("i", S.safe_divide("a", "b").alias("v")).collect()}
    for i, (a, b) in enumerate(pairs):
        if a is None or b is None or b == 0.0:
            want = None
        else:
            q = a / b if abs(b) > 0 else None
            want = q if q is not None and math.isfinite(q) else None
        assert got[i] == want, (a, b, got[i])


def model_register_date(s):
    import datetime as dt
    if s is None:
        return None
    t = s.strip(" ")
    m = re.fullmatch(r"([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})", t)
    if m:
        d, mo, y = map(int, m.groups())
    else:
        m = re.fullmatch(r"([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})", t)
        if not m:
            return None
        y, mo, d = map(int, m.groups())
    try:
        return dt.date(y, mo, d)
    except ValueError:
        return None


date_like = st.one_of(
    st.builds(lambda d, m, y: f"{d}-{m}-{y}", st.integers(0, 40), st.integers(0, 14), st.integers(1000, 2999)),
    st.builds(lambda d, m, y: f"{d:02d}-{m:02d}-{y}", st.integers(1, 31), st.integers(1, 12), st.integers(1900, 2100)),
    st.builds(lambda d, m, y: f"{y}-{m:02d}-{d:02d}", st.integers(1, 31), st.integers(1, 12), st.integers(1900, 2100)),
    st.sampled_from(["bad", "", "2023", "31/12/2020", "1-1-20", " 09-08-1960 "]),
)


@settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(date_like, min_size=60, max_size=60))
def test_register_dates_match_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r["i"]: r["v"] for r in df.select("i", S.dmy_to_date(F.col("s")).alias("v")).collect()}
    for i, v in enumerate(values):
        assert got[i] == model_register_date(v), (v, got[i])


def model_segment(a, r, f):
    from kredo.functions import codes
    a, r, f = a or 0.0, r or 0.0, f or 0.0
    if a < codes.INACTIVE_MAX and r < codes.INACTIVE_MAX:
        return "Inactive/Empty"
    if f == 0 and a > codes.HOLDING_MIN_ASSETS:
        return "Holding"
    if (a > codes.MICRO_LIMITS[0]) + (r > codes.MICRO_LIMITS[1]) + (f > codes.MICRO_LIMITS[2]) <= 1:
        return "Micro"
    if (a > codes.SME_LIMITS[0]) + (r > codes.SME_LIMITS[1]) + (f > codes.SME_LIMITS[2]) <= 1:
        return "SME"
    return "Large"


edges = [0.0, 999.0, 1000.0, 1001.0, 350000.0, 350001.0, 500000.0, 500001.0, 700000.0, 700001.0,
         4500000.0, 4500001.0, 9000000.0, 9000001.0]
money = st.one_of(st.none(), st.sampled_from(edges), st.floats(-1e7, 2e7, allow_nan=False))
fte = st.one_of(st.none(), st.sampled_from([0.0, 1.0, 10.0, 11.0, 50.0, 51.0]), st.floats(0, 100, allow_nan=False))


@settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(money, money, fte), min_size=60, max_size=60))
def test_company_segment_matches_model(spark, rows):
    df = spark.createDataFrame([(i, a, r, f) for i, (a, r, f) in enumerate(rows)], "i int, a double, r double, f double")
    got = {x["i"]: x["s"] for x in df.select("i", S.company_segment("a", "r", "f").alias("s")).collect()}
    for i, (a, r, f) in enumerate(rows):
        assert got[i] == model_segment(a, r, f), (a, r, f, got[i])


def model_label(solv, roa, liq):
    s = 1.0 if solv is None else solv
    r = 0.0 if roa is None else roa
    q = 1.0 if liq is None else liq
    if s < 0.0:
        return 1
    if s < 0.05 and r < 0.0:
        return 1
    if q < 1.0 and r < 0.0:
        return 1
    return 0


ratio = st.one_of(st.none(), st.sampled_from([-0.0, 0.0, 0.05, 0.0499, 1.0, 0.9999, -1e-9]),
                  st.floats(-3, 3, allow_nan=False))


@settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(ratio, ratio, ratio), min_size=60, max_size=60))
def test_risk_label_matches_model(spark, rows):
    from kredo.operators import label
    df = spark.createDataFrame([(i, a, b, c) for i, (a, b, c) in enumerate(rows)],
                               "i int, target_solvency_y3 double, target_roa_y3 double, target_liquidity_y3 double")
    got = {x["i"]: x["y"] for x in df.select("i", label.is_high_risk().alias("y")).collect()}
    for i, (a, b, c) in enumerate(rows):
        assert got[i] == model_label(a, b, c), (a, b, c, got[i])
