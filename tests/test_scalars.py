import datetime as dt

from pyspark.sql import functions as F

from kredo.functions import scalars as S


def _one(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_safe_double_edge_cases(spark):
    vals = ["n/a", "", " 1 ", "1,5", "1e3", "1d", "NaN", "inf", "-12", "+.5", None]
    assert _one(spark, S.safe_double, vals) == [None, None, 1.0, None, 1000.0, None, None, None, -12.0, 0.5, None]


def test_safe_date_rejects_year_only(spark):
    assert _one(spark, S.safe_date, ["2023-12-31", "2023", "bad", None, "2023-2-5"]) == [
        dt.date(2023, 12, 31), None, None, None, dt.date(2023, 2, 5)]


def test_register_dates(spark):
    got = _one(spark, S.dmy_to_date, ["09-08-1960", "9-8-1960", "1960-08-09", "bad", None])
    assert got == [dt.date(1960, 8, 9)] * 3 + [None, None]


def test_safe_divide(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (None, 1.0), (6.0, 3.0), (1e308, 1e-10)], "a double, b double")
    got = [r[0] for r in df.select(S.safe_divide("a", "b")).collect()]
    assert got == [None, None, None, 2.0, None]      # overflow to inf becomes NULL


def test_model_rank_and_category(spark):
    vals = ["m02-f", "m02", "m81-x", "m87", "m121-f", None, "zz"]
    assert _one(spark, S.model_rank, vals) == [1, 1, 2, 3, 4, 4, 4]
    cats = _one(spark, S.model_category, vals)
    assert cats[0] == "Full Model (With Capital)" and cats[4] == "Consolidated Annual Accounts"
    assert cats[5] == cats[6] == "Specific/Sector Model (e.g., Financial/Healthcare)"


def test_clean_number_is_literal(spark):
    assert _one(spark, S.clean_number, ["0123.456.789", "0123456789", None]) == ["0123456789", "0123456789", None]


def test_company_segment_thresholds_are_strict(spark):
    rows = [
        (999.0, 999.0, 5.0),            # inactive
        (1000.0, 0.0, 0.0),             # not inactive (strict), holding needs > 500000 -> micro
        (500001.0, 0.0, None),          # holding (fte NULL -> 0)
        (350000.0, 700000.0, 10.0),     # all at the limit: micro
        (350001.0, 700001.0, 10.0),     # two over micro limits: sme
        (4500001.0, 9000001.0, 51.0),   # all over: large
        (None, None, None),             # inactive
    ]
    df = spark.createDataFrame(rows, "a double, r double, f double")
    got = [x[0] for x in df.select(S.company_segment("a", "r", "f")).collect()]
    assert got == ["Inactive/Empty", "Micro", "Holding", "Micro", "SME", "Large", "Inactive/Empty"]


def test_growth_uses_absolute_previous_value(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, -5.0), (None, 1.0), (3.0, 2.0)], "y2 double, y1 double")
    assert [r[0] for r in df.select(S.growth("y2", "y1")).collect()] == [None, 3.0, None, 0.5]


def test_failed_flag(spark):
    assert _one(spark, S.failed_flag, ["010", "051", "000", None]) == [1, 1, 0, 0]


def test_safe_double_of_whole_numbers_is_that_of_the_pattern(spark):
    """Whole numbers take the short way, all other texts the pattern: the same values and the same NULLs."""
    from pyspark.sql import functions as F
    from kredo.functions.scalars import NUMERIC_TEXT, finite_or_null, safe_double
    texts = ["0", "7", "-12", "+5", "007", "-0", " 5", "5 ", "\t5", "5\x01", "\x7f5", "1.5", ".5", "5.", "1e3", "1d", "0x1p3", "", " ", "-", ":",
             "9007199254740993", "9223372036854775807", "9223372036854775808", "-9223372036854775808", "1e400", "NaN", "Infinity", "n/a", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    slow = finite_or_null(F.when(F.col("t").rlike(NUMERIC_TEXT), F.trim("t").try_cast("double")))
    rows = df.select("t", safe_double("t").alias("got"), slow.alias("want")).collect()
    assert [(r.t, str(r.got)) for r in rows] == [(r.t, str(r.want)) for r in rows]
    plan = df.select(safe_double("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "as bigint" in plan
