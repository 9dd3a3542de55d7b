"""Hot keys: one enterprise-year holding a third of all filings, and a hot NULL enterprise."""

from pyspark.sql import functions as F

from helpers import empty_dims
from kredo.operators import accounts, staging
from kredo.sources import schemas


def _filings(spark, n=30000):
    """n filings; ids % 3 == 0 belong to enterprise HOT in 2022, ids % 3 == 1 have no enterprise number."""
    r = spark.range(n).select(
        F.format_string("R%07d", "id").alias("ReferenceNumber"),
        F.when(F.col("id") % 3 == 0, F.lit("0999.999.999"))
         .when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
         .otherwise(F.format_string("0%03d.%03d.%03d", F.expr("id div 1000000 % 1000"),
                                    F.expr("id div 1000 % 1000"), F.col("id") % 1000)).alias("EnterpriseNumber"),
        F.lit("2022-12-31").alias("EndDate"),
        F.when(F.col("id") % 7 == 0, F.lit("m02-f")).otherwise(F.lit("m07-f")).alias("ModelType"),
        F.lit("NL").alias("Language"),
        F.array(F.struct(F.lit("70").alias("Code"), F.lit("N").alias("Period"),
                         (F.col("id") % 1000).cast("string").alias("Value"))).alias("Rubrics"),
        F.lit(2022).cast("bigint").alias("filing_year"))
    rest = [F.lit(None).cast("string").alias(c) for c in schemas.FILING_FIELDS if c not in r.columns]
    return r.select(*r.columns, *rest).select(*schemas.FILING_FIELDS, "Rubrics", "filing_year")


def test_hot_enterprise_and_null_key(spark):
    f = _filings(spark)
    p = staging.preferred_with_financials(f)
    rows = {r["EnterpriseNumber"]: r for r in p.where(
        F.col("EnterpriseNumber").isNull() | (F.col("EnterpriseNumber") == "0999.999.999")).collect()}
    # Best model rank (m02: id % 7 == 0), then the lowest reference number.
    assert rows["0999.999.999"]["ReferenceNumber"] == "R0000000"         # id 0: hot and m02
    assert rows[None]["ReferenceNumber"] == "R0000007"                   # id 7: NULL key and m02
    assert rows["0999.999.999"]["revenue_n"] == 0.0
    assert p.count() == 2 + 10000                                        # the rest are unique enterprises


def test_dedup_limits_before_the_shuffle(spark):
    plan = accounts.preferred_accounts(_filings(spark, 3000))
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    assert "WindowGroupLimit" in text and "Partial" in text


def test_hot_key_staging_equals_reference_plan(spark):
    f = _filings(spark, 9000)
    e, a, act = empty_dims(spark)
    early = staging.staging_master(f, e, a, act, mode="early")
    join = staging.staging_master(f, e, a, act, mode="join")
    assert early.count() == join.count() == 3002
    assert early.exceptAll(join).count() == 0


def test_hot_key_on_the_file_id_plan(spark, tmp_path):
    """Same hot keys, read back from files so the sums are keyed by the stable file-row id."""
    from kredo.sources import fixtures
    path = str(tmp_path / "filings")
    _filings(spark, 9000).write.parquet(path)
    f = spark.read.parquet(path).select("*", fixtures.file_row_id())
    assert "_filing_id" in f.columns
    e, a, act = empty_dims(spark)
    by_id = staging.staging_master(f, e, a, act, mode="early")
    literal = staging.staging_master(f.drop("_filing_id"), e, a, act, mode="join")
    assert by_id.count() == literal.count() == 3002
    assert by_id.exceptAll(literal).count() == 0
    text = by_id._sc._jvm.PythonSQLUtils.explainString(by_id._jdf.queryExecution(), "simple")
    assert "WindowGroupLimit" in text


def test_hot_reference_number_equals_reference_plan(spark):
    """A third of the preferred filings share one number, another third have none."""
    f = _filings(spark, 900).withColumn("EnterpriseNumber", F.concat(F.lit("E"), "ReferenceNumber")).withColumn(
        "ReferenceNumber", F.when(F.col("Rubrics")[0]["Value"].cast("int") % 3 == 0, F.lit("HOT"))
        .when(F.col("Rubrics")[0]["Value"].cast("int") % 3 == 1, F.col("ReferenceNumber")))
    e, a, act = empty_dims(spark)
    literal = staging.staging_master(f, e, a, act, mode="join")
    want = literal.groupBy(*literal.columns).count().checkpoint()
    assert want.agg(F.sum("count")).first()[0] == 300 * 300 + 600
    for mode in ("early", "fold"):
        got = staging.staging_master(f, e, a, act, mode=mode)
        got = got.groupBy(*got.columns).count().checkpoint()
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
