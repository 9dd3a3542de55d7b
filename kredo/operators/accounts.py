"""Filing scans and the preferred filing per enterprise and year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kredo.functions import codes
from kredo.functions.scalars import clean_number, language_rank, model_rank, safe_date


def scan_years(filings: DataFrame, lo: int = codes.SCAN_YEAR_MIN, hi: int = codes.SCAN_YEAR_MAX) -> DataFrame:
    """Keep the per-year filing tables lo..hi.

    On a dataset written with ``partitionBy('filing_year')`` this is a
    partition filter: files of other years are never opened.
    """
    return filings.where(F.col("filing_year").between(lo, hi))


def with_keys(filings: DataFrame) -> DataFrame:
    """Add accounting_year (year of the safely cast end date) and the clean number."""
    out = filings.withColumn("accounting_year", F.year(safe_date("EndDate")).cast("bigint"))
    if "clean_enterprise_number" in filings.columns:     # stored with the filings (bucket key): keep it
        return out
    return out.withColumn("clean_enterprise_number", clean_number("EnterpriseNumber"))


def model_rank_col():
    return model_rank("ModelType")


def language_rank_col():
    return language_rank("Language")


# The clean number is a function of the raw one, so it leaves the groups of
# (raw number, year) unchanged; listing it lets a table bucketed (or a plan
# partitioned) by the clean number satisfy the window without a shuffle.
DEDUP_KEYS = ["clean_enterprise_number", "EnterpriseNumber", "accounting_year"]


def preference_order() -> list:
    """Model rank, language rank, latest improvement, most rubrics; reference number breaks ties."""
    return [
        model_rank_col().asc(),
        language_rank_col().asc(),
        F.col("ImprovementDate").desc_nulls_last(),
        F.coalesce(F.size("Rubrics"), F.lit(0)).desc(),
        F.col("ReferenceNumber").asc_nulls_first(),
    ]


def preferred_accounts(filings: DataFrame, lo: int = codes.SCAN_YEAR_MIN,
                       hi: int = codes.SCAN_YEAR_MAX) -> DataFrame:
    """One filing per (raw enterprise number, accounting year).

    ``row_number() = 1`` over the partition is planned as a WindowGroupLimit:
    each map task keeps only its best filing per key before the shuffle, so a
    hot enterprise (or the NULL key) ships one row per task, not all of them.
    """
    f = scan_years(filings, lo, hi).where(~F.col("ModelType").like("%p"))   # NULL model is dropped too
    f = with_keys(f)
    w = Window.partitionBy(*DEDUP_KEYS).orderBy(*preference_order())
    return f.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
