"""Three-year windows: lags, trends and the consecutive-year filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kredo.functions import codes
from kredo.functions.scalars import growth

# FIXED VALUES: (staging column, feature stem) lagged by one and two years, in output order.
LAGGED = [
    ("roa_n", "roa"), ("roe_n", "roe"), ("current_ccf_revenue_n", "ccf_revenue"),
    ("solvency_pct_n", "solvency"), ("debt_to_equity_n", "debt_to_equity"),
    ("current_ratio_custom_n", "liquidity_custom"), ("liquidity_ratio_n", "liquidity_standard"),
    ("inventory_turnover_days_n", "inventory_days"), ("customer_credit_days_n", "customer_days"),
    ("supplier_credit_days_n", "supplier_days"),
    ("revenue_n", "revenue"), ("total_assets_n", "assets"), ("equity_n", "equity"),
    ("current_cashflow_pre_tax_n", "cashflow"), ("ebit_n", "ebit"), ("net_profit_n", "net_profit"),
    ("personnel_fte_n", "fte"),
]
DELTAS = ["roa", "roe", "ccf_revenue", "solvency", "debt_to_equity", "liquidity_custom",
          "liquidity_standard", "inventory_days", "customer_days", "supplier_days"]
GROWTHS = ["revenue", "assets", "equity", "cashflow", "ebit", "net_profit", "fte"]
TARGETS = [("net_profit_n", "target_net_profit_y3"), ("roe_n", "target_roe_y3"), ("roa_n", "target_roa_y3"),
           ("solvency_pct_n", "target_solvency_y3"), ("current_ratio_custom_n", "target_liquidity_y3")]


def base_data(staging: DataFrame) -> DataFrame:
    """Rows of the segments that are modelled (before the lags: a Holding year breaks a chain)."""
    return staging.where(F.col("company_segment").isin(*codes.TRAINING_SEGMENTS))


def _window(staging: DataFrame) -> Window:
    # The clean number is a function of the raw one: adding it leaves the
    # partitions unchanged but lets the window reuse the staging joins'
    # partitioning when both run in one plan.
    keys = (["clean_enterprise_number"] if "clean_enterprise_number" in staging.columns else []) + ["enterprise_number"]
    return Window.partitionBy(*keys).orderBy(F.col("accounting_year").asc_nulls_first())


def rolling_window(staging: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Year-3 targets with year-2 and year-1 features (one shared window, one sort).

    ``extra`` names staging columns added as lag-1 features (e.g. raw_model_type, SURVEY Q9).
    """
    b = base_data(staging)
    w = _window(b)
    cols: list[Column] = [
        F.col("accounting_year").alias("target_year_y3"), F.col("enterprise_number"),
        F.col("company_segment"), F.col("nace_primary_code"),
        *[F.col(src).alias(dst) for src, dst in TARGETS],
    ]
    for lag, tag in ((1, "y2"), (2, "y1")):
        cols.append(F.lag("accounting_year", lag).over(w).alias(f"year_{tag}"))
        cols += [F.lag(src, lag).over(w).alias(f"{stem}_{tag}") for src, stem in LAGGED]
    for c in extra or []:
        cols.append(F.lag(c, 1).over(w).alias(f"{c}_y2"))
    keep = ["clean_enterprise_number"] if "clean_enterprise_number" in b.columns else []
    return b.select(*cols, *keep)


def trend_columns() -> list[Column]:
    out = [(F.col(f"{s}_y2") - F.col(f"{s}_y1")).alias(f"trend_delta_{s}") for s in DELTAS]
    out += [growth(f"{s}_y2", f"{s}_y1").alias(f"trend_growth_{s}") for s in GROWTHS]
    return out


def training_dataset(staging: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """The 62-column training table: windows of three consecutive years only."""
    r = rolling_window(staging, extra)
    y3 = F.col("target_year_y3")
    r = r.where(F.col("year_y1").isNotNull() & (F.col("year_y2") == y3 - 1) & (F.col("year_y1") == y3 - 2))
    out = r.select("*", *trend_columns())
    return out.drop("clean_enterprise_number")
