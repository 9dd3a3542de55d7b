"""Fixed values that must equal the reference for equal results.

FIXED VALUES (do not edit): rubric codes of the annual-account filings, the
output column stem each one feeds, and the alternative spelling the reference
also accepts.  Order is the order of the reference's financials block.
"""

from __future__ import annotations

from typing import NamedTuple


class RubricSpec(NamedTuple):
    stem: str            # output column stem; suffixed with _n / _nm1
    code: str            # rubric code as written in filings
    alt: str | None      # second accepted spelling, if any


# FIXED VALUES: (output stem, code, alternative spelling)
RUBRICS: tuple[RubricSpec, ...] = (
    RubricSpec("total_assets", "20/58", "2058"),
    RubricSpec("c_9087", "9087", None),
    RubricSpec("equity", "10/15", "1015"),
    RubricSpec("revenue", "70", None),
    RubricSpec("net_profit", "9904", None),
    RubricSpec("current_assets", "29/58", "2958"),
    RubricSpec("short_term_debt", "42/48", "4248"),
    RubricSpec("ebit", "9901", None),
    RubricSpec("c_9905", "9905", None),
    RubricSpec("c_16", "16", None),
    RubricSpec("c_17_49", "17/49", None),
    RubricSpec("c_290", "290", None),
    RubricSpec("c_175", "175", None),
    RubricSpec("c_42", "42", None),
    RubricSpec("c_10", "10", None),
    RubricSpec("c_60", "60", None),
    RubricSpec("c_61", "61", None),
    RubricSpec("c_630", "630", None),
    RubricSpec("c_631_4", "631/4", None),
    RubricSpec("c_635_8", "635/8", None),
    RubricSpec("c_66A", "66A", None),
    RubricSpec("c_76A", "76A", None),
    RubricSpec("c_3", "3", None),
    RubricSpec("c_40", "40", None),
    RubricSpec("c_44", "44", None),
    RubricSpec("c_490_1", "490/1", None),
    RubricSpec("c_9900", "9900", None),
    RubricSpec("c_1003", "1003", None),
    RubricSpec("c_9903", "9903", None),
    RubricSpec("c_65_66B", "65/66B", "65_66B"),
    RubricSpec("c_66B", "66B", None),
    RubricSpec("c_76B", "76B", None),
    RubricSpec("c_20", "20", None),
    RubricSpec("c_21", "21", None),
    RubricSpec("c_12", "12", None),
)

# FIXED VALUES: the two periods kept (current year, previous year) and suffixes.
PERIODS: tuple[tuple[str, str], ...] = (("N", "_n"), ("NM1", "_nm1"))

# FIXED VALUES: model-type prefix -> preference rank for deduplication.
MODEL_RANK = {"m02": 1, "m82": 1, "m05": 1, "m01": 2, "m81": 2, "m04": 2,
              "m07": 3, "m87": 3, "m08": 3}
MODEL_RANK_DEFAULT = 4

# FIXED VALUES: filing language -> preference rank.
LANGUAGE_RANK = {"NL": 1, "FR": 2}
LANGUAGE_RANK_DEFAULT = 3

# FIXED VALUES: model-type prefix -> model category label.
MODEL_CATEGORY = {
    "m02": "Full Model (With Capital)",
    "m01": "Abbreviated Model (With Capital)",
    "m07": "Micro Model (With Capital)",
    "m82": "Full Model (Without Capital)",
    "m81": "Abbreviated Model (Without Capital)",
    "m87": "Micro Model (Without Capital)",
    "m05": "Full Model (Association/Foundation)",
    "m04": "Abbreviated Model (Association/Foundation)",
    "m08": "Micro Model (Association/Foundation)",
    "m120": "Consolidated Annual Accounts",
    "m121": "Consolidated Annual Accounts",
    "m122": "Consolidated Annual Accounts",
}
MODEL_CATEGORY_DEFAULT = "Specific/Sector Model (e.g., Financial/Healthcare)"

# FIXED VALUES: juridical situations that count as failed.
FAILED_SITUATIONS = ("010", "012", "013", "030", "040", "048", "049", "050", "051")

# FIXED VALUES: activity groups ranked for the main NACE codes, in rank order.
ACTIVITY_GROUP_RANK = {"001": 1, "003": 2, "006": 3}
ACTIVITY_GROUP_RANK_DEFAULT = 99
ACTIVITY_NACE_VERSION = "2025"
ACTIVITY_CLASSIFICATION = "MAIN"

# FIXED VALUES: segments kept for the training table.
TRAINING_SEGMENTS = ("Micro", "SME", "Large")

# FIXED VALUES: size thresholds (strict comparisons).
INACTIVE_MAX = 1000.0
HOLDING_MIN_ASSETS = 500000.0
MICRO_LIMITS = (350000.0, 700000.0, 10.0)     # assets, revenue, fte
SME_LIMITS = (4500000.0, 9000000.0, 50.0)

# FIXED VALUES: year window of the filing tables that are scanned.
SCAN_YEAR_MIN, SCAN_YEAR_MAX = 2020, 2025
# FIXED VALUES: last target year used for training (out-of-time split).
TRAIN_MAX_YEAR = 2023

# FIXED VALUES: defaults of missing year-3 targets in the risk label, and its thresholds (strict comparisons).
RISK_DEFAULT_SOLVENCY, RISK_DEFAULT_ROA, RISK_DEFAULT_LIQUIDITY = 1.0, 0.0, 1.0
RISK_MIN_SOLVENCY, RISK_ALARM_SOLVENCY = 0.0, 0.05
RISK_MIN_ROA = 0.0
RISK_MIN_LIQUIDITY = 1.0


def spellings(spec: RubricSpec) -> tuple[str, ...]:
    return (spec.code,) if spec.alt is None else (spec.code, spec.alt)
