"""Scalar column expressions (all JVM-side, no Python UDFs).

The reference relies on BigQuery's SAFE_* functions.  Spark's nearest
built-ins are more lenient ("1d" parses as a double, "2023" as a date) and
let non-finite values through, so each one gets a guard here.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from kredo.functions import codes

# Text that a strict numeric cast accepts: optional sign, digits with an
# optional fraction, optional exponent; surrounding blanks allowed.
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# Text that a strict date cast accepts: yyyy-m-d (time part not allowed).
ISO_DATE_TEXT = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s*$"

_INF = float("inf")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def finite_or_null(x: Column | str) -> Column:
    """NaN and +/-inf become NULL (NaN sorts above every number in Spark)."""
    x = _c(x)
    return F.when(F.abs(x) < F.lit(_INF), x)


def safe_double(x: Column | str) -> Column:
    """SAFE_CAST(x AS FLOAT64): NULL unless the text is a plain number.

    Most amounts are whole: a text that an integer gives back unchanged needs no pattern and no decimal parser.  Only texts
    that look like one are tried (a failed try is slow).
    """
    x = _c(x)
    whole = F.when((x < ":") & ~x.contains("."), x.try_cast("bigint"))
    other = finite_or_null(F.when(x.rlike(NUMERIC_TEXT), F.trim(x).try_cast("double")))
    return F.when(whole.cast("string") == x, whole.cast("double")).otherwise(other)


def safe_date(x: Column | str) -> Column:
    """SAFE_CAST(x AS DATE) on ISO text; anything else is NULL."""
    x = _c(x)
    return F.when(x.rlike(ISO_DATE_TEXT), F.trim(x).try_cast("date"))


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """SAFE_DIVIDE: NULL for x/0, 0/0, NULL inputs and non-finite results."""
    return finite_or_null(F.try_divide(_c(a), _c(b)))


def zero_if_null(x: Column | str) -> Column:
    """COALESCE(x, 0)."""
    return F.coalesce(_c(x), F.lit(0.0))


def clean_number(x: Column | str) -> Column:
    """REPLACE(x, '.', ''): a literal replace, not a regex."""
    return F.replace(_c(x), F.lit("."), F.lit(""))


def first_part(x: Column | str, sep: str = "-") -> Column:
    """SPLIT(x, sep)[SAFE_OFFSET(0)]."""
    return F.substring_index(_c(x), sep, 1)


def lookup(x: Column, mapping: Mapping[str, object], default: object) -> Column:
    """Simple CASE x WHEN k THEN v ... ELSE default END, first match wins."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(x == F.lit(k), F.lit(v)) if expr is None else expr.when(x == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def model_rank(model_type: Column | str = "ModelType") -> Column:
    return lookup(first_part(model_type), codes.MODEL_RANK, codes.MODEL_RANK_DEFAULT)


def language_rank(language: Column | str = "Language") -> Column:
    return lookup(_c(language), codes.LANGUAGE_RANK, codes.LANGUAGE_RANK_DEFAULT)


def model_category(model_type: Column | str = "ModelType") -> Column:
    return lookup(first_part(model_type), codes.MODEL_CATEGORY, codes.MODEL_CATEGORY_DEFAULT)


def failed_flag(situation: Column | str = "JuridicalSituation") -> Column:
    """1 when the current juridical situation marks a failure; NULL -> 0."""
    return F.when(_c(situation).isin(*codes.FAILED_SITUATIONS), F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def company_segment(total_assets: Column | str, revenue: Column | str, fte: Column | str) -> Column:
    """Size segment; first matching rule wins, all comparisons strict."""
    a, r, f = zero_if_null(total_assets), zero_if_null(revenue), zero_if_null(fte)

    def over(x: Column, lim: float) -> Column:
        return F.when(x > F.lit(lim), F.lit(1)).otherwise(F.lit(0))

    ma, mr, mf = codes.MICRO_LIMITS
    sa, sr, sf = codes.SME_LIMITS
    return (F.when((a < codes.INACTIVE_MAX) & (r < codes.INACTIVE_MAX), F.lit("Inactive/Empty"))
             .when((f == 0) & (a > codes.HOLDING_MIN_ASSETS), F.lit("Holding"))
             .when(over(a, ma) + over(r, mr) + over(f, mf) <= 1, F.lit("Micro"))
             .when(over(a, sa) + over(r, sr) + over(f, sf) <= 1, F.lit("SME"))
             .otherwise(F.lit("Large")))


def growth(y2: Column | str, y1: Column | str) -> Column:
    """SAFE_DIVIDE(y2 - y1, ABS(NULLIF(y1, 0)))."""
    y1 = _c(y1)
    return safe_divide(_c(y2) - y1, F.abs(F.nullif(y1, F.lit(0.0))))


def dmy_to_date(x: Column | str) -> Column:
    """Register dates: 'DD-MM-YYYY' (also 'D-M-YYYY') or ISO 'YYYY-MM-DD' -> DATE.

    The reference rewrites D-M-Y text to ISO before a strict load; anything
    else fails that load.  Unparsable text is NULL here.
    """
    x = F.trim(_c(x))
    dmy = F.when(x.rlike(r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"),
                 F.to_date(F.try_to_timestamp(x, F.lit("d-M-yyyy"))))
    return F.coalesce(dmy, safe_date(x))
