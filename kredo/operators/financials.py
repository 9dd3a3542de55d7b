"""Rubric unnesting and the 70 conditional sums per filing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kredo.functions import codes
from kredo.functions.scalars import safe_date, safe_double, zero_if_null


def unnest_rubrics(accounts: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Lateral left join with the period-filtered rubric array (LEFT JOIN UNNEST).

    NULL, empty and fully filtered arrays each keep one row with a NULL
    rubric, so every filing survives.  Built from codegen'd pieces: whether a
    filing has any kept rubric is ``array_contains`` on the extracted
    periods, and the unnest keeps the kept rubrics, or else only position 0
    (or the NULL row) with its fields set to NULL.
    """
    keep = keep or ["ReferenceNumber", "EnterpriseNumber"]
    periods = [p for p, _ in codes.PERIODS]
    has_kept = None
    for p in periods:
        c = F.array_contains(F.col("Rubrics.Period"), p)
        has_kept = c if has_kept is None else (has_kept | c)
    x = accounts.select(*keep, F.coalesce(has_kept, F.lit(False)).alias("_has"),
                        F.posexplode_outer("Rubrics").alias("_pos", "r"))
    kept = F.col("r.Period").isin(*periods)
    placeholder = ~F.col("_has") & (F.col("_pos").isNull() | (F.col("_pos") == 0))
    x = x.where(F.coalesce(kept, F.lit(False)) | placeholder)
    return x.select(*keep, *[F.when(F.col("_has"), F.col(f"r.{c}")).alias(c) for c in ("Code", "Period", "Value")])


_SPELLED = sorted((c, len(codes.PERIODS) * i) for i, spec in enumerate(codes.RUBRICS) for c in codes.spellings(spec))


def _place(code: Column, among: list[tuple[str, int]]) -> Column:
    """The number beside a code in a sorted list, found by halves; NULL when not listed."""
    if len(among) > 2:
        half = len(among) // 2
        return F.when(code < among[half][0], _place(code, among[:half])).otherwise(_place(code, among[half:]))
    found = F.when(code == among[0][0], F.lit(among[0][1]))
    for c, place in among[1:]:
        found = found.when(code == c, F.lit(place))
    return found


def sum_columns() -> list[str]:
    """Output names of the 70 sums: all current-period ones, then all previous-period ones."""
    return [spec.stem + suffix for _, suffix in codes.PERIODS for spec in codes.RUBRICS]


def unnest_summed(df: DataFrame, keep: list[str]) -> DataFrame:
    """Unnest the rubrics to (keep..., _slot, _val), dropping rubrics that feed no sum.

    ``posexplode_outer`` keeps one row for a NULL or empty array; position 0
    is kept even when it feeds no sum.  So every filing keeps at least one
    row (as LEFT JOIN UNNEST does) while other periods and unused codes are
    dropped before the aggregate, without a lambda over the array.

    A rubric's texts are taken out of the array once each, in steps: an
    expression that names a field several times would read it as often.
    ``_slot`` is 2*i + p, the position among the 70 sums; the value is only
    parsed when it is summed.
    """
    r, names = F.col("r"), [p for p, _ in codes.PERIODS]
    x = df.select(*keep, F.posexplode_outer("Rubrics").alias("_pos", "r"))
    used = r["Period"].isin(*names) & r["Code"].isin(*[c for c, _ in _SPELLED])
    x = x.where(used | F.col("_pos").isNull() | (F.col("_pos") == 0))
    x = x.select(*keep, F.array_position(F.lit(names), r["Period"]).alias("_nth"), "r")
    period = F.col("_nth") > 0
    x = x.select(*keep, "_nth", F.when(period, r["Code"]).alias("_code"), F.when(period, r["Value"]).alias("_text"))
    x = x.select(*keep, (_place(F.col("_code"), _SPELLED) + F.col("_nth") - 1).cast("int").alias("_slot"), "_text")
    return x.select(*keep, "_slot", F.when(F.col("_slot").isNotNull(), safe_double("_text")).alias("_val"))


def sums() -> list[Column]:
    """70 x SUM(value) FILTER (WHERE slot = position): NULL when nothing matches.

    Equal to the reference's SUM(CASE WHEN code AND period THEN value END),
    but a row only updates the one sum its slot feeds (a CASE form updates all
    70 buffers on every row); measured 1.7x faster on the unnested rubrics.
    """
    out = []
    for p, (_, suffix) in enumerate(codes.PERIODS):
        for i, spec in enumerate(codes.RUBRICS):
            out.append(F.expr(f"sum(_val) FILTER (WHERE _slot = {2 * i + p})").alias(spec.stem + suffix))
    return out


def row_sums(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the 70 sums of every filing, within its row: no unnest, no aggregate, no exchange.

    Equal to ``unnest_summed`` grouped by a row id.  The slots of the rubrics are looked up once; a sum reads the
    one rubric of its slot.  Where a filing has several of a slot, its sums add them in the array's order.
    """
    n = len(codes.PERIODS)
    by_code = ", ".join(f"'{c}', {n * i}" for i, spec in enumerate(codes.RUBRICS) for c in codes.spellings(spec))
    by_period = " ".join(f"WHEN r.Period = '{p}' THEN {k}" for k, (p, _) in enumerate(codes.PERIODS))
    slot = f"element_at(map({by_code}), r.Code) + CASE {by_period} END"
    periods = ", ".join(f"'{p}'" for p, _ in codes.PERIODS)
    x = df.select(*keep, F.col("Rubrics.Value").alias("_values"),
                  F.expr(f"transform(Rubrics, r -> CASE WHEN r.Period IN ({periods}) THEN {slot} END)").alias("_slots"))
    kept = F.expr("filter(_slots, s -> s IS NOT NULL)")
    x = x.withColumn("_several", F.coalesce(F.size(F.array_distinct(kept)) < F.size(kept), F.lit(False)))
    x = x.withColumn("_parsed", F.when(F.col("_several"), F.transform("_values", safe_double)))
    at = {spec.stem + suffix: n * i + k for k, (_, suffix) in enumerate(codes.PERIODS) for i, spec in enumerate(codes.RUBRICS)}
    text = [F.expr(f"get(_values, CAST(array_position(_slots, {s}) AS INT) - 1)").alias(name) for name, s in at.items()]
    x = x.select(*keep, "_slots", "_several", "_parsed", *text)

    def added(s: int) -> Column:
        return F.expr(f"""aggregate(zip_with(_slots, _parsed, (s, v) -> CASE WHEN s = {s} THEN v END), CAST(NULL AS DOUBLE),
            (a, v) -> CASE WHEN v IS NULL THEN a ELSE coalesce(a, CAST(0 AS DOUBLE)) + v END)""")

    return x.select(*keep, *[F.when(F.col("_several"), added(s)).otherwise(F.lit(0.0) + safe_double(name)).alias(name)
                             for name, s in at.items()])


def financials_base(preferred: DataFrame) -> DataFrame:
    """ReferenceNumber, EnterpriseNumber, balance_sheet_date and the 70 sums.

    Unwanted rubrics (period X, unused codes) get a NULL slot and add nothing,
    which equals filtering the array first while keeping one row per filing.
    ``accounting_year`` (a function of the same end date) and the clean
    number (a function of the raw one) join the grouping keys so that the
    aggregate reuses the deduplication's partitioning (no second shuffle).
    """
    keys = ["clean_enterprise_number", "EnterpriseNumber", "accounting_year", "ReferenceNumber", "balance_sheet_date"]
    x = unnest_summed(preferred.withColumn("balance_sheet_date", safe_date("EndDate")), keys)
    g = x.groupBy(*keys).agg(*sums())
    return g.select("ReferenceNumber", "EnterpriseNumber", "balance_sheet_date", *sum_columns())


def _z(name: str) -> Column:
    return zero_if_null(F.col(name))


def derived_columns() -> list[Column]:
    """personnel_fte_n and, per period, cash flow, adjusted equity and value added."""
    out = [F.coalesce(F.col("c_9087_n"), F.col("c_1003_n")).alias("personnel_fte_n")]
    cash_plus = ["c_9903", "c_630", "c_631_4", "c_635_8", "c_61", "c_65_66B", "c_66A", "c_66B"]
    cash_minus = ["c_76A", "c_76B"]
    for _, s in codes.PERIODS:
        e = _z(cash_plus[0] + s)
        for c in cash_plus[1:]:
            e = e + _z(c + s)
        for c in cash_minus:
            e = e - _z(c + s)
        out.append(e.alias("current_cashflow_pre_tax" + s))
    for _, s in codes.PERIODS:
        out.append((_z("equity" + s) - _z("c_20" + s) - _z("c_21" + s) - _z("c_12" + s)).alias("adjusted_equity" + s))
    for _, s in codes.PERIODS:
        out.append((_z("c_9900" + s) - _z("c_76A" + s)).alias("current_value_added" + s))
    return out


def financials(preferred: DataFrame) -> DataFrame:
    """financials_base plus the derived sums (H5-H8)."""
    b = financials_base(preferred)
    return b.select("*", *derived_columns())
