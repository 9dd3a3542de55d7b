"""The staging ("master") table: one row per enterprise and accounting year.

Plan shape (README "Plans and scale", PLANS.md): the 70 sums of each filing
are computed first (map-side partial aggregate, keyed by a stable file-row id
when the filings come from files), so that every exchange carries one narrow
row per filing and the rubric arrays are never shuffled; the preferred filing
per (enterprise, year) is then chosen with a partial top-1 before its shuffle;
the three dimension joins share one key, so the fact rows are re-partitioned
once on the clean number and each dimension is broadcast (Spark's size check)
or shuffled on the same key.  ``mode="fold"`` and ``mode="join"`` give the
same table with the reference's order of steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kredo.functions.scalars import company_segment, failed_flag, model_category, safe_divide, zero_if_null
from kredo.operators import accounts, dimensions, financials
from kredo.session import ensure_checkpoint_dir

ACCOUNT_COLUMNS = ["EnterpriseNumber", "accounting_year", "clean_enterprise_number", "ReferenceNumber",
                   "EnterpriseName", "EnterpriseName_historic", "Language", "ModelType",
                   "StartDate", "EndDate", "LegalSituation"]


def accounts_with_financials(preferred: DataFrame, fold: bool = True) -> DataFrame:
    """Preferred filings with their sums and derived sums.

    The reference aggregates the sums per (ReferenceNumber, EnterpriseNumber,
    end date) and joins them back on ReferenceNumber.  ``fold=True`` computes
    them in the same aggregate (the filing's columns ride along as grouping
    keys) and applies the join's effect (``by_reference``); ``fold=False`` runs
    the literal join.
    """
    if fold:
        # The row id, where there is one, is also the key that the filings lie by.
        keys = ACCOUNT_COLUMNS + [c for c in ("_filing_id",) if c in preferred.columns]
        x = financials.unnest_summed(preferred, keys)
        f = by_reference(x.groupBy(*keys).agg(*financials.sums()).drop("_filing_id"), preferred)
    else:
        fb = financials.financials_base(preferred).drop("EnterpriseNumber", "balance_sheet_date")
        f = preferred.select(*ACCOUNT_COLUMNS).join(fb, "ReferenceNumber", "left")
    return f.select("*", *financials.derived_columns())


def shared_numbers(filings: DataFrame) -> DataFrame:
    """Reference numbers that stand on more than one of the filings (one string a filing is shuffled, at most)."""
    return (filings.where(F.col("ReferenceNumber").isNotNull()).groupBy("ReferenceNumber").agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1).select("ReferenceNumber"))


def by_reference(preferred: DataFrame, candidates: DataFrame) -> DataFrame:
    """The reference's join of the sums on ReferenceNumber, from preferred filings with their own sums.

    A filing whose number occurs once keeps its sums.  A NULL number matches nothing: its sums are
    NULL.  Filings that share a number each get one row per sums of that number, as the join gives.
    ``candidates`` are the filings that the preferred ones were chosen from: a number that is unique there is
    unique among the preferred.  A narrow job looks for shared numbers first.  Without any, which is usual,
    the rows need no exchange.  Else the preferred rows are written once; only those with a shared number
    go through the join, which Spark can split where a number is frequent.
    """
    sums = financials.sum_columns()
    own = [c for c in preferred.columns if c not in sums]
    number = F.col("ReferenceNumber")

    def kept(df: DataFrame) -> DataFrame:
        return df.select(*own, *[F.when(number.isNotNull(), F.col(c)).alias(c) for c in sums])

    shared = shared_numbers(candidates)
    if shared.isEmpty():
        return kept(preferred)
    ensure_checkpoint_dir(preferred.sparkSession)
    preferred, shared = preferred.checkpoint(), shared.checkpoint()
    numbered = preferred.where(number.isNotNull())
    several = numbered.join(shared, "ReferenceNumber", "left_semi")
    joined = several.select(*own).join(several.select("ReferenceNumber", *sums), "ReferenceNumber")
    return (kept(preferred.where(number.isNull()))
            .unionByName(numbered.join(shared, "ReferenceNumber", "left_anti"))
            .unionByName(joined))


def n_rubrics(filings: DataFrame) -> Column:
    """Rubrics of a filing: as stored beside it (the arrays are not read for it), else counted."""
    return F.col("_n_rubrics") if "_n_rubrics" in filings.columns else F.coalesce(F.size("Rubrics"), F.lit(0))


def preferred_with_financials(filings: DataFrame, literal: bool = True) -> DataFrame:
    """Preferred filing per (enterprise, year) with its 70 sums: aggregate first, then deduplicate.

    The sums of a filing depend on that filing alone, so they may be computed
    before the choice of the preferred filing.  Doing so lets the map-side
    partial aggregate shrink each filing's ~100 rubrics to one row of sums
    before anything is shuffled: both exchanges (per filing, then per
    enterprise and year with a partial top-1) carry narrow rows, never the
    rubric arrays.  A per-row id keeps identical duplicate filings apart, as
    the reference's window does.  ``literal``: give the sums through
    ReferenceNumber, as the reference's join does.
    """
    f = accounts.with_keys(accounts.scan_years(filings).where(~F.col("ModelType").like("%p")))
    if "_filing_id" in f.columns:
        return _preferred_with_financials_by_id(f, literal)
    keys = ACCOUNT_COLUMNS + ["ImprovementDate", "_n_rubrics", "_row"]
    # The row id is fixed before the unnest (one id per filing, not per rubric).
    f = f.select(*ACCOUNT_COLUMNS, "ImprovementDate", "Rubrics",
                 n_rubrics(f).alias("_n_rubrics"),
                 F.monotonically_increasing_id().alias("_row"))
    x = financials.unnest_summed(f, keys)
    per_filing = x.groupBy(*keys).agg(*financials.sums())
    order = [accounts.model_rank_col().asc(), accounts.language_rank_col().asc(),
             F.col("ImprovementDate").desc_nulls_last(), F.col("_n_rubrics").desc(),
             F.col("ReferenceNumber").asc_nulls_first(), F.col("_row").asc()]
    w = Window.partitionBy(*accounts.DEDUP_KEYS).orderBy(*order)
    best = per_filing.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    best = best.drop("_rn", "ImprovementDate", "_n_rubrics", "_row")
    best = by_reference(best, f) if literal else best
    return best.select("*", *financials.derived_columns())


def _first(filings: DataFrame) -> DataFrame:
    """The preferred filing per (enterprise, year); ``_tie`` orders filings that tie in all ranks."""
    order = [accounts.model_rank_col().asc(), accounts.language_rank_col().asc(),
             F.col("ImprovementDate").desc_nulls_last(), F.col("_n_rubrics").desc(),
             F.col("ReferenceNumber").asc_nulls_first(), F.col("_tie").asc()]
    w = Window.partitionBy(*accounts.DEDUP_KEYS).orderBy(*order)
    best = filings.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return best.drop("_rn", "ImprovementDate", "_n_rubrics")


def _dedup(per_filing: DataFrame, candidates: DataFrame, literal: bool) -> DataFrame:
    """The preferred ones of filings that carry their sums."""
    best = _first(per_filing).drop("_tie")
    best = by_reference(best, candidates) if literal else best
    return best.select("*", *financials.derived_columns())


def preferred_filings(filings: DataFrame) -> DataFrame:
    """Preferred filings with their rubric arrays.

    Filings with a row id are chosen from their narrow columns; the arrays are then picked where they are read
    (``at_rows``).  Without an id, the window is taken over the whole rows.
    """
    if "_filing_id" not in filings.columns:
        return accounts.preferred_accounts(filings)
    f = accounts.with_keys(accounts.scan_years(filings).where(~F.col("ModelType").like("%p")))
    attrs = f.select(*ACCOUNT_COLUMNS, "ImprovementDate", n_rubrics(f).alias("_n_rubrics"), F.col("_filing_id").alias("_tie"))
    return at_rows(f, _first(attrs).select(F.col("_tie").alias("_filing_id")))


#: Rows of a file that one bitmap stands for, and the bytes of all bitmaps that are sent to every task.
BITS, BITMAP_BYTES = 1 << 15, 128 << 20


def at_rows(filings: DataFrame, ids: DataFrame) -> DataFrame:
    """The filings whose ``_filing_id`` is among the ids, without an exchange of the filings.

    The ids become bitmaps, a bit for each row of a file (4 KB for 32,768 filings), and every scan task looks its
    rows up in them.  Should the bitmaps of these files be more than ``BITMAP_BYTES`` (some 10^9 filings), the
    filings are dealt by their id to the ids instead.
    """
    file, row = F.col("_filing_id.file"), F.col("_filing_id.row")
    most = filings.groupBy(file.alias("_file")).agg(F.max(row).alias("_row")).agg(
        F.sum((F.col("_row") / 8) + 64 * (1 + F.col("_row") / BITS))).first()[0]
    if (most or 0) > BITMAP_BYTES:
        return filings.join(ids.hint("shuffle_hash"), "_filing_id", "left_semi")
    part, bit = F.expr(f"_filing_id.row div {BITS}"), F.expr(f"_filing_id.row % {BITS}")
    bitmaps = ids.select(file.alias("_file"), part.alias("_part"), bit.alias("_bit")).groupBy("_file", "_part").agg(
        F.expr("substring(bitmap_construct_agg(_bit), 1, CAST(max(_bit) div 8 + 1 AS INT))").alias("_bits"))
    x = filings.withColumns({"_at": part, "_bit": bit})
    x = x.join(F.broadcast(bitmaps), (file == F.col("_file")) & (F.col("_at") == F.col("_part")))
    byte = F.expr("CAST(conv(hex(substring(_bits, CAST(_bit div 8 + 1 AS INT), 1)), 16, 10) AS INT)")
    return x.where(byte.bitwiseAND(F.expr("shiftleft(1, CAST(_bit % 8 AS INT))")) != 0).select(*filings.columns)


def _preferred_with_financials_by_id(f: DataFrame, literal: bool) -> DataFrame:
    """The same result when filings carry a stable, unique per-row id (``_filing_id``, see fixtures.file_row_id).

    Only the id rides through the unnest and the sums are keyed by it alone
    (a fixed-width key), so the rubric rows stay narrow.  The preferred filings
    are chosen from the filings' own columns and then joined to the sums on the
    id, so the wide rows are neither sorted nor exchanged for the choice.  The
    chosen rows are the narrow side: they are hashed, the sums stream past.
    """
    sums = financials.unnest_summed(f, ["_filing_id"]).groupBy("_filing_id").agg(*financials.sums())
    attrs = f.select(*ACCOUNT_COLUMNS, "ImprovementDate", n_rubrics(f).alias("_n_rubrics"), "_filing_id")
    best = _first(attrs.withColumnRenamed("_filing_id", "_tie")).withColumnRenamed("_tie", "_filing_id")
    best = sums.join(best.hint("shuffle_hash"), "_filing_id").select(*ACCOUNT_COLUMNS, *financials.sum_columns())
    best = by_reference(best, f) if literal else best
    return best.select("*", *financials.derived_columns())


def _sd(a: Column | str, b: Column | str) -> Column:
    return safe_divide(a, b)


def _z(c: str) -> Column:
    return zero_if_null(F.col(c))


def master_columns() -> list[Column]:
    """The 60 output columns, in the reference's order."""
    c = F.col
    out = [
        c("accounting_year"),
        c("ReferenceNumber").alias("reference_number"),
        c("EnterpriseNumber").alias("enterprise_number"),
        c("EnterpriseName").alias("enterprise_name"),
        c("EnterpriseName_historic").alias("enterprise_name_historic"),
        c("Language").alias("account_language"),
        c("ModelType").alias("raw_model_type"),
        model_category("ModelType").alias("model_category"),
        c("StartDate").alias("account_start_date"),
        c("EndDate").alias("account_end_date"),
        c("nace_primary_code"), c("nace_primary_division"),
        c("nace_secondary_code"), c("nace_tertiary_code"),
        c("Zipcode"), c("MunicipalityNL"),
        c("JuridicalSituation").alias("legal_status_code_current"),
        c("Status").alias("enterprise_status_current"),
        c("LegalSituation").alias("legal_situation_historic"),
        failed_flag("JuridicalSituation").alias("is_failed_CURRENT_STATUS"),
        c("revenue_n"), c("revenue_nm1"), c("total_assets_n"), c("total_assets_nm1"),
        c("ebit_n"), c("ebit_nm1"), c("net_profit_n"), c("net_profit_nm1"),
        c("personnel_fte_n"),
        c("current_cashflow_pre_tax_n"), c("current_cashflow_pre_tax_nm1"),
    ]
    for s in ("_n", "_nm1"):
        out.append(_sd("current_cashflow_pre_tax" + s, "revenue" + s).alias("current_ccf_revenue" + s))
    for s in ("_n", "_nm1"):
        out.append(_sd("net_profit" + s, "total_assets" + s).alias("roa" + s))
    for s in ("_n", "_nm1"):
        out.append(_sd("c_9905" + s, "equity" + s).alias("roe" + s))
    out += [c("current_value_added_n"), c("current_value_added_nm1"),
            c("equity_n"), c("equity_nm1"), c("adjusted_equity_n"), c("adjusted_equity_nm1")]
    for s in ("_n", "_nm1"):
        out.append(_sd(_z("c_16" + s) + _z("c_17_49" + s), "equity" + s).alias("debt_to_equity" + s))
    for s in ("_n", "_nm1"):
        out.append(_sd("equity" + s, "total_assets" + s).alias("solvency_pct" + s))
    for s in ("_n", "_nm1"):
        out.append(_sd("c_490_1" + s, "c_10" + s).alias("current_ratio_custom" + s))
    for s in ("_n", "_nm1"):
        out.append((_sd("c_3" + s, "revenue" + s) * 365).alias("inventory_turnover_days" + s))
    for s in ("_n", "_nm1"):
        out.append((_sd(_z("c_290" + s) + _z("c_40" + s), "revenue" + s) * 365).alias("customer_credit_days" + s))
    for s in ("_n", "_nm1"):
        out.append((_sd(_z("c_175" + s) + _z("c_44" + s), _z("c_60" + s) + _z("c_61" + s)) * 365)
                   .alias("supplier_credit_days" + s))
    for s in ("_n", "_nm1"):
        out.append((c("current_cashflow_pre_tax" + s) - _z("c_42" + s)).alias("repayment_pre_tax" + s))
    for s in ("_n", "_nm1"):
        out.append(_sd("current_assets" + s, "short_term_debt" + s).alias("liquidity_ratio" + s))
    out.append(company_segment("total_assets_n", "revenue_n", "personnel_fte_n").alias("company_segment"))
    return out


def staging_with_key(filings: DataFrame, dim_enterprise: DataFrame, dim_address: DataFrame,
                     dim_activity: DataFrame, mode: str = "early") -> DataFrame:
    """Staging table plus ``clean_enterprise_number`` (kept for later co-partitioned steps).

    ``mode``: 'early' sums before deduplicating (narrow shuffles, default);
    'fold' deduplicates first and sums in the same partitioning; 'join' is the
    literal reference plan (sums joined back on ReferenceNumber).
    """
    if mode == "early":
        acc = preferred_with_financials(filings)
    else:
        acc = accounts_with_financials(preferred_filings(filings), fold=(mode == "fold"))
    return with_dimensions(acc, dim_enterprise, dim_address, dim_activity)


def with_dimensions(acc: DataFrame, dim_enterprise: DataFrame, dim_address: DataFrame, dim_activity: DataFrame) -> DataFrame:
    """Staging rows (with the clean number) of preferred filings that carry their sums."""
    key = "clean_enterprise_number"
    ent = dimensions.clean_enterprise(dim_enterprise).select(key, "JuridicalSituation", "Status")
    act = dimensions.pivoted_activities(dim_activity).select(
        key, "nace_primary_code", "nace_primary_division", "nace_secondary_code", "nace_tertiary_code")
    adr = dimensions.preferred_address(dim_address).select(key, "Zipcode", "MunicipalityNL")
    j = acc.join(ent, key, "left").join(act, key, "left").join(adr, key, "left")
    return j.select(*master_columns(), key)


def staging_master(filings: DataFrame, dim_enterprise: DataFrame, dim_address: DataFrame,
                   dim_activity: DataFrame, mode: str = "early") -> DataFrame:
    """The 60-column staging table."""
    return staging_with_key(filings, dim_enterprise, dim_address, dim_activity, mode).drop("clean_enterprise_number")


def financials_from_filings(filings: DataFrame, derived: bool = False) -> DataFrame:
    """``financials_base`` (or ``financials``) of the preferred filings, on the narrow-shuffle plan.

    The reference groups the preferred filings by (reference, enterprise, end
    date); there is one preferred filing per (enterprise, year) and the key
    fixes both, so its groups are exactly the preferred filings and the sums
    computed before deduplication are the same rows.
    """
    from kredo.functions.scalars import safe_date
    p = preferred_with_financials(filings, literal=False)
    cols = ["ReferenceNumber", "EnterpriseNumber", safe_date("EndDate").alias("balance_sheet_date"),
            *financials.sum_columns()]
    if derived:
        cols += ["personnel_fte_n", "current_cashflow_pre_tax_n", "current_cashflow_pre_tax_nm1",
                 "adjusted_equity_n", "adjusted_equity_nm1", "current_value_added_n", "current_value_added_nm1"]
    return p.select(*cols)
