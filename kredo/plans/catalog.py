"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus their SQL oracles.

Every query reads the driver tables of ``sf_dir`` (through the derived
filings and dimensions), so its work grows with them.  Oracles are in
``ORACLE`` and share the derived-table CTEs of ``kredo.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kredo.functions import codes
from kredo.functions.scalars import failed_flag, language_rank, model_category, model_rank
from kredo.operators import accounts, benchmark, dimensions, features, financials, incremental, label, metrics, segments, staging
from kredo.plans import oracle
from kredo.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@dataclass
class Inputs:
    """The derived input tables of one scale directory."""
    spark: SparkSession
    sf_dir: str

    def filings(self) -> DataFrame:
        """Filings as stored per-year tables (derived once from the driver tables, then read)."""
        return fx.stored_filings(self.spark, self.sf_dir)

    def dim_enterprise(self) -> DataFrame:
        return fx.dim_enterprise(self.spark, self.sf_dir)

    def dim_address(self) -> DataFrame:
        return fx.dim_address(self.spark, self.sf_dir)

    def dim_activity(self) -> DataFrame:
        return fx.dim_activity(self.spark, self.sf_dir)

    def preferred(self) -> DataFrame:
        return accounts.preferred_accounts(self.filings())

    def staging(self, keep_key: bool = False, mode: str = "early") -> DataFrame:
        s = staging.staging_with_key(self.filings(), self.dim_enterprise(), self.dim_address(), self.dim_activity(),
                                     mode=mode)
        return s if keep_key else s.drop("clean_enterprise_number")

    def training(self) -> DataFrame:
        return features.training_dataset(self.staging(keep_key=True))

    def nace_map(self) -> DataFrame:
        return fx.dim_nace_mapping(self.spark)

    def macro(self) -> DataFrame:
        return fx.macro(self.spark)

    def labelled(self) -> DataFrame:
        """Labelled windows with a target, their sector, rule cluster and score."""
        lab = label.labelled(self.training())
        lab = lab.withColumn("nace_primary_division", F.substring(F.replace("nace_primary_code", F.lit("."), F.lit("")), 1, 2))
        lab = segments.with_sector(lab, self.nace_map())
        cu = "CAST(replace(enterprise_number, '.', '') AS BIGINT)"
        return (lab.withColumn("rule_cluster", F.expr(fx.rule_cluster_sql(cu)))
                   .withColumn("score", F.expr(fx.score_sql(cu, "target_year_y3", "is_high_risk"))))


W = oracle.with_ctes

# ------------------------------------------------------------------ accounts


@register("preferred_accounts", W("""
SELECT ReferenceNumber, EnterpriseNumber, accounting_year, clean_enterprise_number,
       ModelType, Language, ImprovementDate, n_rubrics
FROM preferred""", training=False))
def q_preferred_accounts(spark, d):
    p = Inputs(spark, d).preferred()
    return p.select("ReferenceNumber", "EnterpriseNumber", "accounting_year", "clean_enterprise_number",
                    "ModelType", "Language", "ImprovementDate",
                    F.coalesce(F.size("Rubrics"), F.lit(0)).cast("bigint").alias("n_rubrics"))


_MODEL = "split_part(ModelType, '-', 1)"


@register("model_category", W(f"""
SELECT ReferenceNumber, ModelType,
       CAST({oracle.case(_MODEL, codes.MODEL_RANK, codes.MODEL_RANK_DEFAULT)} AS BIGINT) AS model_rank,
       CAST({oracle.case("Language", codes.LANGUAGE_RANK, codes.LANGUAGE_RANK_DEFAULT)} AS BIGINT) AS language_rank,
       {oracle.case(_MODEL, codes.MODEL_CATEGORY, codes.MODEL_CATEGORY_DEFAULT)} AS model_category,
       CAST(ModelType NOT LIKE '%p' AS BOOLEAN) AS kept_by_model
FROM filings""", staging=False, training=False))
def q_model_category(spark, d):
    f = Inputs(spark, d).filings()
    return f.select("ReferenceNumber", "ModelType",
                    model_rank().cast("bigint").alias("model_rank"),
                    language_rank().cast("bigint").alias("language_rank"),
                    model_category().alias("model_category"),
                    (~F.col("ModelType").like("%p")).alias("kept_by_model"))


@register("rubrics_unnest", W("""
SELECT acc.ReferenceNumber, acc.EnterpriseNumber, r.Code, r.Period, r.Value
FROM preferred acc
LEFT JOIN rubrics r ON r.ReferenceNumber = acc.ReferenceNumber AND r.Period IN ('N', 'NM1')""", training=False))
def q_rubrics_unnest(spark, d):
    return financials.unnest_rubrics(staging.preferred_filings(Inputs(spark, d).filings()))


@register("financials_base", W("SELECT * FROM financials_base", training=False))
def q_financials_base(spark, d):
    return staging.financials_from_filings(Inputs(spark, d).filings())


@register("financials", W("SELECT * FROM financials", training=False))
def q_financials(spark, d):
    return staging.financials_from_filings(Inputs(spark, d).filings(), derived=True)


@register("financials_base_literal", W("SELECT * FROM financials_base", training=False))
def q_financials_base_literal(spark, d):
    """The reference's order: deduplicate the filings, then unnest and sum."""
    return financials.financials_base(staging.preferred_filings(Inputs(spark, d).filings()))


# ------------------------------------------------------------------ dimensions


@register("failed_flag", W("""
SELECT EnterpriseNumber, clean_enterprise_number, JuridicalSituation, StartDate,
       CAST(CASE WHEN JuridicalSituation IN ('010', '012', '013', '030', '040', '048', '049', '050', '051')
            THEN 1 ELSE 0 END AS BIGINT) AS is_failed_CURRENT_STATUS
FROM clean_dim_enterprise""", training=False))
def q_failed_flag(spark, d):
    e = dimensions.clean_enterprise(Inputs(spark, d).dim_enterprise())
    return e.select("EnterpriseNumber", "clean_enterprise_number", "JuridicalSituation", "StartDate",
                    failed_flag("JuridicalSituation").alias("is_failed_CURRENT_STATUS"))


@register("preferred_address", W("""
SELECT EntityNumber, clean_enterprise_number, TypeOfAddress, Zipcode, MunicipalityNL, DateStrikingOff
FROM clean_dim_address""", training=False))
def q_preferred_address(spark, d):
    a = dimensions.preferred_address(Inputs(spark, d).dim_address())
    return a.select("EntityNumber", "clean_enterprise_number", "TypeOfAddress", "Zipcode", "MunicipalityNL",
                    "DateStrikingOff")


@register("ranked_activities", W("""
SELECT EnterpriseNumber, NaceCode, ActivityGroup, CAST(rn AS BIGINT) AS rn FROM ranked_activities""",
                                 training=False))
def q_ranked_activities(spark, d):
    return dimensions.ranked_activities(Inputs(spark, d).dim_activity())


@register("pivoted_activities", W("SELECT * FROM pivoted_activities", training=False))
def q_pivoted_activities(spark, d):
    return dimensions.pivoted_activities(Inputs(spark, d).dim_activity())


# ------------------------------------------------------------------ staging


@register("staging_master", W("SELECT * FROM staging", training=False))
def q_staging_master(spark, d):
    return Inputs(spark, d).staging()


@register("profitability", W("""
SELECT reference_number, accounting_year, current_cashflow_pre_tax_n, current_cashflow_pre_tax_nm1,
       current_ccf_revenue_n, current_ccf_revenue_nm1, roa_n, roa_nm1, roe_n, roe_nm1,
       current_value_added_n, current_value_added_nm1
FROM staging""", training=False))
def q_profitability(spark, d):
    return Inputs(spark, d).staging().select(
        "reference_number", "accounting_year", "current_cashflow_pre_tax_n", "current_cashflow_pre_tax_nm1",
        "current_ccf_revenue_n", "current_ccf_revenue_nm1", "roa_n", "roa_nm1", "roe_n", "roe_nm1",
        "current_value_added_n", "current_value_added_nm1")


@register("solvency", W("""
SELECT reference_number, accounting_year, equity_n, equity_nm1, adjusted_equity_n, adjusted_equity_nm1,
       debt_to_equity_n, debt_to_equity_nm1, solvency_pct_n, solvency_pct_nm1
FROM staging""", training=False))
def q_solvency(spark, d):
    return Inputs(spark, d).staging().select(
        "reference_number", "accounting_year", "equity_n", "equity_nm1", "adjusted_equity_n",
        "adjusted_equity_nm1", "debt_to_equity_n", "debt_to_equity_nm1", "solvency_pct_n", "solvency_pct_nm1")


@register("liquidity", W("""
SELECT reference_number, accounting_year, current_ratio_custom_n, current_ratio_custom_nm1,
       inventory_turnover_days_n, inventory_turnover_days_nm1, customer_credit_days_n, customer_credit_days_nm1,
       supplier_credit_days_n, supplier_credit_days_nm1, repayment_pre_tax_n, repayment_pre_tax_nm1,
       liquidity_ratio_n, liquidity_ratio_nm1
FROM staging""", training=False))
def q_liquidity(spark, d):
    return Inputs(spark, d).staging().select(
        "reference_number", "accounting_year", "current_ratio_custom_n", "current_ratio_custom_nm1",
        "inventory_turnover_days_n", "inventory_turnover_days_nm1", "customer_credit_days_n",
        "customer_credit_days_nm1", "supplier_credit_days_n", "supplier_credit_days_nm1",
        "repayment_pre_tax_n", "repayment_pre_tax_nm1", "liquidity_ratio_n", "liquidity_ratio_nm1")


@register("company_segment", W("""
SELECT reference_number, accounting_year, total_assets_n, revenue_n, personnel_fte_n, company_segment
FROM staging""", training=False))
def q_company_segment(spark, d):
    return Inputs(spark, d).staging().select(
        "reference_number", "accounting_year", "total_assets_n", "revenue_n", "personnel_fte_n", "company_segment")


@register("segment_count", W("""
SELECT company_segment, count(*) AS n FROM staging GROUP BY company_segment""", training=False))
def q_segment_count(spark, d):
    return Inputs(spark, d).staging().groupBy("company_segment").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ training


@register("rolling_window", W("SELECT * FROM rolling_window"))
def q_rolling_window(spark, d):
    return features.rolling_window(Inputs(spark, d).staging(keep_key=True)).drop("clean_enterprise_number")


_DELTA_COLS = [f"trend_delta_{s}" for s in features.DELTAS]
_GROWTH_COLS = [f"trend_growth_{s}" for s in features.GROWTHS]


@register("trend_delta", W(f"SELECT target_year_y3, enterprise_number, {', '.join(_DELTA_COLS)} FROM training"))
def q_trend_delta(spark, d):
    return Inputs(spark, d).training().select("target_year_y3", "enterprise_number", *_DELTA_COLS)


@register("trend_growth", W(f"SELECT target_year_y3, enterprise_number, {', '.join(_GROWTH_COLS)} FROM training"))
def q_trend_growth(spark, d):
    return Inputs(spark, d).training().select("target_year_y3", "enterprise_number", *_GROWTH_COLS)


@register("training_dataset", W("SELECT * FROM training"))
def q_training_dataset(spark, d):
    return Inputs(spark, d).training()


@register("risk_label", W("""
SELECT enterprise_number, target_year_y3, risk_branch, is_high_risk FROM labelled"""))
def q_risk_label(spark, d):
    t = Inputs(spark, d).training()
    return t.select("enterprise_number", "target_year_y3", label.risk_branch().alias("risk_branch"),
                    label.is_high_risk().alias("is_high_risk"))


@register("label_split", W("""
SELECT split, is_high_risk, count(*) AS n FROM labelled WHERE has_target GROUP BY split, is_high_risk"""))
def q_label_split(spark, d):
    lab = label.labelled(Inputs(spark, d).training())
    return lab.groupBy("split", "is_high_risk").agg(F.count(F.lit(1)).alias("n"))


@register("class_weights", W("""
SELECT is_high_risk, n_class, CAST(sum(n_class) OVER () AS DOUBLE) / (count(*) OVER () * n_class) AS class_weight
FROM (SELECT is_high_risk, count(*) AS n_class FROM labelled WHERE has_target AND split = 'train'
      GROUP BY is_high_risk)"""))
def q_class_weights(spark, d):
    return label.class_weights(label.training_set(Inputs(spark, d).training()))


@register("staging_master_fold", W("SELECT * FROM staging", training=False))
def q_staging_master_fold(spark, d):
    """Same table, deduplicating before the sums."""
    return Inputs(spark, d).staging(mode="fold")


@register("staging_master_join", W("SELECT * FROM staging", training=False))
def q_staging_master_join(spark, d):
    """Same table, literal reference plan: sums joined back on ReferenceNumber."""
    return Inputs(spark, d).staging(mode="join")


# ------------------------------------------------------------------ segments and benchmarks

_CU = "CAST(replace(enterprise_number, '.', '') AS BIGINT)"
_LAB = f"""
lab AS (
  SELECT l.*, m.Sector AS sector,
         {fx.rule_cluster_sql(_CU)} AS rule_cluster,
         {fx.score_sql(_CU, 'target_year_y3', 'is_high_risk')} AS score
  FROM labelled l
  LEFT JOIN (SELECT Code, Sector FROM nace_map WHERE Level = '2') m
    ON substr(replace(l.nace_primary_code, '.', ''), 1, 2) = m.Code
  WHERE has_target
)"""


def _with_lab(body: str) -> str:
    return W(body, extra=_LAB)


@register("sector_lookup", W("""
SELECT s.reference_number, s.nace_primary_division, m.Sector AS sector
FROM staging s LEFT JOIN (SELECT Code, Sector FROM nace_map WHERE Level = '2') m
  ON s.nace_primary_division = m.Code""", training=False))
def q_sector_lookup(spark, d):
    i = Inputs(spark, d)
    s = segments.with_sector(i.staging(), i.nace_map())
    return s.select("reference_number", "nace_primary_division", "sector")


@register("macro_join", W("""
SELECT s.reference_number, s.accounting_year, m.interest_rate, m.inflation
FROM staging s LEFT JOIN macro m ON s.accounting_year = m.year""", training=False))
def q_macro_join(spark, d):
    i = Inputs(spark, d)
    s = segments.with_macro(i.staging(), i.macro())
    return s.select("reference_number", "accounting_year", "interest_rate", "inflation")


@register("segment_census", W("""
SELECT nace_primary_division, company_segment, model_category, count(*) AS n
FROM staging GROUP BY nace_primary_division, company_segment, model_category""", training=False))
def q_segment_census(spark, d):
    return segments.segment_census(Inputs(spark, d).staging())


_MERGE_PATH = ["nace_primary_division", "nace_primary_code", "company_segment", "model_category"]


# The oracle tries every number of kept nodes: which group would each segment fall to, and how many are there?
@register("segment_merge", W("""
SELECT c.* EXCLUDE (parts), v.level AS group_level, v.key AS group_key, CAST(sum(c.n) OVER (PARTITION BY v.prefix) AS BIGINT) AS group_n
FROM counts c JOIN groups v ON v.parts = c.parts
WHERE v.kept = (SELECT max(kept) FROM (SELECT kept FROM groups GROUP BY kept HAVING count(DISTINCT prefix) <= 32))""",
    training=False, extra=f"""
counts AS (
  SELECT {", ".join(_MERGE_PATH)}, count(*) AS n,
         [{", ".join(f"coalesce('=' || {c}, '')" for c in _MERGE_PATH)}] AS parts
  FROM staging GROUP BY ALL
),
prefixes AS (
  SELECT parts, n, level, list_slice(parts, 1, level) AS prefix FROM counts, range(0, {len(_MERGE_PATH) + 1}) t(level)
),
nodes AS (
  SELECT level, prefix, row_number() OVER (ORDER BY sum(n) DESC, level, prefix) AS place
  FROM prefixes GROUP BY level, prefix
),
groups AS (
  SELECT m.place AS kept, p.parts, max(p.level) AS level, arg_max(p.prefix, p.level) AS prefix,
         array_to_string(arg_max(p.prefix, p.level), '/') AS key
  FROM nodes m JOIN (SELECT * FROM prefixes JOIN nodes USING (level, prefix)) p ON p.place <= m.place
  WHERE m.place <= 32 * {len(_MERGE_PATH) + 1} + 1
  GROUP BY m.place, p.parts
)"""))
def q_segment_merge(spark, d):
    staged = Inputs(spark, d).staging()
    counts = staged.groupBy(*_MERGE_PATH).agg(F.count(F.lit(1)).alias("n"))
    return segments.merge_segments(counts, _MERGE_PATH, 32)


@register("top_segments", _with_lab("""
SELECT sector, company_segment, count(*) AS n FROM lab
GROUP BY sector, company_segment
ORDER BY n DESC, sector ASC NULLS FIRST, company_segment ASC NULLS FIRST LIMIT 3"""))
def q_top_segments(spark, d):
    lab = Inputs(spark, d).labelled()
    counts = lab.groupBy("sector", "company_segment").agg(F.count(F.lit(1)).alias("n"))
    return segments.top_k(counts, ["sector", "company_segment"], 3)


_SECTORED = """
sect AS (
  SELECT s.*, m.Sector AS sector FROM staging s
  LEFT JOIN (SELECT Code, Sector FROM nace_map WHERE Level = '2') m ON s.nace_primary_division = m.Code
)"""


def _with_sect(body: str) -> str:
    return W(body, training=False, extra=_SECTORED)


@register("sector_benchmark", _with_sect("""
SELECT l.sector, l.MunicipalityNL, l.n, l.region_mean, nat.national_mean, l.region_mean - nat.national_mean AS gap
FROM (SELECT sector, MunicipalityNL, count(*) AS n, round(avg(solvency_pct_n), 9) AS region_mean
      FROM sect GROUP BY sector, MunicipalityNL) l
LEFT JOIN (SELECT sector, round(avg(solvency_pct_n), 9) AS national_mean FROM sect GROUP BY sector) nat
  ON l.sector IS NOT DISTINCT FROM nat.sector"""))
def q_sector_benchmark(spark, d):
    i = Inputs(spark, d)
    return benchmark.sector_benchmark(segments.with_sector(i.staging(), i.nace_map()))


@register("sector_trend", _with_sect("""
SELECT sector, accounting_year, n, avg_roa_n, avg_solvency_pct_n,
       avg_roa_n - LAG(avg_roa_n, 1) OVER w AS change_roa_n,
       avg_solvency_pct_n - LAG(avg_solvency_pct_n, 1) OVER w AS change_solvency_pct_n
FROM (SELECT sector, accounting_year, count(*) AS n, round(avg(roa_n), 9) AS avg_roa_n,
             round(avg(solvency_pct_n), 9) AS avg_solvency_pct_n
      FROM sect GROUP BY sector, accounting_year)
WINDOW w AS (PARTITION BY sector ORDER BY accounting_year ASC NULLS FIRST)"""))
def q_sector_trend(spark, d):
    i = Inputs(spark, d)
    return benchmark.sector_trend(segments.with_sector(i.staging(), i.nace_map()))


_WINSOR_FEATURES = ["roa_y2", "solvency_y2", "liquidity_custom_y2", "debt_to_equity_y2", "ccf_revenue_y2"]


def _winsor_sql(body: str, more: str = "") -> str:
    """``body`` over q(feature, n, p99): the interpolated p99 from the values' ranks.  ``more``: further tables."""
    union = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM training WHERE {c} IS NOT NULL"
                               for c in _WINSOR_FEATURES)
    return W(body, extra=f"""
v AS ({union}),
r AS (SELECT feature, x, row_number() OVER (PARTITION BY feature ORDER BY x) - 1 AS rk,
             count(*) OVER (PARTITION BY feature) AS n FROM v),
p AS (SELECT DISTINCT feature, n, CAST(0.99 AS DOUBLE) * (n - 1) AS pos FROM r),
q AS (SELECT p.feature, p.n, lo.x + (hi.x - lo.x) * (p.pos - floor(p.pos)) AS p99
      FROM p JOIN r lo ON lo.feature = p.feature AND lo.rk = CAST(floor(p.pos) AS BIGINT)
             JOIN r hi ON hi.feature = p.feature AND hi.rk = CAST(ceil(p.pos) AS BIGINT)){more}""")


@register("winsorize_p99", _winsor_sql("SELECT feature, n, p99 FROM q"))
def q_winsorize_p99(spark, d):
    return segments.percentile_table(Inputs(spark, d).training(), _WINSOR_FEATURES, 0.99)


_CAPS = {c: f"(SELECT p99 FROM q WHERE feature = '{c}')" for c in _WINSOR_FEATURES}


@register("winsorized_features", _winsor_sql(f"""
SELECT enterprise_number, target_year_y3,
       {", ".join(f"CASE WHEN {c} > {cap} THEN {cap} ELSE {c} END AS {c}" for c, cap in _CAPS.items())}
FROM training"""))
def q_winsorized_features(spark, d):
    """The features capped at their p99 as values: NULL stays NULL."""
    t = Inputs(spark, d).training().select("enterprise_number", "target_year_y3", *_WINSOR_FEATURES)
    return segments.winsorize(t, _WINSOR_FEATURES)


def _each_feature(form: str) -> str:
    return ", ".join(f"{form.format(c=c, cap=_CAPS[c])} AS {c}" for c in _WINSOR_FEATURES)


@register("kmeans_step", _winsor_sql("""
SELECT variant, cluster, count(*) AS n, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY variant) AS share,
       CAST(count(*) FILTER (was <> cluster) AS BIGINT) AS moved, round(ln(1 + sum(apart)), 6) AS log_inertia
FROM near GROUP BY variant, cluster""", f""",
{_LAB},
w AS (SELECT 'raw' AS variant, enterprise_number AS e, target_year_y3 AS y, rule_cluster AS was, {_each_feature("COALESCE({c}, 0)")} FROM lab
      UNION ALL SELECT 'capped', enterprise_number, target_year_y3, rule_cluster,
                       {_each_feature("CASE WHEN {c} > {cap} THEN {cap} ELSE {c} END")} FROM lab),
z AS (SELECT variant, e, y, was, {_each_feature(
    "CASE WHEN variant = 'raw' THEN {c} ELSE COALESCE(({c} - avg({c}) OVER (PARTITION BY variant)) / "
    "NULLIF(stddev_pop({c}) OVER (PARTITION BY variant), 0), 0) END")} FROM w),
m AS (SELECT variant, was AS cluster, {_each_feature("avg({c})")} FROM z GROUP BY variant, was),
near AS (SELECT z.variant, z.was, m.cluster, {" + ".join(f"(z.{c} - m.{c}) * (z.{c} - m.{c})" for c in _WINSOR_FEATURES)} AS apart
         FROM z JOIN m ON z.variant = m.variant
         QUALIFY row_number() OVER (PARTITION BY z.variant, z.e, z.y ORDER BY apart, m.cluster) = 1)"""))
def q_kmeans_step(spark, d):
    """One Lloyd step from the rule clusters, on raw ratios and on capped and standardised ones."""
    i = Inputs(spark, d)
    caps = {c: cap for c, (_, cap) in segments.exact_percentiles(i.training(), _WINSOR_FEATURES, 0.99).items()}
    rows = i.labelled().select("rule_cluster", *[F.col(c).cast("double").alias(c) for c in _WINSOR_FEATURES]).checkpoint()
    variants = {"raw": rows.fillna(0.0, _WINSOR_FEATURES),
                "capped": segments.standardised(segments.capped(rows, caps), _WINSOR_FEATURES)}
    parts = [segments.step_facts(segments.lloyd_step(df, "rule_cluster", _WINSOR_FEATURES), "rule_cluster").withColumn("variant", F.lit(v))
             for v, df in variants.items()]
    return parts[0].unionByName(parts[1])


_PROFILE_FEATURES = ["roa_y2", "solvency_y2", "liquidity_custom_y2", "ccf_revenue_y2", "trend_delta_ccf_revenue"]
# Reference: clusters with more than 5000 members of ~277k rows, here as a share of all rows.
PROFILE_MIN_SHARE = 0.018


@register("cluster_profile", _with_lab(f"""
SELECT rule_cluster, count(*) AS n, {", ".join(f"round(avg({c}), 9) AS avg_{c}" for c in _PROFILE_FEATURES)}
FROM lab GROUP BY rule_cluster HAVING count(*) >= (SELECT count(*) FROM lab) * CAST({PROFILE_MIN_SHARE} AS DOUBLE)"""))
def q_cluster_profile(spark, d):
    return segments.cluster_profile(Inputs(spark, d).labelled(), "rule_cluster", _PROFILE_FEATURES,
                                    min_share=PROFILE_MIN_SHARE)


@register("cluster_mix", _with_lab("""
SELECT rule_cluster, company_segment, count(*) AS n,
       CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY rule_cluster) AS share
FROM lab GROUP BY rule_cluster, company_segment"""))
def q_cluster_mix(spark, d):
    return segments.category_mix(Inputs(spark, d).labelled(), "rule_cluster", "company_segment")


@register("metrics_from_scores", _with_lab("""
SELECT c.*, a.roc_auc FROM (
  SELECT split, n, tp, fp, tn, fn,
         CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0) AS precision,
         CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0) AS recall,
         CAST(tp + tn AS DOUBLE) / n AS accuracy,
         2 * (CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0)) * (CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0))
           / NULLIF(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0) + CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0) AS f1,
         log_loss
  FROM (SELECT split, count(*) AS n,
          CAST(sum(CASE WHEN score >= 0.5 AND is_high_risk = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
          CAST(sum(CASE WHEN score >= 0.5 AND is_high_risk = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
          CAST(sum(CASE WHEN score < 0.5 AND is_high_risk = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
          CAST(sum(CASE WHEN score < 0.5 AND is_high_risk = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
          round(-avg(is_high_risk * ln(least(greatest(score, 1e-15), 1 - 1e-15))
                     + (1 - is_high_risk) * ln(1 - least(greatest(score, 1e-15), 1 - 1e-15))), 10) AS log_loss
        FROM lab GROUP BY split)) c
JOIN (
  SELECT split, sum(pos * (below + neg * 0.5)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS roc_auc
  FROM (SELECT *, COALESCE(sum(neg) OVER (PARTITION BY split ORDER BY score
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (SELECT split, score, sum(is_high_risk) AS pos, sum(1 - is_high_risk) AS neg
              FROM lab GROUP BY split, score))
  GROUP BY split) a ON a.split = c.split"""))
def q_metrics_from_scores(spark, d):
    lab = Inputs(spark, d).labelled()
    return metrics.classification_report(lab, ["split"], label="is_high_risk", score="score")


# ------------------------------------------------------------------ sources, ledger, ingest

from kredo.sources import loaders, sinks  # noqa: E402
from kredo.streaming import ingest  # noqa: E402

_SCALARS = list(fx.schemas.FILING_FIELDS)
_FLAT_SQL = W(f"""
SELECT {", ".join("f." + c for c in _SCALARS)}, f.filing_year, COALESCE(rc.n, 0) AS n_rubrics
FROM filings f LEFT JOIN (SELECT ReferenceNumber, count(*) AS n FROM rubrics GROUP BY ReferenceNumber) rc
  ON rc.ReferenceNumber = f.ReferenceNumber""", staging=False, training=False)


def _flat_out(df: DataFrame) -> DataFrame:
    return df.select(*_SCALARS, F.col("filing_year").cast("bigint").alias("filing_year"),
                     F.coalesce(F.size("Rubrics"), F.lit(0)).cast("bigint").alias("n_rubrics"))


@register("filing_flatten", _FLAT_SQL)
def q_filing_flatten(spark, d):
    """Filings serialised to the landed two-document JSON shape, parsed back and flattened."""
    nested = loaders.nest_filings(Inputs(spark, d).filings())
    text = nested.select(F.to_json(F.struct("EnterpriseNumber", "data", "reference")).alias("j"), "filing_year")
    parsed = text.select(F.from_json("j", fx.schemas.RAW_FILING).alias("p"), "filing_year").select("p.*", "filing_year")
    return _flat_out(loaders.flatten_filings(parsed))


# What lands beside the filings: end dates that are none, enterprises without filings, broken lines.
_BAD_END = "ReferenceNumber LIKE '%7'"
_EMPTY = "o_orderkey % 11 = 0"
_BROKEN = "o_orderkey % 13 = 0"


#: Lines of a landed file: some 20 MB of text, so that a task's files are sorted in memory.
LANDED_LINES = 5000


def _ingested(spark, d) -> tuple[str, str]:
    """(sink, ledger) after two arrivals of landed lines and one run over nothing new."""
    import uuid
    from kredo.session import shared_path
    root = shared_path(spark, "kredo-ingest", uuid.uuid4().hex)
    landing, sink, ledger, ckpt = (f"{root}/{x}" for x in ("landing", "sink", "ledger", "checkpoint"))
    f = Inputs(spark, d).filings().withColumn("EndDate", F.expr(f"CASE WHEN {_BAD_END} THEN 'unknown' ELSE EndDate END"))
    lines = loaders.nest_filings(f).select("filing_year", F.to_json(F.struct(
        "EnterpriseNumber", F.col("filing_year").alias("FilingYear"), "data", "reference")).alias("value"))
    orders = fx.table(spark, d, "orders")
    empty = orders.where(_EMPTY).selectExpr("2019L AS filing_year", f"{fx.dotted('o_custkey')} AS EnterpriseNumber").select(
        "filing_year", F.to_json(F.struct("EnterpriseNumber", F.col("filing_year").alias("FilingYear"))).alias("value"))
    broken = orders.where(_BROKEN).selectExpr("2023L AS filing_year", "concat('{\"EnterpriseNumber\": \"', o_orderkey) AS value")
    for arrival in ("filing_year <= 2022", "filing_year > 2022"):
        for part in (lines, empty, broken):
            # Compressed, a filing's 100 rubrics are a fraction of their text; files are small, as one task reads a file.
            part.where(arrival).select("value").write.mode("append").options(
                compression="gzip", maxRecordsPerFile=LANDED_LINES).text(landing)
        ingest.run_ingest(spark, landing, sink, ledger, ckpt)
    ingest.run_ingest(spark, landing, sink, ledger, ckpt)      # nothing new: must add no rows
    return sink, ledger


@register("ingest_stream", W(f"""
SELECT {", ".join("f." + c for c in _SCALARS if c != "EndDate")},
       CASE WHEN f.{_BAD_END} THEN 'unknown' ELSE f.EndDate END AS EndDate, f.filing_year, COALESCE(rc.n, 0) AS n_rubrics
FROM filings f LEFT JOIN (SELECT ReferenceNumber, count(*) AS n FROM rubrics GROUP BY ReferenceNumber) rc
  ON rc.ReferenceNumber = f.ReferenceNumber""", staging=False, training=False))
def q_ingest_stream(spark, d):
    """Stream = batch: the filings of the sink; broken end dates keep the requested year."""
    return _flat_out(ingest.read_sink(spark, _ingested(spark, d)[0]))


@register("ingest_ledger", W(f"""
SELECT EnterpriseNumber, filing_year, bool_or(has_filings) AS has_filings FROM (
  SELECT EnterpriseNumber, CAST(filing_year AS BIGINT) AS filing_year, true AS has_filings FROM filings
  UNION ALL SELECT {fx.dotted('o_custkey')}, CAST(2019 AS BIGINT), false FROM orders WHERE {_EMPTY})
GROUP BY EnterpriseNumber, filing_year""", staging=False, training=False))
def q_ingest_ledger(spark, d):
    """The ledger that the stream writes: enterprises with filings, and those asked for without."""
    return ingest.read_ledger(spark, _ingested(spark, d)[1])


@register("ingest_rejects", f"SELECT '{{\"EnterpriseNumber\": \"' || o_orderkey AS line FROM orders WHERE {_BROKEN}")
def q_ingest_rejects(spark, d):
    """The landed lines that are no documents."""
    return ingest.read_rejects(spark, _ingested(spark, d)[0]).select("line")


# A register field with everything that a CSV must survive: quotes, a comma, a newline, Latin-1, a last backslash.
_EXTRA = {"spark": "concat('Bus \"', Zipcode, '\", \u00e9tage', char(10), TypeOfAddress, '\\\\')",
          "duckdb": "'Bus \"' || Zipcode || '\", \u00e9tage' || chr(10) || TypeOfAddress || chr(92)"}


def _registers(spark, d) -> tuple[str, dict[str, int]]:
    """Registers written as Latin-1 CSV and loaded by the job: (folder, counted rows)."""
    import uuid
    from kredo.session import shared_path
    root = shared_path(spark, "kredo-registers", uuid.uuid4().hex)
    texts = {"dim_enterprise": fx.dim_enterprise_text(spark, d), "dim_activity": fx.dim_activity_text(spark, d),
             "dim_address": fx.dim_address_text(spark, d).withColumn("ExtraAddressInfo", F.expr(_EXTRA["spark"]))}
    for t, df in texts.items():
        (df.write.option("header", "true").option("quoteAll", "true").option("escape", '"')
           .option("encoding", "ISO-8859-1").csv(f"{root}/csv/{t}.csv"))
    return f"{root}/tables", loaders.load_dimensions(spark, f"{root}/csv", f"{root}/tables", list(texts))


@register("dimension_load", W(f"""
SELECT EntityNumber, TypeOfAddress, Zipcode, MunicipalityNL, {_EXTRA["duckdb"]} AS ExtraAddressInfo, DateStrikingOff
FROM dim_address""", staging=False, training=False))
def q_dimension_load(spark, d):
    """Addresses after the load job, from CSV with quotes, newlines and backslashes."""
    return sinks.read_table(spark, f"{_registers(spark, d)[0]}/dim_address").select(
        "EntityNumber", "TypeOfAddress", "Zipcode", "MunicipalityNL", "ExtraAddressInfo", "DateStrikingOff")


@register("dimension_counts", W("""
SELECT 'dim_enterprise' AS table_name, count(*) AS n FROM dim_enterprise
UNION ALL SELECT 'dim_address', count(*) FROM dim_address
UNION ALL SELECT 'dim_activity', count(*) FROM dim_activity""", staging=False, training=False))
def q_dimension_counts(spark, d):
    """The row counts that the load job's writes report."""
    return spark.createDataFrame(list(_registers(spark, d)[1].items()), "table_name string, n bigint")


_DOTTED_ORDERS = fx.dotted("o_custkey")


@register("distinct_enterprises", W(f"SELECT DISTINCT {_DOTTED_ORDERS} AS EnterpriseNumber FROM orders",
                                    staging=False, training=False))
def q_distinct_enterprises(spark, d):
    return loaders.distinct_enterprises(fx.enterprise_list(spark, d))


_YEARS = "(SELECT DISTINCT CAST(filing_year AS BIGINT) AS filing_year FROM filings)"


def _filing_years(spark, d) -> list[int]:
    """The year tables there are (one row each)."""
    years = Inputs(spark, d).filings().select(F.col("filing_year").cast("bigint")).distinct().collect()
    return sorted(r[0] for r in years if r[0] is not None)


@register("resume_anti_join", W(f"""
SELECT e.EnterpriseNumber, y.filing_year FROM (SELECT DISTINCT {_DOTTED_ORDERS} AS EnterpriseNumber FROM orders) e
CROSS JOIN {_YEARS} y
WHERE NOT EXISTS (SELECT 1 FROM filings f WHERE f.EnterpriseNumber = e.EnterpriseNumber
                  AND f.filing_year = y.filing_year)""", staging=False, training=False))
def q_resume_anti_join(spark, d):
    """The enterprises still to be fetched, for every year."""
    ledger = Inputs(spark, d).filings().select("EnterpriseNumber", F.col("filing_year").cast("bigint").alias("filing_year"))
    ids = fx.enterprise_list(spark, d)
    return loaders.pending(ids, ledger, _filing_years(spark, d))


@register("ledger_update", W(f"""
SELECT e.EnterpriseNumber, y.filing_year, EXISTS (
  SELECT 1 FROM filings f WHERE f.EnterpriseNumber = e.EnterpriseNumber AND f.filing_year = y.filing_year) AS has_filings
FROM (SELECT DISTINCT {_DOTTED_ORDERS} AS EnterpriseNumber FROM orders) e CROSS JOIN {_YEARS} y""",
                              staging=False, training=False))
def q_ledger_update(spark, d):
    """The ledger lines of a run over every year."""
    ids, filings = fx.enterprise_list(spark, d), Inputs(spark, d).filings()
    return loaders.ledger_rows(ids, filings, _filing_years(spark, d))


@register("date_normalise", W("""
SELECT 'dim_enterprise' AS source, t.EnterpriseNumber AS entity, t.StartDate AS raw_date, e.StartDate AS parsed_date
FROM dim_enterprise_text t JOIN dim_enterprise e USING (EnterpriseNumber)
UNION ALL
SELECT 'dim_address', EntityNumber, DateStrikingOff_raw, DateStrikingOff FROM (
  SELECT a.*, t.DateStrikingOff AS DateStrikingOff_raw FROM dim_address a
  JOIN dim_address_text t USING (EntityNumber, TypeOfAddress))""", staging=False, training=False))
def q_date_normalise(spark, d):
    from pyspark.sql import types as T
    e = fx.dim_enterprise_text(spark, d)
    e = e.select(F.lit("dim_enterprise").alias("source"), F.col("EnterpriseNumber").alias("entity"),
                 F.col("StartDate").alias("raw_date"), F.col("StartDate").alias("_d"))
    a = fx.dim_address_text(spark, d)
    a = a.select(F.lit("dim_address").alias("source"), F.col("EntityNumber").alias("entity"),
                 F.col("DateStrikingOff").alias("raw_date"), F.col("DateStrikingOff").alias("_d"))
    both = e.unionByName(a)
    return loaders.normalise_dates(both.withColumnRenamed("_d", "parsed_date"),
                                   T.StructType([T.StructField("parsed_date", T.DateType())]))


@register("year_scan_pruned", W(f"""
SELECT filing_year, count(*) AS n FROM filings
WHERE filing_year BETWEEN {codes.SCAN_YEAR_MIN} AND {codes.SCAN_YEAR_MAX} GROUP BY filing_year""",
                                staging=False, training=False))
def q_year_scan_pruned(spark, d):
    f = accounts.scan_years(Inputs(spark, d).filings())
    return f.groupBy("filing_year").agg(F.count(F.lit(1)).alias("n"))


@register("staging_layout", W("""
SELECT enterprise_number, accounting_year, company_segment, total_assets_n FROM staging""", training=False))
def q_staging_layout(spark, d):
    """The staging table written in its layout (year folders, clustered by enterprise) and read back."""
    import uuid
    from kredo.session import shared_path
    path = shared_path(spark, "kredo-staging", uuid.uuid4().hex)
    sinks.write_staging(Inputs(spark, d).staging(), path)
    return spark.read.parquet(path).select(
        "enterprise_number", F.col("accounting_year").cast("bigint").alias("accounting_year"), "company_segment",
        "total_assets_n")


@register("staging_replaced", W("""
SELECT enterprise_number, accounting_year, company_segment, total_assets_n FROM staging""", training=False))
def q_staging_replaced(spark, d):
    """The staging table after its replacement: its first year alone, then all years."""
    import uuid
    from kredo.session import shared_path
    path = shared_path(spark, "kredo-staging", uuid.uuid4().hex)
    staged = sinks.once(Inputs(spark, d).staging(mode="fold"))     # the sums of preferred filings alone are exchanged
    sinks.replace_staging(staged.where(F.col("accounting_year") == codes.SCAN_YEAR_MIN), path, stored=True)
    sinks.replace_staging(staged, path, stored=True)
    return sinks.read_table(spark, path).select(
        "enterprise_number", F.col("accounting_year").cast("bigint").alias("accounting_year"), "company_segment",
        "total_assets_n")


def _refreshed(spark, d) -> str:
    """Folder of the staging and training tables after all filings came in three batches."""
    import uuid
    from kredo.session import shared_path
    root, i = shared_path(spark, "kredo-refresh", uuid.uuid4().hex), Inputs(spark, d)
    filings = i.filings()
    for k in range(3):
        part = filings.where(F.pmod(F.xxhash64("ReferenceNumber"), F.lit(3)) == k)
        incremental.refresh(spark, root, k, part, i.dim_enterprise(), i.dim_address(), i.dim_activity(), buckets=8)
    return root


@register("staging_incremental", W("SELECT * FROM staging", training=False))
def q_staging_incremental(spark, d):
    """The staging table, kept up to date batch by batch."""
    return sinks.read_cells(spark, f"{_refreshed(spark, d)}/staging").drop("clean_enterprise_number")


@register("training_incremental", W("SELECT * FROM training"))
def q_training_incremental(spark, d):
    """The training table, kept up to date batch by batch."""
    return sinks.read_cells(spark, f"{_refreshed(spark, d)}/training")


@register("enterprise_list_csv", W(f"SELECT {_DOTTED_ORDERS} AS EnterpriseNumber, count(*) AS listed FROM orders GROUP BY 1",
                                   staging=False, training=False))
def q_enterprise_list_csv(spark, d):
    """How often each enterprise stands on the list, read from CSV as text."""
    import uuid
    from kredo.session import shared_path
    path = shared_path(spark, "kredo-list", uuid.uuid4().hex)
    fx.enterprise_list(spark, d).write.option("header", "true").csv(path)
    return loaders.read_enterprise_list(spark, path).groupBy("EnterpriseNumber").agg(F.count(F.lit(1)).alias("listed"))


@register("macro_load", W("""
SELECT s.accounting_year, m.interest_rate, m.inflation, count(*) AS n
FROM staging s LEFT JOIN macro m ON s.accounting_year = m.year GROUP BY ALL""", training=False))
def q_macro_load(spark, d):
    """Filings by year beside the indicators that were loaded from CSV."""
    import uuid
    from kredo.session import shared_path
    path = shared_path(spark, "kredo-macro", uuid.uuid4().hex)
    i = Inputs(spark, d)
    i.macro().write.option("header", "true").csv(path)
    joined = segments.with_macro(i.staging(), loaders.read_macro_csv(spark, path))
    return joined.groupBy("accounting_year", "interest_rate", "inflation").agg(F.count(F.lit(1)).alias("n"))


@register("row_count", W("""
SELECT 'dim_enterprise' AS table_name, count(*) AS n FROM dim_enterprise
UNION ALL SELECT 'dim_address', count(*) FROM dim_address
UNION ALL SELECT 'dim_activity', count(*) FROM dim_activity
UNION ALL SELECT 'dim_nace_mapping', count(*) FROM nace_map""", staging=False, training=False))
def q_row_count(spark, d):
    i = Inputs(spark, d)
    parts = [(name, df) for name, df in (("dim_enterprise", i.dim_enterprise()), ("dim_address", i.dim_address()),
                                         ("dim_activity", i.dim_activity()), ("dim_nace_mapping", i.nace_map()))]
    out = None
    for name, df in parts:
        c = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = c if out is None else out.unionByName(c)
    return out


# ------------------------------------------------------------------ models (rows-only checks)

from kredo.operators import boosting, models  # noqa: E402


def _model_data(spark, d):
    """Training windows with the optional model inputs: lagged model type, sector, macro of year 2."""
    i = Inputs(spark, d)
    t = features.training_dataset(i.staging(keep_key=True), extra=models.EXTRA_LAGS).withColumn(
        "nace_primary_division", F.substring(F.replace("nace_primary_code", F.lit("."), F.lit("")), 1, 2))
    t = segments.with_sector(t, i.nace_map()).drop("nace_primary_division")
    return models.splits(t, macro=i.macro())


def _gbt_all(train, test):
    return models.evaluate(models.fit(train, models.gbt(models.GbtParams())), test, "gbt_all")


def _gbt_segments(train, test):
    keys = ["sector", "company_segment"]
    return models.per_group_metrics(train, test, keys, models.top_groups(train, keys, 3),
                                    models.GbtParams(), "gbt_segment_")


def _clusters(train, test):
    return models.kmeans_clusters(train, test)


def _gbt_clusters(train, test):
    c = _clusters(train, test).checkpoint()
    tr, te = c.where(F.col("split") == "train"), c.where(F.col("split") == "eval")
    return models.per_group_metrics(tr.drop(models.WEIGHT), te, ["cluster"], models.top_groups(tr, ["cluster"], 3),
                                    models.GbtParams(), "gbt_cluster_")


def _logreg(train, test):
    return models.report(models.logreg_scored(train, test), "logreg")


def _forest(train, test):
    return models.evaluate(models.fit(train, models.forest()), test, "random_forest")


@register("gbt_metrics")
def q_gbt_metrics(spark, d):
    """Boosted trees, no segmentation: six hold-out metrics (out-of-time split)."""
    return _gbt_all(*_model_data(spark, d))


@register("gbt_importance")
def q_gbt_importance(spark, d):
    """Split count and mean gain per feature of the unsegmented model, largest gain first."""
    train, _ = _model_data(spark, d)
    m = models.fit(train, models.gbt(models.GbtParams()))
    return models.importance(m, m.kredo_features).orderBy(F.col("gain").desc(), F.col("feature"))


@register("hyperparam_search")
def q_hyperparam_search(spark, d):
    """Ten seeded random draws over the reference's ranges, ranked by validation ROC AUC."""
    train, _ = _model_data(spark, d)
    best, table = models.search(train, models.draw_params(10, seed=42))
    return table.withColumn("best", (F.col("max_depth") == best.max_depth) & (F.col("step_size") == best.step_size)
                            & (F.col("subsample") == best.subsample) & (F.col("colsample") == best.colsample))


@register("hyperparam_tpe")
def q_hyperparam_tpe(spark, d):
    """Twelve trials over the same ranges, proposed from the earlier ones; poor ones end at a quarter of the trees."""
    train, _ = _model_data(spark, d)
    best, table = models.search_tpe(train, trials=12, seed=42)
    return table.withColumn("best", F.col("trial") == best)


@register("gbt_per_segment")
def q_gbt_per_segment(spark, d):
    """Stratified modelling: one model for each of the three largest (sector, size) segments."""
    return _gbt_segments(*_model_data(spark, d))


@register("kmeans_segments")
def q_kmeans_segments(spark, d):
    """k-means (k=32) on winsorised, standardised key ratios: members per cluster."""
    return _clusters(*_model_data(spark, d)).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@register("gbt_per_cluster")
def q_gbt_per_cluster(spark, d):
    """One model for each of the three largest k-means clusters."""
    return _gbt_clusters(*_model_data(spark, d))


@register("model_facts", _with_lab("""
SELECT 'kmeans rows' AS fact, count(*) AS n FROM lab
UNION ALL SELECT 'kmeans rows of training', CAST(count(*) FILTER (split = 'train') AS BIGINT) FROM lab
UNION ALL SELECT 'kmeans rows nearer to another centre', CAST(0 AS BIGINT)
UNION ALL SELECT 'logreg evaluation rows', CAST(count(*) FILTER (split = 'eval') AS BIGINT) FROM lab
UNION ALL SELECT 'logreg evaluation rows at risk', CAST(count(*) FILTER (split = 'eval' AND is_high_risk = 1) AS BIGINT) FROM lab
UNION ALL SELECT 'forest evaluation rows', CAST(count(*) FILTER (split = 'eval') AS BIGINT) FROM lab
UNION ALL SELECT 'forest split nodes without a feature', CAST(0 AS BIGINT)"""))
def q_model_facts(spark, d):
    """What any right fit must satisfy exactly: row counts, nearest centres, importance over all split nodes."""
    train, test = _model_data(spark, d)
    c = models.kmeans_clusters(train, test, keep_features=True).agg(
        F.count(F.lit(1)).alias("rows"), F.sum((F.col("split") == "train").cast("bigint")).alias("train"),
        F.sum(models.not_nearest().cast("bigint")).alias("far")).first()
    lr = _logreg(train, test).first()
    m = models.fit(train, models.forest())
    rf = models.evaluate(m, test, "random_forest").first()
    weight = models.importance(m, m.kredo_features).agg(F.sum("weight")).first()[0] or 0
    splits = sum((t.numNodes - 1) // 2 for t in m.stages[-1].trees)
    facts = {"kmeans rows": c["rows"], "kmeans rows of training": c["train"], "kmeans rows nearer to another centre": c["far"],
             "logreg evaluation rows": lr["n"], "logreg evaluation rows at risk": lr["tp"] + lr["fn"],
             "forest evaluation rows": rf["n"], "forest split nodes without a feature": splits - weight}
    return spark.createDataFrame(list(facts.items()), "fact string, n bigint")


#: Trees of ``boost_per_segment`` and ``boost_importance``: few and flat, as each level is a job; the library's default is 100.
BOOST = boosting.Params(trees=4, depth=3, rate=0.3)
_ROOT_FEATURES = ["company_segment", "sector"]


def _root_bins(feature: str) -> str:
    """Rows of one feature with the bin of their category: its place by weighted target mean, 0 for missing."""
    return f"""
  SELECT '{feature}' AS feature, coalesce(o.bin, 0) AS bin, t.w, t.y
  FROM weighted t LEFT JOIN (
    SELECT {feature}, row_number() OVER (ORDER BY round(sum(w * y) / sum(w), 12), {feature}) AS bin
    FROM weighted WHERE {feature} IS NOT NULL GROUP BY {feature}) o ON o.{feature} = t.{feature}"""


@register("boost_root_sums", _with_lab(f"""
, weighted AS (
  SELECT l.*, l.is_high_risk AS y, c.w
  FROM lab l JOIN (SELECT is_high_risk AS k, CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS w
                   FROM lab WHERE split = 'train' GROUP BY is_high_risk) c ON c.k = l.is_high_risk
  WHERE l.split = 'train'),
binned AS ({" UNION ALL ".join(map(_root_bins, _ROOT_FEATURES))})
SELECT feature, bin, round(sum(w * (0.5 - y)), 6) AS g, round(sum(w * 0.25), 6) AS h
FROM binned GROUP BY feature, bin"""))
def q_boost_root_sums(spark, d):
    """Gradient and hessian sums at the root of the first tree, by bins of categories in target order."""
    train = label.with_weights(Inputs(spark, d).labelled().where("split = 'train'"), "is_high_risk").withColumn("role", F.lit("train"))
    rows, names = boosting.binned(train, [], _ROOT_FEATURES, "is_high_risk", "class_weight", "role",
                                  ["enterprise_number", "target_year_y3"], p=boosting.Params(bins=64))
    rows = rows.withColumns({"node": F.lit(0), "margin": F.lit(0.0)})
    return boosting.histogram(rows, list(range(len(names)))).select(
        F.element_at(F.lit(names), F.col("feature") + 1).alias("feature"), F.col("bin").cast("bigint").alias("bin"),
        F.round("g", 6).alias("g"), F.round("h", 6).alias("h"))


@register("boost_metrics")
def q_boost_metrics(spark, d):
    """Trees with L2 and learnt missing sides, no segmentation: six hold-out metrics, with the library's parameters in full."""
    p = boosting.Params()
    rows, names = models.boost_rows(*_model_data(spark, d), p=p)
    return models.boost_metrics(boosting.fit(rows, len(names), p)[1])


@register("boost_per_segment")
def q_boost_per_segment(spark, d):
    """One model for every (sector, size) segment, all grown in the same passes: metrics a segment."""
    segment = F.concat_ws("/", F.coalesce("sector", F.lit("none")), "company_segment")
    rows, names = models.boost_rows(*_model_data(spark, d), group=segment, p=BOOST)
    return models.boost_metrics(boosting.fit(rows, len(names), BOOST)[1])


@register("boost_importance")
def q_boost_importance(spark, d):
    """Split count and mean gain per feature of the unsegmented trees."""
    rows, names = models.boost_rows(*_model_data(spark, d), p=BOOST)
    return boosting.importance(boosting.fit(rows, len(names), BOOST)[0], names).drop("grp")


@register("logreg_metrics")
def q_logreg_metrics(spark, d):
    return _logreg(*_model_data(spark, d))


@register("rf_metrics")
def q_rf_metrics(spark, d):
    return _forest(*_model_data(spark, d))


@register("model_comparison")
def q_model_comparison(spark, d):
    """Unsegmented vs sector segments vs clusters vs baselines, one metrics row per model.

    Every (sector, size) segment and every cluster has its model, and no category is left out for its number of values.
    The training data is prepared (and checkpointed) once and shared by all fits.
    """
    train, test = _model_data(spark, d)
    p, clustered = models.GbtParams(), _clusters(train, test).checkpoint()
    parts = [models.evaluate(models.fit(train, models.gbt(p), most=None), test, "gbt_all"),
             models.every_group_metrics(train, test, ["sector", "company_segment"], p, "gbt_segment_"),
             models.every_group_metrics(clustered.where("split = 'train'"), clustered.where("split = 'eval'"), ["cluster"], p,
                                        "gbt_cluster_"),
             models.report(models.logreg_scored(train, test, most=None), "logreg"),
             models.evaluate(models.fit(train, models.forest(), most=None), test, "random_forest")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("derive_filings", W("""
SELECT filing_year, count(*) AS n_filings, CAST(sum(COALESCE(rc.n, 0)) AS BIGINT) AS n_rubrics
FROM filings f LEFT JOIN (SELECT ReferenceNumber, count(*) AS n FROM rubrics GROUP BY ReferenceNumber) rc
  ON rc.ReferenceNumber = f.ReferenceNumber
GROUP BY filing_year""", staging=False, training=False))
def q_derive_filings(spark, d):
    """The derivation of the nested filings itself (orders x customer -> ~90 rubrics per filing), not stored."""
    f = fx.filings(spark, d)
    return f.groupBy(F.col("filing_year").cast("bigint").alias("filing_year")).agg(
        F.count(F.lit(1)).alias("n_filings"), F.sum(F.size("Rubrics")).cast("bigint").alias("n_rubrics"))
