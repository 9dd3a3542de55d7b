"""Plan checks: the physical plans have the shape the README claims."""

import os
import re
import tempfile

import pytest

from kredo.operators import accounts, features
from kredo.plans.catalog import Inputs
from kredo.sources import fixtures


def _plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture
def no_aqe_no_broadcast(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _exchange_inputs(plan: str) -> list[str]:
    """The 'Input' lists of the Exchange nodes of a formatted plan."""
    out = []
    for sec in re.split(r"\n\(\d+\) ", plan):
        if sec.startswith("Exchange"):
            m = re.search(r"Input \[\d+\]: \[(.*?)\]\n", sec)
            out.append(m.group(1) if m else "")
    return out


def test_dedup_has_partial_top1_before_shuffle(spark, sf_dir, no_aqe_no_broadcast):
    p = _plan(accounts.preferred_accounts(Inputs(spark, sf_dir).filings()), "simple")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_staging_never_shuffles_rubric_arrays(spark, sf_dir, no_aqe_no_broadcast):
    plan = _plan(Inputs(spark, sf_dir).staging())
    ins = _exchange_inputs(plan)
    assert ins, "expected exchanges"
    assert not any("Rubrics" in i for i in ins)


def test_lag_window_reuses_join_partitioning(spark, sf_dir, no_aqe_no_broadcast):
    plan = _plan(Inputs(spark, sf_dir).training(), "simple")
    windows = [ln for ln in plan.splitlines() if "lag(" in ln and "Window [" in ln]
    assert len(windows) == 1                          # all 36 lags in one Window node (one sort)
    exchanges = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
    # No exchange keyed on the raw number: the lags reuse the clean-number join partitioning.
    assert not any(re.search(r"hashpartitioning\(enterprise_number#", ln) for ln in exchanges)


def test_year_scan_is_a_partition_filter(spark, sf_dir):
    out = os.path.join(tempfile.mkdtemp(prefix="kredo-test-scan-"), "filings")
    fixtures.filings(spark, sf_dir).write.partitionBy("filing_year").parquet(out)
    scanned = accounts.scan_years(spark.read.parquet(out))
    p = _plan(scanned, "simple")
    assert re.search(r"PartitionFilters: \[[^\]]*filing_year", p)
    assert scanned.select("filing_year").distinct().count() == 6


def test_features_window_is_keyed_by_clean_number(spark, sf_dir):
    s = Inputs(spark, sf_dir).staging(keep_key=True)
    assert "clean_enterprise_number" in s.columns
    assert "clean_enterprise_number" not in features.training_dataset(s).columns


def test_bucketed_filings_are_never_shuffled(spark, sf_dir, no_aqe_no_broadcast):
    from kredo.plans.catalog import Inputs
    from kredo.operators import staging
    from kredo.sources import sinks
    path = os.path.join(tempfile.mkdtemp(prefix="kredo-test-bucket-"), "filings")
    sinks.save_filings_bucketed(fixtures.stored_filings(spark, sf_dir), "kredo_test_filings", path, 8)
    i = Inputs(spark, sf_dir)
    f = spark.table("kredo_test_filings")
    s = staging.staging_with_key(f, i.dim_enterprise(), i.dim_address(), i.dim_activity())
    plan = _plan(features.training_dataset(s), "simple")
    exchanges = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
    # The dimensions move to the buckets; no filing is shuffled for its sums, its deduplication or its number.
    assert not any("accounting_year" in ln or "ReferenceNumber" in ln for ln in exchanges)
    assert 0 < len(exchanges) <= 6
    assert not any("Rubrics" in i for i in _exchange_inputs(_plan(s)))
    # Same rows as the unbucketed plan.
    a = features.training_dataset(s).drop("clean_enterprise_number")
    b = i.training()
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_financials_base_adds_no_shuffle_after_dedup(spark, sf_dir, no_aqe_no_broadcast):
    from kredo.operators import financials
    plan = _plan(financials.financials_base(accounts.preferred_accounts(Inputs(spark, sf_dir).filings())), "simple")
    assert len([ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]) == 1


def test_activity_filter_reaches_the_parquet_scan(spark, sf_dir):
    from kredo.operators import dimensions
    path = os.path.join(tempfile.mkdtemp(prefix="kredo-test-dim-"), "dim_activity")
    fixtures.dim_activity(spark, sf_dir).write.parquet(path)
    plan = _plan(dimensions.pivoted_activities(spark.read.parquet(path)), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "NaceVersion" in pushed and "Classification" in pushed and "ActivityGroup" in pushed
    assert re.search(r"ReadSchema: struct<EnterpriseNumber:string,ActivityGroup:string,NaceVersion:string,"
                     r"NaceCode:string,Classification:string>", plan)


def test_rubrics_are_read_by_one_scan_only(spark, sf_dir, no_aqe_no_broadcast):
    plan = _plan(Inputs(spark, sf_dir).staging())
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plan)
    assert sum("Rubrics:" in s for s in schemas) == 1
    assert any("_n_rubrics" in s and ",Rubrics:" not in s for s in schemas)


def _nodes(plan: str, name: str) -> list[str]:
    return [ln for ln in plan.splitlines() if re.search(rf"\b{name}\b", ln)]


def test_the_sums_are_not_sorted_for_the_choice_of_filings(spark, sf_dir, no_aqe_no_broadcast):
    """The deduplication sorts the filings' own columns; the 70 sums meet the chosen ones by a hash of the narrow side."""
    from kredo.operators import staging
    plan = _plan(staging.preferred_with_financials(Inputs(spark, sf_dir).filings(), literal=False))
    windows = [sec for sec in re.split(r"\n\(\d+\) ", plan) if sec.startswith("Window")]
    assert windows and not any("revenue_n" in w for w in windows)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_fold_sorts_no_rubric_arrays(spark, sf_dir, no_aqe_no_broadcast):
    from kredo.operators import staging
    plan = _plan(staging.preferred_filings(Inputs(spark, sf_dir).filings()))
    sorts = [sec for sec in re.split(r"\n\(\d+\) ", plan) if sec.startswith("Sort") or sec.startswith("Window")]
    assert sorts and not any("Rubrics" in s for s in sorts)


def test_preferred_filings_are_the_preferred_accounts(spark, sf_dir):
    from kredo.operators import staging
    f = Inputs(spark, sf_dir).filings()
    cols = ["ReferenceNumber", "EnterpriseNumber", "accounting_year", "Rubrics"]
    a, b = staging.preferred_filings(f).select(*cols), accounts.preferred_accounts(f).select(*cols)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_a_rubric_is_placed_once(spark, sf_dir):
    """Period and code of a rubric are read in the filter and once for the place: not again for every code."""
    from kredo.operators import financials
    plan = _plan(financials.unnest_summed(Inputs(spark, sf_dir).filings(), ["_filing_id"]), "simple")
    assert plan.count(".Code") <= 2 and plan.count(".Period") <= 3
