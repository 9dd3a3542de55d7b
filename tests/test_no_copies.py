"""Rubric arrays and staging rows are not shuffled, sorted or stored more often than the job needs."""

import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import filing, filings_df
from kredo.operators import accounts, staging
from kredo.plans import catalog
from kredo.sources import fixtures as fx, schemas, sinks
from test_plans import _exchange_inputs, _plan, no_aqe_no_broadcast  # noqa: F401


@pytest.fixture(scope="module")
def stored(spark):
    """Filings of 40 enterprises in several files, read with their row ids: ties, repeats, NULL numbers, no rubrics."""
    rows = [filing(None if k % 17 == 0 else f"r{k % 150}", None if k % 23 == 0 else f"0{k % 40:09d}", f"{2020 + k % 4}-12-31",
                   model=("m02-f", "m01-f", "m02-p")[k % 3], lang=("NL", "FR")[k % 2],
                   rubrics=None if k % 13 == 0 else [("20/58", "N", str(k)), ("70", "NM1", "5"), ("70", "X", "7")][:k % 4])
            for k in range(400)]
    path = tempfile.mkdtemp(prefix="kredo-test-rows-")
    df = filings_df(spark, rows)
    df.repartition(5, "EndDate", "Language").write.mode("overwrite").partitionBy("filing_year").parquet(path)
    return spark.read.parquet(path).select(*schemas.FILING.fieldNames(), F.col("filing_year").cast("bigint").alias("filing_year"),
                                           fx.file_row_id())


def test_rows_are_picked_by_bitmaps_or_by_join_alike(spark, stored, monkeypatch, no_aqe_no_broadcast):  # noqa: F811
    ids = stored.where("pmod(hash(ReferenceNumber, Language, EndDate), 3) = 1").select("_filing_id")
    want = sorted(map(str, ids.collect()))
    picked = staging.at_rows(stored, ids)
    assert picked.columns == stored.columns and not [x for x in _exchange_inputs(_plan(picked)) if "Rubrics" in x]
    assert sorted(map(str, picked.select("_filing_id").collect())) == want and len(want) > 50
    assert staging.at_rows(stored, ids.limit(0)).count() == 0
    monkeypatch.setattr(staging, "BITMAP_BYTES", 0)
    assert sorted(map(str, staging.at_rows(stored, ids).select("_filing_id").collect())) == want
    monkeypatch.setattr(staging, "BITMAP_BYTES", 128 << 20)
    monkeypatch.setattr(staging, "BITS", 16)                      # many bitmaps a file
    assert sorted(map(str, staging.at_rows(stored, ids).select("_filing_id").collect())) == want


def test_preferred_filings_are_those_of_the_window(stored):
    cols = ["EnterpriseNumber", "accounting_year", "ReferenceNumber", "ModelType", "Language"]     # as they rank: ties agree
    a = staging.preferred_filings(stored).select(*cols).collect()
    b = accounts.preferred_accounts(stored).select(*cols).collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) > 40


@pytest.mark.parametrize("name", ["rubrics_unnest", "financials_base_literal", "staging_master_join", "staging_master_fold"])
def test_rubrics_are_not_exchanged(spark, sf_dir, name, no_aqe_no_broadcast):  # noqa: F811
    df = catalog.QUERIES[name](spark, sf_dir)
    found = _exchange_inputs(_plan(df))
    assert found and not [x for x in found if "Rubrics" in x]


def test_the_staging_rows_of_a_replacement_are_made_once(spark, sf_dir, monkeypatch):
    made = []
    monkeypatch.setattr(sinks, "once", lambda df, once=sinks.once: made.append(1) or once(df))
    got = catalog.q_staging_replaced(spark, sf_dir)
    assert len(made) == 1 and got.count() == catalog.q_staging_master(spark, sf_dir).count()


def test_the_sink_builds_no_dictionary_of_rubric_values(spark, stored):
    import glob
    import pyarrow.parquet as pq
    path = tempfile.mkdtemp(prefix="kredo-test-sink-")
    sinks.replace_partitions(stored.drop("_filing_id").withColumn("batch", F.lit(0)), path, ["batch", "filing_year"])
    files = [pq.ParquetFile(f).metadata.row_group(0) for f in glob.glob(f"{path}/*/*/*.parquet")]
    columns = [g.column(i) for g in files for i in range(g.num_columns) if g.column(i).path_in_schema.endswith("element.Value")]
    assert columns and not any("DICTIONARY" in e for c in columns for e in c.encodings)
    assert spark.read.parquet(path).count() == stored.count()
