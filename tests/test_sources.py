import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from helpers import filing, filings_df, healthy
from kredo.sources import loaders
from kredo.streaming import ingest


def test_csv_dimension_load(spark):
    d = tempfile.mkdtemp(prefix="kredo-test-csv-")
    p = os.path.join(d, "enterprise.csv")
    text = ('EnterpriseNumber,Status,JuridicalSituation,TypeOfEnterprise,JuridicalForm,JuridicalFormCAC,StartDate\n'
            '0200.065.765,AC,000,2,417,,09-08-1960\n'
            '"0200.068.636",AC,000,2,"Société\nanonyme",,1960-08-09,extra\n'
            '0200.171.970,AC,012,2,417,,bad\n')
    with open(p, "wb") as fh:
        fh.write(text.encode("iso-8859-1"))
    df = loaders.read_dimension_csv(spark, p, "dim_enterprise")
    rows = df.orderBy("EnterpriseNumber").collect()
    assert len(rows) == 3
    assert rows[1]["JuridicalForm"] == "Société\nanonyme"
    assert [r["StartDate"] for r in rows] == [dt.date(1960, 8, 9), dt.date(1960, 8, 9), None]
    n = loaders.write_counted(df, os.path.join(d, "out"))
    assert n == 3


def test_flatten_defaults(spark):
    raw = spark.createDataFrame([("1", {"referenceNumber": "R"}, None)],
                                "EnterpriseNumber string, data struct<referenceNumber:string>, "
                                "reference struct<ModelType:string>")
    raw = raw.select("EnterpriseNumber", F.from_json(F.to_json("data"), loaders.schemas.RAW_FILING["data"].dataType)
                     .alias("data"), F.from_json(F.to_json("reference"),
                                                 loaders.schemas.RAW_FILING["reference"].dataType).alias("reference"))
    r = loaders.flatten_filings(raw).first()
    assert r["ReferenceNumber"] == "R" and r["StartDate"] is None and r["Rubrics"] == []


def test_ledger_and_resume(spark):
    ids = spark.createDataFrame([("1",), ("2",), ("2",), ("3",)], "EnterpriseNumber string")
    committed = spark.createDataFrame([("1", 2021), ("2", 2020)], "EnterpriseNumber string, filing_year long")
    led = loaders.ledger_rows(ids, committed, 2021)
    got = sorted((r[0], r[1], r[2]) for r in led.collect())
    assert got == [("1", 2021, True), ("2", 2021, False), ("3", 2021, False)]
    assert loaders.pending(ids, led, 2021).count() == 0
    assert loaders.pending(ids, led, 2022).count() == 3          # ledger keyed by year


def test_stream_ingest_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="kredo-test-ingest-")
    landing, sink, ledger, ckpt = (os.path.join(root, x) for x in ("landing", "sink", "ledger", "ckpt"))
    rows = [filing(f"R{i}", str(i % 3), f"{2020 + i % 3}-12-31", rubrics=healthy()) for i in range(9)]
    nested = loaders.nest_filings(filings_df(spark, rows)).drop("filing_year")
    nested.limit(4).write.mode("append").json(landing)
    ingest.run_ingest(spark, landing, sink, ledger, ckpt)
    nested.subtract(nested.limit(4)).write.mode("append").json(landing)
    ingest.run_ingest(spark, landing, sink, ledger, ckpt)
    ingest.run_ingest(spark, landing, sink, ledger, ckpt)
    out = ingest.read_sink(spark, sink)
    assert out.count() == 9
    assert sorted(r[0] for r in out.select("ReferenceNumber").collect()) == sorted(f"R{i}" for i in range(9))
    assert out.where(F.size("Rubrics") == len(healthy())).count() == 9
    pairs = {(str(i % 3), 2020 + i % 3) for i in range(9)}
    assert {(r[0], r[1]) for r in spark.read.parquet(ledger).select("EnterpriseNumber", "filing_year").collect()} == pairs


def test_staging_layout_and_macro_csv(spark, sf_dir):
    from kredo.plans.catalog import Inputs
    from kredo.sources import sinks
    root = tempfile.mkdtemp(prefix="kredo-test-layout-")
    s = Inputs(spark, sf_dir).staging()
    sinks.write_staging(s, os.path.join(root, "staging"))
    years = sorted(x for x in os.listdir(os.path.join(root, "staging")) if x.startswith("accounting_year="))
    assert years == [f"accounting_year={y}" for y in range(2020, 2026)]
    back = spark.read.parquet(os.path.join(root, "staging"))
    assert back.count() == s.count()
    # Files inside a year are sorted by enterprise (clustering for min/max skipping).
    one = back.where("accounting_year = 2022").select("enterprise_number", F.input_file_name().alias("f"))
    for _, g in one.toPandas().groupby("f"):
        assert list(g["enterprise_number"]) == sorted(g["enterprise_number"])
    p = os.path.join(root, "macro.csv")
    with open(p, "w") as fh:
        fh.write("year,interest_rate,inflation\n2022,1.5,9.6\n2023,3.25,4.1\n")
    m = loaders.read_macro_csv(spark, p).orderBy("year").collect()
    assert [(r["year"], r["interest_rate"]) for r in m] == [(2022, 1.5), (2023, 3.25)]


def test_stored_filings_equal_derived(spark, sf_dir):
    from kredo.sources import fixtures
    a = fixtures.stored_filings(spark, sf_dir)
    b = fixtures.filings(spark, sf_dir)
    assert a.drop("_filing_id", "_n_rubrics").columns == b.columns
    key = ["ReferenceNumber", F.sort_array("Rubrics").alias("R")]
    assert a.select(*key).exceptAll(b.select(*key)).count() == 0
    assert a.count() == b.count()
    assert fixtures.stored_filings(spark, sf_dir).inputFiles() == a.inputFiles()      # written once, reused


def test_compact_stream_into_bucketed_table(spark):
    root = tempfile.mkdtemp(prefix="kredo-test-compact-")
    landing, sink, ledger, ckpt = (os.path.join(root, x) for x in ("landing", "sink", "ledger", "ckpt"))
    rows = [filing(f"R{i}", str(i % 4), f"{2020 + i % 3}-12-31", rubrics=healthy()) for i in range(12)]
    loaders.nest_filings(filings_df(spark, rows)).drop("filing_year").write.json(landing)
    ingest.run_ingest(spark, landing, sink, ledger, ckpt)
    t = ingest.compact(spark, sink, "kredo_test_compacted", os.path.join(root, "bucketed"), 4)
    assert t.count() == 12 and "clean_enterprise_number" in t.columns and "batch" not in t.columns


def test_read_filings_adds_a_unique_row_id(spark):
    root = tempfile.mkdtemp(prefix="kredo-test-readf-")
    rows = [filing(f"R{i}", str(i % 3), f"{2020 + i % 2}-12-31", rubrics=healthy()) for i in range(10)]
    filings_df(spark, rows).withColumn("batch", F.lit(1)).write.partitionBy("filing_year").parquet(root + "/f")
    f = loaders.read_filings(spark, root + "/f")
    assert "batch" not in f.columns and "_filing_id" in f.columns
    assert f.select("_filing_id").distinct().count() == 10
    again = loaders.read_filings(spark, root + "/f")
    key = lambda df: sorted((r[0], r[1]) for r in df.select("ReferenceNumber", "_filing_id").collect())
    assert key(f) == key(again)                  # the same id in every scan


def test_ledger_of_several_years_is_one_pass(spark):
    """The lines of all years are those of each year, without a branch of the plan a year."""
    ids = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "EnterpriseNumber string")
    committed = spark.createDataFrame([("a", 2021), ("a", 2021), (None, 2022), ("c", 2022), ("b", 2030), ("b", None)],
                                      "EnterpriseNumber string, filing_year bigint")
    got = loaders.ledger_rows(ids, committed, [2021, 2022])
    each = loaders.ledger_rows(ids, committed, 2021).unionByName(loaders.ledger_rows(ids, committed, 2022))
    want = {("a", 2021, True), ("b", 2021, False), ("a", 2022, False), ("b", 2022, False), (None, 2022, True), ("c", 2022, True)}
    assert set(map(tuple, got.collect())) == set(map(tuple, each.collect())) == want and got.count() == len(want)
    todo = loaders.pending(ids, committed, [2021, 2022])
    assert sorted(map(tuple, todo.collect())) == [("a", 2022), ("b", 2021), ("b", 2022)]
    for df in (got, todo):
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        assert plan.split("Initial Plan")[0].count("Scan ") <= 2


def test_landed_lines_take_a_fraction_of_their_text(spark, sf_dir):
    """The queries of the ingest land compressed files of bounded length; what they land is read whole."""
    from pathlib import Path
    from kredo.plans import catalog
    sink, ledger = catalog._ingested(spark, sf_dir)
    landing = sink.removesuffix("/sink") + "/landing"
    text = spark.read.text(landing).agg(F.sum(F.length("value"))).first()[0]
    files = [p for p in Path(landing).iterdir() if not p.name.startswith((".", "_"))]
    assert 4 * sum(p.stat().st_size for p in files) < text
    per_file = spark.read.text(landing).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert per_file <= catalog.LANDED_LINES
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert ingest.read_rejects(spark, sink).count() == orders.where("o_orderkey % 13 = 0").count()
    assert ingest.read_sink(spark, sink).count() == orders.count()


def test_filings_for_the_write_by_year_come_sorted_before_their_rubrics_are_built(spark, tmp_path):
    """Else the write sorts the rubric arrays themselves."""
    from kredo.sources import fixtures
    spark.range(60).selectExpr("id AS o_orderkey", "IF(id % 9 = 0, NULL, id % 4) AS o_custkey", "'O' AS o_orderstatus",
                               "CAST(1000 + id AS DOUBLE) AS o_totalprice", "make_date(1995 + id % 5, 1, 1) AS o_orderdate",
                               "'1-URGENT' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(3).selectExpr("id AS c_custkey", "concat('n', id) AS c_name").write.parquet(f"{tmp_path}/customer.parquet")
    plain, by_year = fixtures.filings(spark, str(tmp_path)), fixtures.filings(spark, str(tmp_path), by_year=True)
    assert "filing_year" in by_year._jdf.queryExecution().optimizedPlan().outputOrdering().toString()
    key = lambda df: sorted((r["ReferenceNumber"], str(r)) for r in df.collect())
    assert key(plain) == key(by_year) and len(key(plain)) == 60
    at = by_year.select(F.spark_partition_id().alias("p"), "filing_year").collect()
    for p in {r["p"] for r in at}:
        years = [r["filing_year"] for r in at if r["p"] == p]
        assert years == sorted(years)
