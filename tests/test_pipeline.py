"""The batch jobs through written tables: fixtures -> staging -> training."""

import os
import tempfile

import pytest

from kredo.plans import pipeline
from kredo.plans.catalog import Inputs
from kredo.sources import sinks


def test_jobs_through_written_tables(spark, sf_dir):
    root = tempfile.mkdtemp(prefix="kredo-test-jobs-")
    pipeline.write_fixture_tables(spark, sf_dir, f"{root}/tables")
    pipeline.staging_job(spark, f"{root}/tables", f"{root}/staging")
    pipeline.training_job(spark, f"{root}/staging", f"{root}/training")
    staged = sinks.read_table(spark, f"{root}/staging")
    version, = {f.split("/accounting_year=")[0] for f in staged.inputFiles()}
    years = sorted(x for x in os.listdir(version.removeprefix("file:").replace("///", "/")) if x.startswith("accounting_year="))
    assert years == [f"accounting_year={y}" for y in range(2020, 2026)]
    assert staged.count() == Inputs(spark, sf_dir).staging().count()
    training = sinks.read_table(spark, f"{root}/training")
    assert len(training.columns) == 63                 # 62 columns + the lagged model type
    want = Inputs(spark, sf_dir).training()
    assert training.drop("raw_model_type_y2").exceptAll(want).count() == 0
    assert training.count() == want.count()


def test_dimension_ingest_and_compact_jobs(spark, capsys):
    from helpers import filing, filings_df, healthy
    from kredo.sources import loaders
    root = tempfile.mkdtemp(prefix="kredo-test-cli-")
    os.makedirs(f"{root}/csv")
    for t, schema in loaders.schemas.DIMENSIONS.items():
        names = [c for c in schema.fieldNames() if not (t == "dim_address" and c == "DateStrikingOff")]
        with open(f"{root}/csv/{t}.csv", "wb") as fh:
            line = ",".join('"a ""b"", c\\"' for _ in names)
            fh.write((",".join(names) + "\n" + line + "\n" + line + "\n").encode("iso-8859-1"))
    with pytest.warns(UserWarning, match="dim_address: date columns not in the header: DateStrikingOff"):
        pipeline.main(["dimensions", "--csv", f"{root}/csv", "--out", f"{root}/tables"])
    assert "dim_enterprise: 2 rows" in capsys.readouterr().out
    row = sinks.read_table(spark, f"{root}/tables/dim_code").first()
    assert row["Code"] == 'a "b", c\\' and sinks.read_table(spark, f"{root}/tables/dim_code").count() == 2
    assert sinks.read_table(spark, f"{root}/tables/dim_address").first()["DateStrikingOff"] is None

    rows = [filing(f"R{k}", str(k), "2021-12-31", rubrics=healthy()) for k in range(4)]
    rows[0]["EndDate"] = ""
    nested = loaders.nest_filings(filings_df(spark, rows)).drop("filing_year")
    lines = [r[0] for r in nested.selectExpr("to_json(struct(EnterpriseNumber, 2021L AS FilingYear, data, reference))").collect()]
    os.makedirs(f"{root}/landing")
    with open(f"{root}/landing/a.json", "w") as fh:
        fh.write("\n".join([*lines, '{"EnterpriseNumber": "9", "FilingYear": 2021}', '{"EnterpriseNumber": "bro', "not json"]) + "\n")
    pipeline.main(["ingest", "--landing", f"{root}/landing", "--out", f"{root}/stream"])
    stored = loaders.read_filings(spark, f"{root}/stream/filings")
    assert stored.count() == 4 and {r[0] for r in stored.select("filing_year").collect()} == {2021}
    ledger = {(r["EnterpriseNumber"], r["filing_year"], r["has_filings"])
              for r in spark.read.parquet(f"{root}/stream/ledger").collect()}
    assert ledger == {(str(k), 2021, True) for k in range(4)} | {("9", 2021, False)}
    from kredo.streaming import ingest
    assert ingest.read_rejects(spark, f"{root}/stream/filings").count() == 2
    pipeline.main(["compact", "--stream", f"{root}/stream", "--out", f"{root}/bucketed", "--buckets", "2"])
    assert spark.table("filings").count() == 4


def test_models_job(spark, sf_dir, monkeypatch):
    from kredo.operators import models
    from kredo.sources import fixtures
    root = tempfile.mkdtemp(prefix="kredo-test-models-")
    Inputs(spark, sf_dir).training().write.parquet(f"{root}/training")
    fixtures.dim_nace_mapping(spark).write.parquet(f"{root}/nace")
    small = models.GbtParams(2, 0.1, 0.8, 0.8, 2)
    monkeypatch.setattr(models, "draw_params", lambda n, seed=42: [small])
    monkeypatch.setattr(models, "forest", lambda: models.gbt(small))
    largest = models.top_groups
    monkeypatch.setattr(models, "top_groups", lambda df, keys: largest(df, keys, 1))
    pipeline.main(["models", "--training", f"{root}/training", "--nace", f"{root}/nace", "--out", f"{root}/metrics"])
    names = {r["model"].split("_")[0] for r in sinks.read_table(spark, f"{root}/metrics").collect()}
    assert names == {"gbt", "logreg", "random"}
