"""Batch jobs: staging table, training table, model comparison.

    python -m kredo.plans.pipeline fixtures --sf-dir /root/testdata/sf0.01 --out <shared>/tables
    python -m kredo.plans.pipeline dimensions --csv <shared>/registers --out <shared>/tables
    python -m kredo.plans.pipeline staging  --tables <shared>/tables --out <shared>/staging
    python -m kredo.plans.pipeline training --staging <shared>/staging --out <shared>/training
    python -m kredo.plans.pipeline models   --training <shared>/training --nace <shared>/tables/dim_nace_mapping --out <shared>/metrics
    python -m kredo.plans.pipeline ingest   --landing <shared>/landing --out <shared>/filings_stream
    python -m kredo.plans.pipeline refresh  --stream <shared>/filings_stream --tables <shared>/tables --out <shared>/current
    python -m kredo.plans.pipeline compact  --stream <shared>/filings_stream --out <shared>/filings_bucketed

Each job reads written tables and writes one table, so a lost executor costs
at most a stage retry and a failed job restarts from the last written table.
Tables are replaced whole (``sinks.replace_table``): read them with ``sinks.read_table``.  ``refresh`` merges
the batches that ``ingest`` has written since; read its tables with ``sinks.read_cells``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kredo.functions import codes
from kredo.operators import accounts, features, incremental, models, segments, staging
from kredo.session import ensure_checkpoint_dir
from kredo.sources import fixtures, loaders, sinks


def write_fixture_tables(spark: SparkSession, sf_dir: str, out: str) -> None:
    """Materialise the derived filings (partitioned by filing_year) and dimensions."""
    sinks.append_filings(fixtures.filings(spark, sf_dir), f"{out}/filings")
    sinks.replace_table(fixtures.dim_enterprise(spark, sf_dir), f"{out}/dim_enterprise")
    sinks.replace_table(fixtures.dim_address(spark, sf_dir), f"{out}/dim_address")
    sinks.replace_table(fixtures.dim_activity(spark, sf_dir), f"{out}/dim_activity")
    sinks.replace_table(fixtures.dim_nace_mapping(spark), f"{out}/dim_nace_mapping")
    sinks.replace_table(fixtures.macro(spark), f"{out}/macro")


def staging_job(spark: SparkSession, tables: str, out: str, lo: int = codes.SCAN_YEAR_MIN,
                hi: int = codes.SCAN_YEAR_MAX) -> None:
    """Filings (year-partitioned; only lo..hi folders are read) + dimensions -> staging table."""
    filings = accounts.scan_years(loaders.read_filings(spark, f"{tables}/filings"), lo, hi)
    s = staging.staging_master(filings, sinks.read_table(spark, f"{tables}/dim_enterprise"),
                               sinks.read_table(spark, f"{tables}/dim_address"),
                               sinks.read_table(spark, f"{tables}/dim_activity"))
    sinks.replace_staging(s, out)


def training_job(spark: SparkSession, staging_path: str, out: str) -> None:
    """The 62-column training table plus the lagged model type (an optional model input)."""
    sinks.replace_table(features.training_dataset(sinks.read_table(spark, staging_path), extra=models.EXTRA_LAGS), out)


def refresh_job(spark: SparkSession, sink: str, tables: str, out: str, buckets: int = 64) -> list[int]:
    """Ingested batches that the staging and training tables do not hold yet, oldest first; returns their numbers.

    Batch numbers are collected (one a micro-batch), not filings.  The last batch taken in is taken in again: a run
    that failed may have written its sums only.
    """
    landed = spark.read.parquet(sink)
    numbers = sorted(r[0] for r in landed.select("batch").distinct().collect())
    done = sorted(r[0] for r in spark.read.parquet(f"{out}/sums").select("batch").distinct().collect()) \
        if sinks.read_cells(spark, f"{out}/staging") is not None else []
    todo = [n for n in numbers if n not in done[:-1]]
    dims = [sinks.read_table(spark, f"{tables}/{t}") for t in ("dim_enterprise", "dim_address", "dim_activity")]
    for n in todo:
        filings = landed.where((F.col("kind") == "filing") & (F.col("batch") == n)).drop("batch", "kind", "line")
        incremental.refresh(spark, out, n, filings, *dims, buckets=buckets, extra=models.EXTRA_LAGS)
    return todo


def models_job(spark: SparkSession, training_path: str, nace_path: str, out: str,
               macro_path: str | None = None) -> DataFrame:
    """Unsegmented, per-segment and per-cluster boosted trees plus baselines; metrics table."""
    t = sinks.read_table(spark, training_path).withColumn(
        "nace_primary_division", F.substring(F.replace("nace_primary_code", F.lit("."), F.lit("")), 1, 2))
    t = segments.with_sector(t, sinks.read_table(spark, nace_path)).drop("nace_primary_division")
    train, test = models.splits(t, macro=sinks.read_table(spark, macro_path) if macro_path else None)
    number, trials = models.search_tpe(train, trials=10)
    found = trials.where(F.col("trial") == number).first()                  # one row
    best = models.GbtParams(found["max_depth"], found["step_size"], found["subsample"], found["colsample"])
    parts = [models.evaluate(models.fit(train, models.gbt(best)), test, "gbt_all")]
    keys = ["sector", "company_segment"]
    parts.append(models.per_group_metrics(train, test, keys, models.top_groups(train, keys), best, "gbt_segment_"))
    c = models.kmeans_clusters(train, test).checkpoint()
    ctr, cte = c.where(F.col("split") == "train"), c.where(F.col("split") == "eval")
    parts.append(models.per_group_metrics(ctr.drop(models.WEIGHT), cte, ["cluster"],
                                          models.top_groups(ctr, ["cluster"]), best, "gbt_cluster_"))
    parts.append(models.evaluate(models.fit(train, models.logreg()), test, "logreg"))
    parts.append(models.evaluate(models.fit(train, models.forest()), test, "random_forest"))
    out_df = parts[0]
    for p in parts[1:]:
        out_df = out_df.unionByName(p)
    sinks.replace_table(out_df, out)
    return sinks.read_table(spark, out)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="kredo")
    ap.add_argument("job", choices=["fixtures", "dimensions", "staging", "training", "models", "ingest", "compact", "refresh"])
    ap.add_argument("--landing")
    ap.add_argument("--csv")
    ap.add_argument("--stream")
    ap.add_argument("--buckets", type=int, default=1024)
    ap.add_argument("--sf-dir")
    ap.add_argument("--tables")
    ap.add_argument("--staging")
    ap.add_argument("--training")
    ap.add_argument("--nace")
    ap.add_argument("--macro")
    ap.add_argument("--out", required=True)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"kredo-{a.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if a.job == "fixtures":
        write_fixture_tables(spark, a.sf_dir, a.out)
    elif a.job == "dimensions":
        for table, n in loaders.load_dimensions(spark, a.csv, a.out).items():
            print(f"{table}: {n} rows")
    elif a.job == "staging":
        staging_job(spark, a.tables, a.out)
    elif a.job == "training":
        training_job(spark, a.staging, a.out)
    elif a.job == "refresh":
        print("batches:", *refresh_job(spark, f"{a.stream}/filings", a.tables, a.out, a.buckets))
    elif a.job == "compact":
        from kredo.streaming import ingest
        ingest.compact(spark, f"{a.stream}/filings", "filings", a.out, a.buckets)
    elif a.job == "ingest":
        # Landed filings -> year-partitioned filings + ledger; checkpoint next to the output.
        from kredo.streaming import ingest
        ingest.run_ingest(spark, a.landing, f"{a.out}/filings", f"{a.out}/ledger", f"{a.out}/_checkpoint")
    else:
        models_job(spark, a.training, a.nace, a.out, a.macro)


if __name__ == "__main__":
    main()
