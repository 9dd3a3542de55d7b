"""Sector benchmarks: a sector x region mean against the sector mean, and sector trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sector_benchmark(df: DataFrame, ratio: str = "solvency_pct_n", sector: str = "sector",
                     region: str = "MunicipalityNL", digits: int = 9) -> DataFrame:
    """Mean ratio per (sector, region) next to the sector's national mean.

    One pass over the rows: the national mean is rebuilt from the regional
    sums and counts (sectors x regions rows), so the upstream plan is not run
    a second time; the national side has one row per sector and is broadcast.
    """
    local = df.groupBy(sector, region).agg(
        F.count(F.lit(1)).alias("n"), F.sum(ratio).alias("_s"), F.count(ratio).alias("_c"))
    national = local.groupBy(sector).agg(
        F.round(F.try_divide(F.sum("_s"), F.sum("_c")), digits).alias("national_mean"))
    local = local.withColumn("region_mean", F.round(F.try_divide(F.col("_s"), F.col("_c")), digits))
    out = local.join(F.broadcast(national), local[sector].eqNullSafe(national[sector]), "left").drop(national[sector])
    return out.select(sector, region, "n", "region_mean", "national_mean",
                      (F.col("region_mean") - F.col("national_mean")).alias("gap"))


def sector_trend(df: DataFrame, sector: str = "sector", year: str = "accounting_year",
                 ratios: tuple[str, ...] = ("roa_n", "solvency_pct_n"), digits: int = 9) -> DataFrame:
    """Per sector and year: rows, mean ratios and the change against the sector's previous year.

    The lag runs over the aggregated (sector, year) rows only.
    """
    g = df.groupBy(sector, year).agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.avg(r), digits).alias(f"avg_{r}") for r in ratios])
    w = Window.partitionBy(sector).orderBy(F.col(year).asc_nulls_first())
    return g.select("*", *[(F.col(f"avg_{r}") - F.lag(f"avg_{r}", 1).over(w)).alias(f"change_{r}") for r in ratios])
