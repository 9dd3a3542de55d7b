"""Risk label, out-of-time split and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kredo.functions import codes

# Columns the reference removes before training (identifiers and year-3 targets).
DROPPED = ["target_year_y3", "enterprise_number", "target_roe_y3", "target_roa_y3",
           "target_solvency_y3", "target_liquidity_y3"]
# Kept by the reference although it is a year-3 outcome.
LEAKY = ["target_net_profit_y3"]


def risk_branch() -> Column:
    """Which rule fires first: negative equity, alarm, liquidity squeeze, or healthy.  Missing targets have defaults."""
    solvency = F.coalesce(F.col("target_solvency_y3"), F.lit(codes.RISK_DEFAULT_SOLVENCY))
    roa = F.coalesce(F.col("target_roa_y3"), F.lit(codes.RISK_DEFAULT_ROA))
    liquidity = F.coalesce(F.col("target_liquidity_y3"), F.lit(codes.RISK_DEFAULT_LIQUIDITY))
    loss = roa < codes.RISK_MIN_ROA
    return (F.when(solvency < codes.RISK_MIN_SOLVENCY, F.lit("negative_equity"))
             .when((solvency < codes.RISK_ALARM_SOLVENCY) & loss, F.lit("alarm"))
             .when((liquidity < codes.RISK_MIN_LIQUIDITY) & loss, F.lit("liquidity"))
             .otherwise(F.lit("healthy")))


def is_high_risk() -> Column:
    """1 if one of the three distress rules fires, else 0."""
    return (risk_branch() != "healthy").cast("bigint")


def any_target() -> Column:
    return (F.col("target_solvency_y3").isNotNull() | F.col("target_liquidity_y3").isNotNull()
            | F.col("target_roa_y3").isNotNull())


def labelled(training: DataFrame) -> DataFrame:
    """Training windows with a label and the split they fall in (only rows with a target)."""
    return (training.where(any_target())
            .withColumn("is_high_risk", is_high_risk())
            .withColumn("split", F.when(F.col("target_year_y3") <= codes.TRAIN_MAX_YEAR, F.lit("train"))
                        .otherwise(F.lit("eval"))))


def training_set(training: DataFrame, drop_leak: bool = True, split: str = "train") -> DataFrame:
    """The model input of one split: identifiers and year-3 targets dropped, label added."""
    drop = DROPPED + (LEAKY if drop_leak else [])
    return labelled(training).where(F.col("split") == split).drop(*drop, "split")


def class_weights(df: DataFrame, label: str = "is_high_risk") -> DataFrame:
    """Balanced class weights n / (k * n_c), computed by one aggregate."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    every = Window.partitionBy()       # over the per-class counts only: one row per class
    return counts.select(
        label, "n_class",
        (F.sum("n_class").over(every) / (F.count(F.lit(1)).over(every) * F.col("n_class"))).alias("class_weight"))


def with_weights(df: DataFrame, label: str = "is_high_risk") -> DataFrame:
    """Attach the class weight; the weight table has one row per class (bounded: broadcast)."""
    w = class_weights(df, label).select(label, "class_weight")
    return df.join(F.broadcast(w), label, "left")
