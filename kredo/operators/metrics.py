"""Classification metrics as distributed aggregates (M7).

Confusion counts, precision, recall, accuracy, F1 and log loss are one
grouped aggregate.  ROC AUC is exact (ties count one half) and distributed:
scores are first reduced to distinct values with their positive/negative
counts, and "negatives below" is a running total through a range exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kredo.operators import ranges
from kredo.session import ensure_checkpoint_dir

EPS = 1e-15
COUNTS = ("n", "tp", "fp", "tn", "fn")


def score_counts(df: DataFrame, group: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """Positives and negatives per (group, distinct score): every metric below needs only this."""
    return df.groupBy(*group, score).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label)).cast("long")).alias("neg"))


def confusion_from_counts(s: DataFrame, group: list[str], score: str = "score", threshold: float = 0.5,
                          digits: int = 10) -> DataFrame:
    """Confusion counts, precision, recall, accuracy, F1 and log loss from per-score counts."""
    hit = F.col(score) >= threshold
    p = F.least(F.greatest(F.col(score), F.lit(EPS)), F.lit(1 - EPS))
    g = s.groupBy(*group).agg(
        (F.sum("pos") + F.sum("neg")).alias("n"),
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~hit, F.col("neg")).otherwise(0)).alias("tn"),
        F.sum(F.when(~hit, F.col("pos")).otherwise(0)).alias("fn"),
        F.sum(F.col("pos") * F.log(p) + F.col("neg") * F.log(1 - p)).alias("_ll"))
    prec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    return g.select(
        *group, "n", "tp", "fp", "tn", "fn",
        prec.alias("precision"), rec.alias("recall"),
        ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy"),
        F.try_divide(2 * prec * rec, prec + rec).alias("f1"),
        F.round(-F.col("_ll") / F.col("n"), digits).alias("log_loss"))


def auc_from_counts(s: DataFrame, group: list[str], score: str = "score") -> DataFrame:
    """Exact ROC AUC per group from per-score counts (Mann-Whitney, ties count one half).

    "Negatives below" is a running total through a range exchange, so neither a large group nor a
    narrow band of scores falls to one task.
    """
    below = ranges.running_total(s, group, score, "neg", "_upto").withColumn("_below", F.col("_upto") - F.col("neg"))
    g = below.groupBy(*group).agg(
        F.sum(F.col("pos") * (F.col("_below") + F.col("neg") * 0.5)).alias("_num"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return g.select(*group, F.try_divide(F.col("_num"), F.col("_p") * F.col("_n")).alias("roc_auc"))


def roc_auc(df: DataFrame, group: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC AUC per group (Mann-Whitney with half credit for ties)."""
    return auc_from_counts(score_counts(df, group, label, score), group, score)


def classification_report(df: DataFrame, group: list[str], label: str = "label", score: str = "score",
                          threshold: float = 0.5) -> DataFrame:
    """Six metrics per group: precision, recall, accuracy, F1, log loss, ROC AUC (+ counts).

    The scored rows are reduced once to per-score counts, which are written
    to the shared checkpoint folder; every metric then reads that small table
    instead of re-running the upstream plan.  A NULL group is a group.  Without
    grouping columns there is always one row: n = 0 and NULL metrics if no row was scored.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = group or ["_all"]
    if not group:
        df = df.withColumn("_all", F.lit(1))
    s = score_counts(df, keys, label, score).checkpoint()
    out = ranges.join_null_safe(confusion_from_counts(s, keys, score, threshold), auc_from_counts(s, keys, score), keys)
    if group:
        return out
    out = out.drop("_all")
    if not s.isEmpty():
        return out
    zero = [F.lit(0).cast(out.schema[c].dataType).alias(c) if c in COUNTS else F.lit(None).cast(
        out.schema[c].dataType).alias(c) for c in out.columns]
    return df.sparkSession.range(1).select(*zero)
