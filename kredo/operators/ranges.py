"""Running totals over any number of rows per group, without one task per group.

The rows are dealt in ranges of (group, order) and written, so that a range is a task's worth of rows
whatever the size of a group.  A running total is the total of the group's earlier ranges plus the
running total inside the range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kredo.session import ensure_checkpoint_dir


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be NULL; the right keys are dropped."""
    renamed = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda x, y: x & y, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    return left.join(renamed, on, "left").drop(*[f"_right_{k}" for k in keys])


def running_total(df: DataFrame, group: list[str], order: str, value: str, out: str, pieces: int | None = None) -> DataFrame:
    """``df`` plus ``out``: the sum of ``value`` over the group's rows up to and including this one.

    ``order`` should be distinct within a group (aggregate first): equal values are one row's worth of
    work, and ranges never split them.  ``pieces``: how many ranges there are, for wide rows whose sort should
    not grow with the table (else as many as Spark shuffles to).
    """
    ensure_checkpoint_dir(df.sparkSession)
    dealt = df.repartitionByRange(pieces, *group, order) if pieces else df.repartitionByRange(*group, order)
    ranged = dealt.withColumn("_range", F.spark_partition_id()).checkpoint()
    totals = ranged.groupBy(*group, "_range").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*group, "_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    if pieces:
        ranged = ranged.repartition(pieces, *group, "_range")
    with_inside = ranged.withColumn("_inside", F.sum(value).over(inside))
    joined = join_null_safe(with_inside, before, [*group, "_range"])
    return joined.withColumn(out, F.col("_before") + F.col("_inside")).drop("_range", "_before", "_inside")
