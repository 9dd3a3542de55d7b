"""Register dimensions: preferred address (E2), ranked and pivoted activities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kredo.functions import codes
from kredo.functions.scalars import clean_number, lookup


def clean_enterprise(dim_enterprise: DataFrame) -> DataFrame:
    """Enterprise dimension plus the join key (not deduplicated, as in the reference)."""
    return dim_enterprise.withColumn("clean_enterprise_number", clean_number("EnterpriseNumber"))


def preferred_address(dim_address: DataFrame) -> DataFrame:
    """One address per entity: not struck off first, then address type.

    The remaining columns are appended as final sort keys so that the pick is
    deterministic; the reference leaves such ties open.
    """
    rest = [c for c in dim_address.columns if c not in ("EntityNumber", "TypeOfAddress", "DateStrikingOff")]
    w = Window.partitionBy("EntityNumber").orderBy(
        F.when(F.col("DateStrikingOff").isNull(), F.lit(1)).otherwise(F.lit(2)).asc(),
        F.col("TypeOfAddress").asc_nulls_first(),
        F.col("DateStrikingOff").asc_nulls_first(),
        *[F.col(c).asc_nulls_first() for c in rest])
    return (dim_address
            .withColumn("clean_enterprise_number", clean_number("EntityNumber"))
            .withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def ranked_activities(dim_activity: DataFrame, keep: int | None = None) -> DataFrame:
    """Main NACE-2025 activities ranked per enterprise: group 001, 003, 006, then code.

    With ``keep`` the ranking is cut at that rank (planned as a WindowGroupLimit).
    """
    a = dim_activity.where(
        (F.col("NaceVersion") == codes.ACTIVITY_NACE_VERSION)
        & (F.col("Classification") == codes.ACTIVITY_CLASSIFICATION)
        & F.col("ActivityGroup").isin(*codes.ACTIVITY_GROUP_RANK))
    w = Window.partitionBy("EnterpriseNumber").orderBy(
        lookup(F.col("ActivityGroup"), codes.ACTIVITY_GROUP_RANK, codes.ACTIVITY_GROUP_RANK_DEFAULT).asc(),
        F.col("NaceCode").asc_nulls_first())
    r = a.select("EnterpriseNumber", "NaceCode", "ActivityGroup", F.row_number().over(w).cast("bigint").alias("rn"))
    return r if keep is None else r.where(F.col("rn") <= keep)


def _division(code: F.Column) -> F.Column:
    return F.substring(clean_number(code), 1, 2)


def pivoted_activities(dim_activity: DataFrame) -> DataFrame:
    """Top-3 activities as columns, one row per enterprise.

    The window and the group-by share the key, so the pivot adds no shuffle.
    """
    r = ranked_activities(dim_activity, keep=3)
    g = r.groupBy("EnterpriseNumber").agg(
        *[F.max(F.when(F.col("rn") == k, F.col("NaceCode"))).alias(name)
          for k, name in ((1, "nace_primary_code"), (2, "nace_secondary_code"), (3, "nace_tertiary_code"))])
    return g.select(
        "EnterpriseNumber",
        clean_number("EnterpriseNumber").alias("clean_enterprise_number"),
        "nace_primary_code", _division(F.col("nace_primary_code")).alias("nace_primary_division"),
        "nace_secondary_code", _division(F.col("nace_secondary_code")).alias("nace_secondary_division"),
        "nace_tertiary_code", _division(F.col("nace_tertiary_code")).alias("nace_tertiary_division"))
