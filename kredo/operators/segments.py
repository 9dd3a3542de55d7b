"""Segments, lookups and distribution statistics."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kredo.operators import ranges
from kredo.session import ensure_checkpoint_dir


def with_sector(df: DataFrame, nace_map: DataFrame, division: str = "nace_primary_division",
                out: str = "sector") -> DataFrame:
    """Sector of the 2-digit NACE division (left lookup).

    The mapping has one row per NACE code of a level (at most a few thousand
    codes exist at any level), a proven bound, so it is broadcast.
    """
    m = nace_map.where(F.col("Level") == "2").select(F.col("Code").alias("_code"), F.col("Sector").alias(out))
    return df.join(F.broadcast(m), df[division] == F.col("_code"), "left").drop("_code")


def with_macro(df: DataFrame, macro: DataFrame, year: str = "accounting_year") -> DataFrame:
    """Yearly macro indicators (one row per year: bounded, broadcast)."""
    m = macro.withColumnRenamed("year", "_year")
    return df.join(F.broadcast(m), df[year] == F.col("_year"), "left").drop("_year")


def segment_census(staging: DataFrame) -> DataFrame:
    """Rows per (activity division, size segment, model category)."""
    return staging.groupBy("nace_primary_division", "company_segment", "model_category").agg(
        F.count(F.lit(1)).alias("n"))


def merge_segments(counts: DataFrame, path: list[str], k: int = 32, n: str = "n") -> DataFrame:
    """The segments of a census merged to at most ``k`` groups along their path (coarsest column first).

    The prefixes of the paths are a tree.  Merging always takes the smallest node that has no other
    nodes under it and gives its rows to its parent (ties: the deeper one, then the last in order of the path),
    until ``k`` groups are left; a group is a node that holds rows.  What a node holds when its turn comes is
    all that lies under it, so nodes fall in the order of their subtree totals, and no step by step loop is
    needed: counted from the largest node on, each node adds one group, but for the last child of its parent,
    which leaves the parent without rows.  The nodes before the count passes ``k`` stay.

    Returns ``counts`` with ``group_level`` (columns of the path that the group has in common; 0: the rest),
    ``group_key`` (their values; a NULL is empty, a value begins with ``=``) and ``group_n`` (its rows).
    Every row belongs to one group; the segments with the same path should be one row.  An empty census gives none.
    The census is written once: the nodes and their members both come from that copy.
    """
    ensure_checkpoint_dir(counts.sparkSession)
    counts = counts.checkpoint()
    parts = F.array(*[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in path])
    levels = F.explode(F.sequence(F.lit(0), F.lit(len(path))))
    prefixes = counts.select(*path, n, parts.alias("_parts")).withColumn("_level", levels).withColumn(
        "_prefix", F.slice("_parts", 1, F.col("_level")))
    nodes = prefixes.groupBy("_level", "_prefix").agg(F.sum(n).alias("_total"))
    place = F.struct((-F.col("_total")).alias("a"), F.col("_level").alias("b"), F.col("_prefix").alias("c"))
    parent = F.when(F.col("_level") > 0, F.slice("_prefix", 1, F.col("_level") - 1))
    nodes = nodes.select("_level", "_prefix", place.alias("_place"), parent.alias("_parent"))
    last = (nodes.groupBy("_level", "_parent").agg(F.max("_place").alias("_place"))
            .select("_place", F.when(F.col("_level") > 0, 0).otherwise(1).alias("_gain")))
    gains = nodes.join(last, "_place", "left").fillna(1, ["_gain"])
    counted = ranges.running_total(gains.select("_place", "_gain"), [], "_place", "_gain", "_groups")
    # At most k groups and the nodes above them: k times the path's length, whatever the size of the census.
    kept = counted.where(F.col("_groups") <= k).select(F.col("_place.b").alias("_level"), F.col("_place.c").alias("_prefix"))
    member = (prefixes.join(F.broadcast(kept), ["_level", "_prefix"]).groupBy("_parts", *path, n)
              .agg(F.max("_level").alias("group_level")))
    member = member.withColumn("_key", F.slice("_parts", 1, F.col("group_level")))
    totals = member.groupBy("_key").agg(F.sum(n).alias("group_n"))
    return member.join(totals, "_key").select(*path, n, F.col("group_level").cast("bigint").alias("group_level"),
                                              F.array_join("_key", "/").alias("group_key"), "group_n")


def top_k(counts: DataFrame, keys: list[str], k: int = 3, n: str = "n") -> DataFrame:
    """The k largest groups; ties broken by the keys ascending (a top-k report)."""
    return counts.orderBy(F.col(n).desc(), *[F.col(c).asc_nulls_first() for c in keys]).limit(k)


# ---------------------------------------------------------------- exact quantiles

def _finite(c: str):
    """The column as a double; NaN counts as missing."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _between(lo: float, hi: float, share: float) -> float:
    """lo + (hi - lo) * share, also where the difference overflows."""
    step = hi - lo
    return lo + step * share if math.isfinite(step) else lo * (1 - share) + hi * share


def exact_percentiles(df: DataFrame, cols: list[str], q: float, accuracy: int = 10_000) -> dict[str, tuple[int, float | None]]:
    """(n, value) of each column's q-quantile, interpolated between order statistics.

    value = lo + (hi - lo) * (pos - floor(pos)), pos = q * (n - 1).  All columns together:

    1. one aggregate counts values and brackets the quantile by two sketched quantiles;
    2. one aggregate counts the values under and inside each bracket (a bracket that misses the rank
       is opened to the whole range);
    3. the distinct values inside the brackets get running counts through a range exchange, and
       only the two order statistics of each column come back.
    """
    ensure_checkpoint_dir(df.sparkSession)
    base = df.select(*[_finite(c).alias(c) for c in cols]).checkpoint()   # the passes re-read a written copy
    # sketched ranks are off by at most n / accuracy
    sides = F.array(F.lit(max(0.0, q - 2 / accuracy)), F.lit(min(1.0, q + 2 / accuracy)))
    row = base.agg(*[F.count(c).alias(f"n{k}") for k, c in enumerate(cols)],
                   *[F.percentile_approx(c, sides, accuracy).alias(f"b{k}") for k, c in enumerate(cols)]).first()
    n = {c: row[f"n{k}"] for k, c in enumerate(cols)}
    bracket = {c: tuple(row[f"b{k}"]) for k, c in enumerate(cols) if n[c]}
    ranks = {c: (math.floor(q * (n[c] - 1)), math.ceil(q * (n[c] - 1))) for c in bracket}
    if not bracket:
        return {c: (0, None) for c in cols}
    held = base.agg(*[F.sum((F.col(c) < lo).cast("long")).alias(f"u_{c}") for c, (lo, _) in bracket.items()],
                    *[F.sum(F.col(c).between(lo, hi).cast("long")).alias(f"i_{c}") for c, (lo, hi) in bracket.items()]).first()
    under = {}
    for c in bracket:
        under[c] = held[f"u_{c}"]
        if not (under[c] <= ranks[c][0] and ranks[c][1] < under[c] + held[f"i_{c}"]):
            bracket[c], under[c] = (-math.inf, math.inf), 0
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.when(F.col(c).between(*bracket[c]), F.col(c)).alias("x"))
                      for c in bracket])
    counts = (base.select(F.explode(pairs).alias("p")).select("p.feature", "p.x").where("x IS NOT NULL")
                  .groupBy("feature", "x").agg(F.count(F.lit(1)).alias("c")))
    upto = ranges.running_total(counts, ["feature"], "x", "c", "upto")
    wanted = None
    for c, (lo, hi) in ranks.items():
        hit = F.lit(False)
        for r in {lo - under[c], hi - under[c]}:
            hit = hit | ((F.col("upto") > r) & (F.col("upto") - F.col("c") <= r))
        mine = (F.col("feature") == c) & hit
        wanted = mine if wanted is None else wanted | mine
    found: dict[str, list] = {c: [] for c in bracket}
    for r in upto.where(wanted).collect():
        found[r["feature"]].append(r["x"])
    out: dict[str, tuple[int, float | None]] = {}
    for c in cols:
        if c not in bracket:
            out[c] = (0, None)
            continue
        pos = q * (n[c] - 1)
        out[c] = (n[c], _between(min(found[c]), max(found[c]), pos - math.floor(pos)))
    return out


def exact_percentile(df: DataFrame, col: str, q: float) -> tuple[int, float | None]:
    return exact_percentiles(df, [col], q)[col]


def percentile_table(df: DataFrame, cols: list[str], q: float = 0.99) -> DataFrame:
    """One row per column: n non-null values and the exact q-quantile."""
    found = exact_percentiles(df, cols, q)
    return df.sparkSession.createDataFrame([(c, *found[c]) for c in cols], "feature string, n bigint, p99 double")


def capped(df: DataFrame, caps: dict[str, float | None]) -> DataFrame:
    """Values above their cap become the cap; NULL and NaN stay as they are."""
    def one(c: str):
        if caps.get(c) is None:
            return F.col(c)
        return F.when((F.col(c) > caps[c]) & ~F.isnan(F.col(c).cast("double")), F.lit(caps[c])).otherwise(F.col(c)).alias(c)
    return df.select(*[one(c) for c in df.columns])


def winsorize(df: DataFrame, cols: list[str], q: float = 0.99) -> DataFrame:
    """Cap each column at its exact upper q-quantile (the reference caps at p99).

    The rows are written once: the quantiles and the capped rows both come from that copy, so select the columns first.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint()
    return capped(df, {c: v for c, (_, v) in exact_percentiles(df, cols, q).items()})


# ---------------------------------------------------------------- clusters

def cluster_profile(df: DataFrame, cluster: str, features: list[str], min_members: int | None = None,
                    min_share: float = 0.0, digits: int = 9) -> DataFrame:
    """Mean of each feature and member count per cluster, large clusters only.

    Large: more than ``min_members`` rows (the reference's bound is 5000) and at least ``min_share`` of
    all rows, counted over the per-cluster rows.
    """
    aggs = [F.count(F.lit(1)).alias("n")] + [F.round(F.avg(c), digits).alias(f"avg_{c}") for c in features]
    out = df.groupBy(cluster).agg(*aggs)
    if min_members is not None:
        out = out.where(F.col("n") > min_members)
    if min_share:
        total = F.sum("n").over(Window.partitionBy(F.lit(0)))
        out = out.withColumn("_total", total).where(F.col("n") >= F.col("_total") * min_share).drop("_total")
    return out


def category_mix(df: DataFrame, cluster: str, category: str) -> DataFrame:
    """Members per (cluster, category) and their share of the cluster.

    The share window runs over the aggregated table (clusters x categories rows).
    """
    g = df.groupBy(cluster, category).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(cluster)))


# ---------------------------------------------------------------- one step of Lloyd's iteration

def standardised(rows: DataFrame, features: list[str]) -> DataFrame:
    """Features less their mean, by their deviation; 0 where that is 0 or the value is missing (one aggregate, one row)."""
    row = rows.agg(*[F.avg(c).alias(f"m_{c}") for c in features], *[F.stddev_pop(c).alias(f"s_{c}") for c in features]).first()
    one = lambda c: F.coalesce((F.col(c) - row[f"m_{c}"]) / row[f"s_{c}"], F.lit(0.0)) if row[f"s_{c}"] else F.lit(0.0)
    return rows.withColumns({c: one(c) for c in features})


def lloyd_step(rows: DataFrame, cluster: str, features: list[str]) -> DataFrame:
    """Rows with ``nearest``, the cluster whose mean is nearest (the smaller of equals), and its squared ``distance``.

    The means of the given clusters are the centres: one aggregate, one row a cluster.  An assignment that the step
    leaves as it is is a fixed point of k-means; rows without a cluster move no centre but get a nearest one.
    Features must not be NULL.
    """
    means = rows.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(*[F.avg(c).alias(c) for c in features]).collect()
    means = sorted(means, key=lambda r: r[cluster])
    if not means:
        return rows.withColumns({"nearest": F.col(cluster), "distance": F.lit(None).cast("double")})
    x = F.array(*features)
    apart = F.transform(F.lit([[float(r[c]) for c in features] for r in means]), lambda m: F.aggregate(
        F.zip_with(x, m, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, d: total + d))
    least = F.array_min("_apart")
    names = F.lit([r[cluster] for r in means])
    kind = rows.schema[cluster].dataType
    return (rows.withColumn("_apart", apart)
                .withColumns({"nearest": F.element_at(names, F.array_position("_apart", least).cast("int")).cast(kind), "distance": least})
                .drop("_apart"))


def step_facts(assigned: DataFrame, cluster: str) -> DataFrame:
    """A row a nearest cluster: members, their share of all rows, how many came from another one, and the logarithm of
    1 and their squared distances.  Raw ratios show the collapse: one cluster holds nearly all rows."""
    per = assigned.groupBy(F.col("nearest").alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((~F.col("nearest").eqNullSafe(F.col(cluster))).cast("bigint")).alias("moved"),
        F.round(F.log1p(F.sum("distance")), 6).alias("log_inertia"))
    return per.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
