"""Second-order boosted trees over histograms, as DataFrame operations.

Features become bins once: numbers by sketched quantiles, categories by the order of their weighted target
mean in the training rows, so a category of any cardinality stays a feature.  Bin 0 is the missing value.

A level of a tree is one aggregate: sums of gradients and hessians by (group, node, feature, bin).  Windows over
those sums try every threshold with the missing bin on either side; the best split of each node is

    gain = (GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)) / 2,    weight of a leaf = -G / (H + l2).

Rows then join the splits on (group, node) and go down.  Columns are drawn per tree, rows by a hash of
their key.  All groups grow in the passes of one: a group is one more key of the sums, so separate models
for many segments cost no more passes than a single one.  Sums by (feature, bin) combine before the
exchange; neither rows nor sums come to the driver.

The bins of the categories and the splits of a level are written before rows meet them: Spark then knows their size
and broadcasts them where they are small.  A join that exchanged the rows by category or by node would leave them in
as many tasks as there are categories or nodes, however many rows there are.
"""

from __future__ import annotations

import random
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kredo.session import ensure_checkpoint_dir, shared_path

ROLES = ("train", "valid", "eval")


@dataclass(frozen=True)
class Params:
    """The reference's parameters: L2 = 1, column sample per tree, early stop on the validation rows."""
    trees: int = 100
    depth: int = 5
    rate: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    l2: float = 1.0
    min_hessian: float = 1.0
    bins: int = 32
    tolerance: float = 0.01
    patience: int = 3
    seed: int = 7


def cut_points(train: DataFrame, numeric: list[str], bins: int) -> dict[str, list[float]]:
    """At most ``bins`` - 1 distinct sketched quantiles of each feature (one aggregate, one row)."""
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    row = train.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(f"q{k}") for k, c in enumerate(numeric)]).first()
    return {c: sorted(set(row[f"q{k}"] or [])) for k, c in enumerate(numeric)}


def number_bin(c: str, cuts: list[float]) -> Column:
    """0 for missing, else 1 and one more for every cut below the value."""
    x = F.col(c).cast("double")
    # one array a feature: hundreds of comparisons spelled out would be beyond what Spark compiles
    above = F.size(F.filter(F.lit(cuts), lambda cut: cut < x)) if cuts else F.lit(0)
    return F.when(x.isNull() | F.isnan(x), F.lit(0)).otherwise(1 + above)


def category_bins(train: DataFrame, c: str, label: str, weight: str, bins: int) -> DataFrame:
    """value, bin: values by rising weighted target mean (ties by value), dealt to ``bins`` bins of like weight.

    The window runs over one row a value.
    """
    per = train.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("_value")).agg(
        F.sum(weight).alias("w"), F.sum(F.col(weight) * F.col(label)).alias("t"))
    order = Window.orderBy(F.round(F.col("t") / F.col("w"), 12), "_value")
    before = F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("w")
    nth, n = F.row_number().over(order), F.count(F.lit(1)).over(Window.partitionBy())
    share = before / F.sum("w").over(Window.partitionBy())
    return per.select("_value", F.when(n <= bins, nth).otherwise(1 + F.least(F.floor(share * bins), F.lit(bins - 1))).cast(
        "int").alias("_bin"))


def written(df: DataFrame, path: str) -> DataFrame:
    """The rows as a stored table, whose size Spark knows."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def binned(rows: DataFrame, numeric: list[str], categorical: list[str], label: str, weight: str, role: str, key: list[str],
           group: str | None = None, p: Params = Params()) -> tuple[DataFrame, list[str]]:
    """grp, rid, role, y, w, bins (array, in the order of the returned feature names) of all rows.

    Cuts and orders come from the rows with role ``train``.  A category not seen there is missing.
    """
    train = rows.where(F.col(role) == "train")
    cuts = cut_points(train, numeric, p.bins) if numeric else {}
    ensure_checkpoint_dir(rows.sparkSession)
    path = shared_path(rows.sparkSession, "kredo-bins", uuid.uuid4().hex)
    out = rows
    for k, c in enumerate(categorical):
        table = written(category_bins(train, c, label, weight, p.bins).select(
            F.col("_value").alias(f"_v_{c}"), F.col("_bin").alias(f"_b_{c}")), f"{path}/{k}")
        out = out.join(table, out[c] == table[f"_v_{c}"], "left").drop(f"_v_{c}")
    bins = [number_bin(c, cuts[c]) for c in numeric] + [F.coalesce(F.col(f"_b_{c}"), F.lit(0)) for c in categorical]
    return out.select((F.col(group) if group else F.lit("all")).alias("grp"), F.xxhash64(*key).alias("rid"), F.col(role).alias("role"),
                      F.col(label).cast("int").alias("y"), F.col(weight).cast("double").alias("w"),
                      F.array(*[b.cast("int") for b in bins]).alias("bins")), [*numeric, *categorical]


def drawn(rid: Column, seed: int, tree: int, share: float) -> Column:
    """Whether a row is in a tree's sample; the same on every retry."""
    return F.pmod(F.xxhash64(rid, F.lit(seed), F.lit(tree)), F.lit(1 << 20)) < int(share * (1 << 20))


def histogram(rows: DataFrame, features: list[int]) -> DataFrame:
    """grp, node, feature, bin, g, h of rows (grp, node, y, w, margin, bins)."""
    p = 1 / (1 + F.exp(-F.col("margin")))
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col("bins")[f].alias("bin")) for f in features])
    each = rows.select("grp", "node", (F.col("w") * (p - F.col("y"))).alias("g"), (F.col("w") * p * (1 - p)).alias("h"),
                       F.explode(pairs).alias("at"))
    return each.groupBy("grp", "node", F.col("at.feature").alias("feature"), F.col("at.bin").alias("bin")).agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_splits(hist: DataFrame, l2: float, min_hessian: float) -> DataFrame:
    """One row a (grp, node): feature, threshold (bins up to it go left), missing_left, gain (NULL: no split), and the
    weights of the node and its children."""
    whole = Window.partitionBy("grp", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    seen = lambda c: F.when(F.col("bin") > 0, F.col(c)).otherwise(0.0)                # noqa: E731
    gone = lambda c: F.sum(F.when(F.col("bin") == 0, F.col(c)).otherwise(0.0)).over(whole)
    s = hist.select("grp", "node", "feature", "bin", F.sum("g").over(whole).alias("G"), F.sum("h").over(whole).alias("H"),
                    F.sum(seen("g")).over(upto).alias("gl"), F.sum(seen("h")).over(upto).alias("hl"), gone("g").alias("gm"), gone("h").alias("hm"))
    sides = F.array(F.struct(F.lit(False).alias("missing_left"), F.col("gl").alias("GL"), F.col("hl").alias("HL")),
                    F.struct(F.lit(True).alias("missing_left"), (F.col("gl") + F.col("gm")).alias("GL"), (F.col("hl") + F.col("hm")).alias("HL")))
    t = s.select("grp", "node", "feature", "bin", "G", "H", F.explode(sides).alias("x")).select(
        "grp", "node", "feature", F.col("bin").alias("threshold"), "x.missing_left", "G", "H", "x.GL", "x.HL")
    score = lambda g, h: g * g / (h + l2)                                             # noqa: E731
    GR, HR = F.col("G") - F.col("GL"), F.col("H") - F.col("HL")
    gain = F.round((score(F.col("GL"), F.col("HL")) + score(GR, HR) - score(F.col("G"), F.col("H"))) / 2, 10)
    ok = (F.col("HL") >= min_hessian) & (HR >= min_hessian) & (gain > 0)
    t = t.withColumn("gain", F.when(ok, gain))
    weight = lambda g, h: -g / (h + l2)                                               # noqa: E731
    t = t.withColumns({"value": weight(F.col("G"), F.col("H")), "left_value": weight(F.col("GL"), F.col("HL")),
                       "right_value": weight(GR, HR)})
    # highest gain, then the first feature, threshold and side
    rank = F.struct(F.coalesce("gain", F.lit(-1.0)), -F.col("feature"), -F.col("threshold"), ~F.col("missing_left"))
    kept = F.struct("feature", "threshold", "missing_left", "gain", "G", "H", "GL", "HL", "value", "left_value", "right_value")
    return t.groupBy("grp", "node").agg(F.max_by(kept, rank).alias("x")).select("grp", "node", "x.*")


def descended(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows one level down: node, value (the weight of that node) and open (whether it may be split again)."""
    at = splits.select(F.col("grp").alias("_grp"), F.col("node").alias("_node"), "feature", "threshold", "missing_left",
                       "gain", F.col("value").alias("own"), "left_value", "right_value")
    bin_ = F.element_at("bins", F.col("feature") + 1)
    left = F.when(bin_ == 0, F.col("missing_left")).otherwise(bin_ <= F.col("threshold"))
    moves = F.col("open") & F.col("gain").isNotNull()
    node = F.when(moves, F.col("node") * 2 + F.when(left, 1).otherwise(2)).otherwise(F.col("node"))
    value = F.when(moves, F.when(left, F.col("left_value")).otherwise(F.col("right_value"))).otherwise(F.coalesce("own", "value"))
    return rows.join(at, (rows["grp"] == at["_grp"]) & (rows["node"] == at["_node"]) & rows["open"], "left").select(
        "grp", "rid", "role", "y", "w", "bins", "margin", node.cast("long").alias("node"), value.alias("value"),
        moves.alias("open"))


def fit(rows: DataFrame, n_features: int, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """Trees of all groups, and all rows with their margin: (trees, rows).

    rows: as ``binned`` gives them.  Gradients come from rows with role ``train``; the others only go down
    the trees.  Growth ends when the loss of the ``valid`` rows has not fallen by ``tolerance`` of itself in
    ``patience`` trees (never, without such rows).  The rows are written once a tree, dealt by their key at first: each
    pass has all tasks, wherever the rows lay before.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    path = shared_path(spark, "kredo-trees", uuid.uuid4().hex)
    state = rows.repartition(F.col("rid")).withColumn("margin", F.lit(0.0)).checkpoint()
    rng, best, since, levels = random.Random(p.seed), None, 0, []
    for tree in range(p.trees):
        features = sorted(rng.sample(range(n_features), max(1, round(p.colsample * n_features))))
        now = state.withColumns({"node": F.lit(0).cast("long"), "value": F.lit(0.0), "open": F.lit(True)})
        for level in range(p.depth):
            used = now.where((F.col("role") == "train") & F.col("open") & drawn(F.col("rid"), p.seed, tree, p.subsample))
            found = best_splits(histogram(used, features), p.l2, p.min_hessian).withColumn("tree", F.lit(tree))
            levels.append(f"{path}/{tree}_{level}")
            now = descended(now, written(found, levels[-1]))
        state = now.select("grp", "rid", "role", "y", "w", "bins", (F.col("margin") + p.rate * F.col("value")).alias("margin")).checkpoint()
        loss = state.where("role = 'valid'").agg(F.sum(F.col("w") * log_loss())).first()[0]
        if loss is not None:
            better = best is None or loss < best * (1 - p.tolerance)
            best, since = (loss, 0) if better else (best, since + 1)
            if since >= p.patience:
                break
    return spark.read.parquet(*levels), state


def log_loss() -> Column:
    """Of a row's label under its margin, without overflow."""
    m = F.when(F.col("y") == 1, -F.col("margin")).otherwise(F.col("margin"))
    return F.greatest(m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m)))


def scored(state: DataFrame) -> DataFrame:
    """Rows with ``score``, the probability of label 1."""
    return state.withColumn("score", 1 / (1 + F.exp(-F.col("margin"))))


def importance(trees: DataFrame, names: list[str]) -> DataFrame:
    """grp, feature, weight (number of splits) and mean gain."""
    label = F.element_at(F.lit(names), F.col("feature") + 1)
    return trees.where("gain IS NOT NULL").groupBy("grp", label.alias("feature")).agg(
        F.count(F.lit(1)).alias("weight"), F.avg("gain").alias("gain"))
