"""Merkle manifest of a dataset, with proofs of all leaves by pointer jumping.

Every row is a leaf: the sha256 of its fields.  The leaves of a source ascend by id; each run of up to
16 consecutive nodes becomes their hash until one is left, the subroot.  Subroots in the order of
their sources become the root in the same way.  Digests are lowercase hex text.

Siblings are stored once, with their run: a run is a row with the digests of its nodes, and points to
the run that holds its own hash and to the place there.  A run's path is the list of runs above it with
the places that lead to it.  In each round every run that has not reached the root joins the run that it
points to, appends that run and its path to its own, and takes over its pointer, so the distance to
the ancestor doubles: log2(depth) self-joins give all paths.  The leaves of a run then read their
siblings off the run and its path.

Positions come from a range exchange, so a source that holds most rows is dealt over many tasks, and
equal rows are dealt apart by a row number.  All steps are DataFrame operations; what is used again
is written to the shared folder.

Defined results: a null field counts as ``-``, so a null text and an empty one differ; a null source
is a source of its own and comes first, null ids come first within their source; rows with one id are
ordered by their digest, and repeated rows are leaves of their own; a lone leaf is its subroot, and a
lone subroot is the root (no siblings: the proof is the hash of nothing); an empty table gives no
rows; columns other than the five fields are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kredo.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 16
#: Characters of a digest.
WIDE = 64
#: The number of the tree over the subroots, in the place of a source's number.
TOP = -1


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(values: list[Column]) -> Column:
    """Hash of the fields: ``-`` for null, else byte count, colon and value."""
    def one(c):
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return digest(F.concat(*[one(c) for c in values]))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def tampered(doc_id: Column) -> Column:
    """Whether a row is among those whose text is tampered with."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def placed(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` (written) plus ``place``: the number of the row within its group by the order, from 0.

    Rows are dealt in ranges of (group, order).  A row's place is its place in its range plus the
    group's rows in earlier ranges; the latter are one row a (group, range).  Groups may be null.
    """
    ranged = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    rows = written(ranged.withColumn("at", F.monotonically_increasing_id())
                   .withColumn("range", F.shiftright("at", 33)), name)
    runs = rows.groupBy(*group, "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    # one row a (group, range): ranges that hold only this group are as many as there are tasks, no more
    earlier = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"))
    right = starts.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("range").alias("_range"), "before")
    on = rows["range"] == right["_range"]
    for g in group:
        on = on & rows[g].eqNullSafe(right[f"_{g}"])
    found = rows.join(right, on).withColumn("place", F.col("at") + F.col("before"))
    return found.drop("at", "range", "before", "_range", *[f"_{g}" for g in group])


def runs_of(nodes: DataFrame) -> DataFrame:
    """tree, level, n, run, all (the digests of the run's nodes, joined) of nodes (tree, level, n, place, node)."""
    some = nodes.groupBy("tree", "level", "n", F.shiftright("place", 4).alias("run")).agg(
        F.array_sort(F.collect_list(F.struct("place", "node"))).alias("held"))      # at most ARITY
    return some.select("tree", "level", "n", "run", F.array_join(F.transform("held", lambda x: x["node"]), "").alias("all"))


def grown(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The runs of all levels (written), and each tree's last node: tree, node.

    nodes: tree, level, n (nodes of that tree and level), place, node.  Trees of one node have no run.
    """
    levels, ends = [], []
    while True:
        ends.append(nodes.where("n = 1").select("tree", "node"))
        runs = written(runs_of(nodes.where("n > 1")), f"{name}-{len(levels)}")
        if runs.isEmpty():
            return levels, united(ends)
        levels.append(runs)
        nodes = runs.select("tree", (F.col("level") + 1).alias("level"), F.shiftright(F.col("n") + (ARITY - 1), 4).alias("n"),
                            F.col("run").alias("place"), digest(F.col("all")).alias("node"))


def united(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def pointer(tree: Column, level: Column, place: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), place.cast("long").alias("place"))


def entry(place: Column, all_digests: Column) -> Column:
    return F.struct(place.cast("int").alias("place"), all_digests.alias("all"))


def paths(runs: DataFrame, topped: bool) -> DataFrame:
    """tree, level, run, all and ``path`` (the runs above, with the places that lead there) of every run.

    ``topped``: whether there is more than one subroot.  Each round is a self-join of the runs on the way
    with all runs; those that have reached the root are set aside.
    """
    # the hash of a run is a node one level up, or a subroot, which is a leaf of the top tree
    up = F.when(F.col("n") > ARITY, pointer(F.col("tree"), F.col("level") + 1, F.col("run")))
    if topped:
        up = up.when(F.col("tree") != TOP, pointer(F.lit(TOP), F.lit(0), F.col("tree")))
    none = F.array().cast("array<struct<place:int,all:string>>")
    state = written(runs.select("tree", "level", "run", "all", none.alias("path"), up.alias("up")), "merkle-path")
    there = []
    while True:
        there.append(state.where("up IS NULL").drop("up"))
        live = state.where("up IS NOT NULL")
        if live.isEmpty():
            return united(there)
        known = united([s.withColumn("up", F.lit(None).cast(state.schema["up"].dataType)) for s in there] + [live])
        far = known.select(F.col("tree").alias("_tree"), F.col("level").alias("_level"), F.col("run").alias("_run"),
                           F.col("all").alias("_all"), F.col("path").alias("_path"), F.col("up").alias("_up"))
        on = ((F.col("up.tree") == F.col("_tree")) & (F.col("up.level") == F.col("_level"))
              & (F.shiftright("up.place", 4) == F.col("_run")))
        step = entry(F.col("up.place") % ARITY, F.col("_all"))
        state = written(live.join(far, on).select("tree", "level", "run", "all", F.concat(
            "path", F.array(step), "_path").alias("path"), F.col("_up").alias("up")), "merkle-path")


def siblings(place: Column, all_digests: Column) -> Column:
    """A run's digests without the one at the place."""
    return F.concat(F.substr(all_digests, F.lit(1), place * WIDE), F.substr(all_digests, place * WIDE + WIDE + 1))


def refolded(node: Column, place: Column, all_digests: Column) -> Column:
    """The hash of a run with another node at the place."""
    return digest(F.concat(F.substr(all_digests, F.lit(1), place * WIDE), node,
                           F.substr(all_digests, place * WIDE + WIDE + 1)))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` is folded from the leaf of the row as ``tampered`` leaves it, and the siblings of the
    manifest; ``verified`` says whether it is the root.  ``fields`` names the columns for id, source,
    language, length and text.
    """
    of = {want: docs[have] for want, have in zip(FIELDS, fields)}
    changed = {**of, "text": F.when(tampered(of["doc_id"]), lower_ascii(of["text"])).otherwise(of["text"])}
    # equal rows share all else, so a row number deals them over tasks; its value changes no digest
    leaves = written(docs.select(
        of["doc_id"].alias("doc_id"), of["source"].cast("string").alias("source"),
        leaf_digest([of[c] for c in FIELDS]).alias("leaf"), leaf_digest([changed[c] for c in FIELDS]).alias("given"),
        F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    sources = placed(leaves.groupBy("source").agg(F.count(F.lit(1)).alias("n")), [], ["source"], "merkle-sources")
    numbered = written(sources.select(F.col("source").alias("_source"), "n", F.col("place").alias("tree")), "merkle-trees")
    ranked = placed(leaves, ["source"], ["doc_id", "leaf", "row"], "merkle-ranked")
    base = written(ranked.join(numbered, F.col("source").eqNullSafe(F.col("_source"))).select(
        "tree", "n", "place", "doc_id", "leaf", "given"), "merkle-placed")

    levels, subroots = grown(base.select("tree", F.lit(0).alias("level"), "n", "place", F.col("leaf").alias("node")), "merkle")
    subroots = written(subroots, "merkle-subroots")
    n_trees = subroots.count()
    tops, last = grown(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.lit(n_trees).cast(
        "long").alias("n"), F.col("tree").alias("place"), "node"), "merkle-top")
    root = last.first()
    if root is None:
        return base.select("doc_id", "leaf", *[F.lit("").alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")],
                           F.lit(True).alias("verified"))
    runs = levels + tops
    if runs:
        known = paths(united(runs), n_trees > 1).where("level = 0").select("tree", "run", "all", "path")
    else:                                                     # a single leaf
        known = base.select("tree", F.lit(0).cast("long").alias("run"), F.lit("").alias("all"),
                            F.array().cast("array<struct<place:int,all:string>>").alias("path"))
    return proofs(base, known, subroots.withColumnRenamed("node", "subroot"), root["node"])


def proofs(base: DataFrame, known: DataFrame, subroots: DataFrame, root: str) -> DataFrame:
    """The result rows: the leaves of a run are gathered (at most 16) and meet their run's path once."""
    held = base.groupBy("tree", F.shiftright("place", 4).alias("run")).agg(
        F.collect_list(F.struct("place", "doc_id", "leaf", "given")).alias("held"))
    own = known.where(F.col("tree") != TOP)
    # a source of one leaf has no run of its own: its path starts at its place in the top tree
    above = known.where(F.col("tree") == TOP).select(
        F.col("run").alias("_run"), F.col("all").alias("_all"), F.col("path").alias("_path"))
    found = held.join(own, ["tree", "run"], "left").join(subroots, "tree")
    lone = F.when(F.col("all").isNull(), F.shiftright("tree", 4))
    found = found.join(above, lone == F.col("_run"), "left").withColumn(
        "path", F.when(F.col("all").isNotNull(), F.col("path")).when(F.col("_all").isNull(), F.array().cast(
            "array<struct<place:int,all:string>>")).otherwise(
                F.concat(F.array(entry(F.col("tree") % ARITY, F.col("_all"))), "_path")))
    found = found.withColumn("above", F.array_join(F.transform("path", lambda e: siblings(e["place"], e["all"])), ""))
    each = found.select(F.explode("held").alias("x"), F.coalesce("all", F.lit("")).alias("all"), "path", "above", "subroot")
    each = each.select("x.doc_id", "x.leaf", "x.given", (F.col("x.place") % ARITY).cast("int").alias("place"), "all",
                       "path", "above", "subroot")
    first = F.when(F.col("all") == "", F.col("given")).otherwise(refolded(F.col("given"), F.col("place"), F.col("all")))
    beside = F.when(F.col("all") == "", F.lit("")).otherwise(siblings(F.col("place"), F.col("all")))
    folded = F.aggregate("path", first, lambda now, e: refolded(now, e["place"], e["all"]))
    return each.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"),
                       digest(F.concat(beside, "above")).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
                           "verified", F.col("folded_root") == F.col("root"))
