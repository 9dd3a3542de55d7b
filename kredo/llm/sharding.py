"""K-d tree sharding: documents are split at weighted medians along their widest metadata dimension.

One narrow table (id, size, checksum, dimensions) is written once; the texts are read once, for it.
A node that must become k shards is cut where its left part holds ceil(k / 2) / k of its bytes, until
every leaf is one shard, that is, holds about the target bytes.  All nodes of a level are cut
together.  A cut is found exactly by narrowing: each pass sums bytes per (node, bucket) of the
bracket that holds the median and keeps the bucket that crosses it.  Only one row a node ever comes
to the driver.  Rows whose value ties with the cut are cut by id in the same way.

DataFrame operations only.  Defined results: a null or empty text weighs ``overhead`` bytes and has
checksum 0; a null dimension counts as 0 (numbers) or as the empty text; rows with equal id and
equal dimensions stay together; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kredo.llm.common import written

#: Buckets that one narrowing pass sums, for each node.
BUCKETS = 1 << 14
#: Rows that one task numbers when slots are dealt.
SLOT_ROWS = 20_000


def coordinate(docs: DataFrame, name: str) -> Column:
    """A metadata column as a long of the same order: numbers as they are, texts by their first seven bytes."""
    if isinstance(docs.schema[name].dataType, T.NumericType):
        return F.coalesce(F.col(name).cast("double").cast("long") if isinstance(
            docs.schema[name].dataType, T.FractionalType) else F.col(name).cast("long"), F.lit(0))
    head = F.hex(F.substring(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"), 1, 7))
    return F.conv(F.rpad(head, 14, "0"), 16, 10).cast("long")


def values(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small literal table (one row a node)."""
    text = ", ".join("(" + ", ".join(f"{v}L" if isinstance(v, int) else repr(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {text} AS t({', '.join(names)})")


def pick(columns: list[str], which: Column) -> Column:
    """The column whose number ``which`` gives."""
    out = F.col(columns[-1])
    for k in reversed(range(len(columns) - 1)):
        out = F.when(which == k, F.col(columns[k])).otherwise(out)
    return out


def crossing(rows: DataFrame, brackets: dict[int, dict]) -> None:
    """Narrow every bracket to the one value at which the bytes up to it reach ``target``.

    rows: node, v, size.  A bracket has ``lo``, ``hi`` (values), ``target`` and ``below`` (the bytes
    of its node's rows under ``lo``); ``at`` (bytes of the rows at the last value) is added.
    """
    spark = rows.sparkSession
    todo = dict(brackets)
    while todo:
        step = {n: max(1, -(-(b["hi"] - b["lo"] + 1) // BUCKETS)) for n, b in todo.items()}
        small = values(spark, [(n, b["lo"], b["hi"], step[n], b["target"] - b["below"]) for n, b in todo.items()],
                       ["node", "lo", "hi", "step", "goal"])
        held = rows.join(F.broadcast(small), "node").where(F.col("v").between(F.col("lo"), F.col("hi")))
        sums = (held.groupBy("node", "goal", F.expr("(v - lo) div step").alias("bucket"))
                    .agg(F.sum("size").alias("bytes")))
        w = Window.partitionBy("node").orderBy("bucket")
        reached = sums.withColumn("upto", F.sum("bytes").over(w))
        found = reached.where((F.col("upto") >= F.col("goal")) & (F.col("upto") - F.col("bytes") < F.col("goal")))
        for r in found.select("node", "bucket", "bytes", (F.col("upto") - F.col("bytes")).alias("under")).collect():
            n, b = r["node"], todo[r["node"]]
            b["below"] += r["under"]
            b["lo"] += r["bucket"] * step[n]
            b["hi"] = min(b["hi"], b["lo"] + step[n] - 1)
            b["at"] = r["bytes"]
        todo = {n: b for n, b in todo.items() if step[n] > 1}


def split_level(rows: DataFrame, parts: dict[int, int], extents: list[int], keys: tuple[int, int]) -> DataFrame:
    """Cut every node with more than one shard; a node is named by its first shard."""
    spark = rows.sparkSession
    dims = [c for c in rows.columns if c.startswith("dim_")]
    active = {n: k for n, k in parts.items() if k > 1}
    stats = (rows.groupBy("node")
                 .agg(F.sum("size").alias("bytes"),
                      *[f(c).alias(f"{f.__name__}_{c}") for c in dims for f in (F.min, F.max)]).collect())
    brackets, chosen = {}, {}
    for r in stats:
        if r["node"] not in active or not r["bytes"]:
            continue
        n, k = r["node"], active[r["node"]]
        width = [(r[f"max_{c}"] - r[f"min_{c}"]) / (e or 1) for c, e in zip(dims, extents)]
        d = max(range(len(dims)), key=lambda i: (width[i], -i))
        chosen[n] = d
        brackets[n] = {"lo": r[f"min_{dims[d]}"], "hi": r[f"max_{dims[d]}"], "below": 0,
                       "target": max(1, round(r["bytes"] * ((k + 1) // 2) / k))}
    for n, k in active.items():
        parts[n] = (k + 1) // 2
        parts[n + (k + 1) // 2] = k // 2
    if not brackets:
        return rows
    by_dim = values(spark, [(n, d) for n, d in chosen.items()], ["node", "axis"])
    onto = rows.join(F.broadcast(by_dim), "node").withColumn("v", pick(dims, F.col("axis")))
    crossing(onto.select("node", "v", "size"), brackets)

    cuts = values(spark, [(n, b["lo"]) for n, b in brackets.items()], ["node", "cut"])
    tied = onto.join(F.broadcast(cuts), "node").where(F.col("v") == F.col("cut"))
    ties = {n: {"lo": keys[0], "hi": keys[1], "below": b["below"], "target": b["target"]} for n, b in brackets.items()}
    crossing(tied.select("node", F.col("key").alias("v"), "size"), ties)

    # the rows at the cut itself go to the side that leaves the left part nearer to its target
    table = [(n, chosen[n], brackets[n]["lo"], t["lo"],
              int(t["below"] + t["at"] - t["target"] < t["target"] - t["below"]), (active[n] + 1) // 2)
             for n, t in ties.items()]
    small = values(spark, table, ["node", "axis", "cut", "key_cut", "with_cut", "jump"])
    v, key = pick(dims, F.col("axis")), F.col("key")
    left = ((v < F.col("cut")) | ((v == F.col("cut")) & (
        (key < F.col("key_cut")) | ((key == F.col("key_cut")) & (F.col("with_cut") == 1)))))
    moved = rows.join(F.broadcast(small), "node", "left")
    node = F.when(F.col("jump").isNull() | left, F.col("node")).otherwise(F.col("node") + F.col("jump"))
    return moved.withColumn("node", node).select(*rows.columns)


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
              dimensions: tuple[str, ...] = ("n_chars", "doc_id", "source", "lang"), overhead: int = 16,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard (0 up) and slot (0 up without gaps in each shard).

    Give the number of shards or the bytes a shard should hold.  Dimensions that the table lacks
    are left out; the widest is the one whose extent in the node is largest against its extent in
    the whole table.  The tree has one row per node on the driver, so at most ``shards`` of them.
    """
    spark = docs.sparkSession
    dims = [d for d in dimensions if d in docs.columns] or [id_col]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("key"),
        *[coordinate(docs, d).alias(f"dim_{k}") for k, d in enumerate(dims)])
    base = written(base, "kd-base")
    names = [f"dim_{k}" for k in range(len(dims))]
    whole = base.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"),
                     *[f(c).alias(f"{f.__name__}_{c}") for c in (*names, "key") for f in (F.min, F.max)]).first()
    if not whole["n"]:
        return base.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    wide = any(whole[f"max_{c}"] - whole[f"min_{c}"] >= 1 << 62 for c in (*names, "key"))
    if wide:                                            # differences must fit a long
        base = base.select(*[F.shiftright(c, 2).alias(c) if c in (*names, "key") else F.col(c) for c in base.columns])
    extents = [whole[f"max_{c}"] - whole[f"min_{c}"] for c in names]
    keys = tuple(whole[f"{f}_key"] >> (2 * wide) for f in ("min", "max"))
    count = shards or max(1, math.ceil(whole["bytes"] / target_bytes))
    parts, rows = {0: count}, base.withColumn("node", F.lit(0).cast("long"))
    while any(k > 1 for k in parts.values()):
        rows = written(split_level(rows, parts, extents, keys), "kd-level")
    placed = rows.select("doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard"))
    return with_slots(placed, whole["n"], count)


def with_slots(placed: DataFrame, n: int, shards: int) -> DataFrame:
    """Number the rows of each shard: chunks of about SLOT_ROWS rows are numbered apart and moved up by those before."""
    chunks = max(1, math.ceil(n / shards / SLOT_ROWS))
    rows = placed.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)))
    counts = rows.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "chunk", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("chunk")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32", "size")) - 1
    return (rows.withColumn("own", own).join(before, ["shard", "chunk"])
                .select("doc_id", "size", "text_crc32", "shard", (F.col("own") + F.col("before")).alias("slot")))
