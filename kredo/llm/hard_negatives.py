"""Hard negatives by length buckets and coordinate ranges.

The rows are dealt in ranges of their length and packed into buckets of bounded size, each with the sorted
lists of its coordinates (``lemp``).  Anchors are packed into blocks of bounded size.  Every block meets
every part of the buckets once: blocks are copied to the parts and joined with them on the part's number,
and a task walks its buckets with the longest rows first, so that its bounds rise early.

1. Positives: the best rows of an anchor's label.  Its bound is the worst of the best so far.
2. Negatives: each positive gives a window of scores, shares of its own; the bound is the least score
   that still changes some window's best.

Both searches give each anchor's best of a part, and the best of those are taken by a window over the
anchor.  Neither vectors nor anchors pass through the driver.

Defined results: rows without an id, label or vector, or with a null or non-finite component, take no part;
of rows that share an id the one with the smallest label and vector does.  Vectors of different widths are
compared as if the shorter had zeros; an empty vector has only zeros.  Components whose 256-fold is beyond
a long, and scores that are, count as the nearest long.  Ties in score go by id.  An anchor without a
positive, or without a negative in any window, gives no row; an empty table gives no rows.  Columns other
than id, vector and label are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kredo.llm import lemp
from kredo.llm.common import arrow_rows, written

#: Rows of a bucket and anchors of a block at most.
BUCKET, BLOCK = 1024, 512
LONG = "<i8"

BUCKETS = "part int, n int, dim int, ids binary, labels binary, vectors binary, lists binary"
_BUCKETS = pa.schema([("part", pa.int32()), ("n", pa.int32()), ("dim", pa.int32()), ("ids", pa.binary()),
                      ("labels", pa.binary()), ("vectors", pa.binary()), ("lists", pa.binary())])
BLOCKS = "block long, b_dim int, b_ids binary, b_labels binary, b_vectors binary, windows binary"
_BLOCKS = pa.schema([("block", pa.int64()), ("b_dim", pa.int32()), ("b_ids", pa.binary()), ("b_labels", pa.binary()),
                     ("b_vectors", pa.binary()), ("windows", pa.binary())])


def scaled(vector: Column, scale: int = 256) -> Column:
    """Components as whole numbers."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           scale: int = 256) -> DataFrame:
    """vec_id, label, v (array of long) of the rows that take part, one an id."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (
        F.abs(x.cast("double")) < float("inf")))
    found = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
        scaled(F.col(vector_col), scale).alias("v"))
    return found.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("x")).select("vec_id", "x.label", "x.v")


def matrix(column: pa.Array) -> np.ndarray:
    """A list column as rows of longs, shorter ones filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    dim = int(sizes.max(initial=0)) or 1
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.arange(dim)[None, :] < sizes[:, None]] = flat
    return out


def chunks(batches, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task as batches of exactly ``size`` (the last one shorter)."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            take = min(size - n, batch.num_rows)
            held.append(batch.slice(0, take))
            n += take
            batch = batch.slice(take)
            if n == size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def buckets(rows: DataFrame, parts: int) -> DataFrame:
    """Rows packed into buckets by length, the longest first; part is the task that packed them."""
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))

    def run(batches):
        part = TaskContext.get().partitionId()

        def out():
            for b in chunks(batches, BUCKET):
                v = matrix(b.column("v"))
                ids = b.column("vec_id").to_numpy().astype(LONG)
                labels = b.column("label").to_numpy().astype(LONG)
                made = lemp.Bucket(v, ids, labels)
                yield (part, len(ids), v.shape[1], ids.tobytes(), labels.tobytes(), v.astype(LONG).tobytes(),
                       made.order.astype("<u2").tobytes())
        yield from arrow_rows(out(), _BUCKETS, weigh=lambda r: len(r[5]))

    dealt = rows.withColumn("size", length).repartitionByRange(parts, F.col("size").desc(), "vec_id")
    return dealt.sortWithinPartitions(F.col("size").desc(), "vec_id").select("vec_id", "label", "v").mapInArrow(run, BUCKETS)


def blocks(anchors: DataFrame, count: int, positives: int = 0) -> DataFrame:
    """Anchors (vec_id, label, v and, where ``positives``, windows: an array of least and most) packed into blocks."""
    columns = ["vec_id", "label", "v"] + (["windows"] if positives else [])

    def run(batches):
        at = TaskContext.get().partitionId() << 32

        def out():
            for n, b in enumerate(chunks(batches, BLOCK)):
                v = matrix(b.column("v"))
                w = b""
                if positives:
                    table = np.zeros((len(v), positives, 2), np.int64)
                    table[:, :, 0] = 1                              # least above most: no window
                    for k, each in enumerate(b.column("windows").to_pylist()):
                        for j, one in enumerate(each):
                            table[k, j] = one["least"], one["most"]
                    w = table.astype(LONG).tobytes()
                yield (at + n, v.shape[1], b.column("vec_id").to_numpy().astype(LONG).tobytes(),
                       b.column("label").to_numpy().astype(LONG).tobytes(), v.astype(LONG).tobytes(), w)
        yield from arrow_rows(out(), _BLOCKS, weigh=lambda r: len(r[4]))

    return anchors.select(*columns).repartition(max(1, -(-count // BLOCK)), "vec_id").sortWithinPartitions(
        "vec_id").mapInArrow(run, BLOCKS)


def met(some: DataFrame, packed: DataFrame, parts: int) -> DataFrame:
    """Every block beside every bucket, dealt by the part.

    Neither side may go through the driver: Spark sees the size of the narrow, compressed rows that blocks are packed
    from, not that of their copies for every part, and would broadcast them.
    """
    copied = some.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return copied.hint("merge").join(packed, "part").select(
        "block", "b_dim", "b_ids", "b_labels", "b_vectors", "windows", "n", "dim", "ids", "labels", "vectors", "lists")


def longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, LONG).astype(np.int64)


def bucket_of(row: dict) -> lemp.Bucket:
    v = longs(row["vectors"]).reshape(row["n"], row["dim"])
    lists = np.frombuffer(row["lists"], "<u2").reshape(row["dim"], row["n"])
    return lemp.Bucket(v, longs(row["ids"]), longs(row["labels"]), lists)


def queries_of(row: dict) -> lemp.Queries:
    ids = longs(row["b_ids"])
    return lemp.Queries(longs(row["b_vectors"]).reshape(len(ids), row["b_dim"]), ids, longs(row["b_labels"]))


def walked(batches, start) -> Iterator:
    """Searches (made by ``start`` from a block's row) that have visited all buckets that their block met in this task.
    Rows of a block may come in any order; a search that another block interrupts is handed on and begun again."""
    now, at = None, None
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: column[k].as_py() for name, column in zip(batch.schema.names, batch.columns)}
            if row["block"] != at:
                if now is not None:
                    yield now
                now, at = start(row), row["block"]
            now.visit(bucket_of(row))
    if now is not None:
        yield now


def nearest(pairs: DataFrame, positives: int) -> DataFrame:
    """anchor_id, id, score, rank of the best rows of the anchors' labels."""
    schema = pa.schema([("anchor_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        yield from arrow_rows((r for s in walked(batches, lambda row: lemp.TopSearch(queries_of(row), positives))
                               for r in s.rows()), schema)

    found = pairs.mapInArrow(run, "anchor_id long, id long, score long")
    w = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= positives)


def in_windows(pairs: DataFrame, positives: int, negatives: int) -> DataFrame:
    """anchor_id, window, id, score, rank of the best rows of other labels in each window."""
    schema = pa.schema([("anchor_id", pa.int64()), ("window", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def start(row):
        q = queries_of(row)
        return lemp.WindowSearch(q, longs(row["windows"]).reshape(len(q.ids), positives, 2), negatives)

    def run(batches):
        yield from arrow_rows((r for s in walked(batches, start) for r in s.rows()), schema)

    found = pairs.mapInArrow(run, "anchor_id long, window int, id long, score long")
    w = Window.partitionBy("anchor_id", "window").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= negatives)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50,
         most: int = 95) -> DataFrame:
    """Per anchor, positive and negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: vec_id, label, v, as ``usable`` gives them.  An anchor's positives are its ``positives`` best
    other rows of its label; a positive's negatives are its ``negatives`` best rows of other labels with
    least * positive_score <= 100 * negative_score <= most * positive_score.
    """
    spark = rows.sparkSession
    rows = written(rows, "vectors")
    anchors = rows.where(is_anchor)
    n, n_anchors = rows.count(), anchors.count()
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = written(buckets(rows, max(1, min(wanted, -(-n // (BUCKET // 4))))), "length-buckets")
    parts = 1 + (packed.agg(F.max("part")).first()[0] or 0)

    close = written(nearest(met(blocks(anchors, n_anchors), packed, parts), positives), "positives")
    # whole-number bounds of the window; a negative score has none, as least <= most would be false
    low = F.ceil(F.col("score").cast("decimal(20,0)") * least / 100).cast("long")
    high = F.floor(F.col("score").cast("decimal(20,0)") * most / 100).cast("long")
    windows = close.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct(
        "rank", low.alias("least"), high.alias("most")))).alias("windows"))          # at most ``positives``
    wide = anchors.join(windows, F.col("vec_id") == F.col("anchor_id"))
    hard = in_windows(met(blocks(wide, n_anchors, positives), packed, parts), positives, negatives)
    pos = close.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                       (F.col("rank") - 1).alias("window"))
    return hard.join(pos, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
