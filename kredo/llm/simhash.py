"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most r bits apart meet in a variant that is about half-way.  With s = r // 2
every distinct fingerprint emits all its variants within s flips, and rows are shuffled on the variant.

Odd radii need one more flip.  Fingerprints of odd weight also emit variants with s + 1 flips, and
only those whose flips all lie in one half of the word, because of 2 s + 1 differing bits some half
holds s + 1.  (An odd distance means one weight is even and one odd, so one side does it.)  These
variants are many, so fingerprints without a neighbour are set aside first, also by meeting in the
middle: of three blocks of bits, leaving out the one that differs most leaves at most 2 s differing
bits, so neighbours meet in a variant within s flips of one of three projections.

Fingerprints within s flips of one variant are within 2 s of each other and within r of those that
reached it with s + 1 flips, so all of them link to the smallest of the first kind: as many links as
emitted rows, never all pairs of a group.  Links are made distinct and their bit distance is verified.
Exact copies are one fingerprint from the start, and at most a ball's volume of fingerprints can meet
in a whole variant.

Components come from repeated contraction: every node moves to its smallest neighbour, chains of moves
are followed to their ends, edges are renamed and made distinct; at least half of the linked nodes
vanish each round.  Rounds are cut by reliable checkpoints.

Defined results: a null or empty text has fingerprint 0 and links like any other; repeated rows share
their component; the component of rows with null ids only is null; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kredo.llm.common import arrow_rows, checkpointed, id_and_text, written

BITS = 64
SEED = 42
#: Shingle hashes whose bits are counted together.
COUNTED = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority bits of the XXH64 hashes (seed 42) of all word shingles, A-Z lower-cased; no words: 0."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    digest, join = xxhash.xxh64_digest, b" ".join
    for at in range(0, n, COUNTED):
        raw = b"".join([digest(join(words[i:i + shingle]), SEED) for i in range(at, min(n, at + COUNTED))])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    fp = fingerprint(text.as_py(), shingle)
                    yield doc_id, signed(fp)
        yield from arrow_rows(rows(), schema)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def flips(k: int, places) -> list[int]:
    """All masks of k bits among the places."""
    return [sum(1 << b for b in c) for c in combinations(places, k)]


def spread(fps: DataFrame) -> DataFrame:
    """The same rows over all shuffle partitions: each row becomes hundreds, so few rows are work enough."""
    return fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")


def neighboured(fps: DataFrame, radius: int) -> DataFrame:
    """The fingerprints that meet another one in a variant of one of three projections.

    All that have a neighbour within the radius are among them.  The left-out block holds the
    projection's number.
    """
    edges = [BITS * k // 3 for k in range(4)]
    pairs = []
    for k in range(3):
        block = range(edges[k], edges[k + 1])
        keep = signed((1 << BITS) - 1 - sum(1 << b for b in block))
        places = [b for b in range(BITS) if b not in block]
        pairs += [(keep, signed(m | (k + 1) << block[0])) for n in range(radius // 2 + 1) for m in flips(n, places)]
    masks = F.array(*[F.struct(F.lit(keep).alias("keep"), F.lit(flip).alias("flip")) for keep, flip in pairs])
    met = spread(fps).select("fp", F.explode(masks).alias("m")).select(
        F.col("fp").bitwiseAND(F.col("m.keep")).bitwiseXOR(F.col("m.flip")).alias("variant"), "fp")
    w = Window.partitionBy("variant")
    apart = met.select("fp", F.min("fp").over(w).alias("lo"), F.max("fp").over(w).alias("hi")).where("lo <> hi")
    return apart.select("fp").distinct()


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Distinct links (a, b) that join all fingerprints at most ``radius`` bits apart.

    fps: distinct ``fp``.  Two fingerprints within the radius are linked directly or through the
    smallest fingerprint of a variant that both reach.
    """
    near = [signed(m) for k in range(radius // 2 + 1) for m in flips(k, range(BITS))]
    far = [signed(m) for half in (range(BITS // 2), range(BITS // 2, BITS))
           for m in flips(radius // 2 + 1, half)] if radius % 2 else []
    odd = F.bit_count("fp") % 2 == 1
    masks = F.when(odd, F.lit(near + far)).otherwise(F.lit(near)) if far else F.lit(near)
    live = checkpointed(neighboured(fps, radius))
    emitted = spread(live).select("fp", F.posexplode(masks).alias("k", "mask")).select(
        F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), "fp", (F.col("k") >= len(near)).alias("far"))
    hub = F.min(F.when(~F.col("far"), F.col("fp"))).over(Window.partitionBy("variant"))
    met = emitted.withColumn("hub", hub).where(F.col("hub").isNotNull() & (F.col("hub") != F.col("fp")))
    return (met.select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()
               .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))


def ends(up: DataFrame) -> DataFrame:
    """node, up with every chain of moves followed to its end; the ways double each time."""
    while True:
        above = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
        step = checkpointed(up.join(above, "up").select("node", "up", "top"))
        if step.where("up <> top").isEmpty():
            return step.select("node", "up")
        up = step.select("node", F.col("top").alias("up"))


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges (a, b); equal roots mean one component."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    live = checkpointed(both.where("a <> b").distinct())
    labels = None
    while not live.isEmpty():
        up = live.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
            "node", F.least("node", "b").alias("up"))
        step = ends(checkpointed(up))
        if labels is None:
            labels = step.select("node", F.col("up").alias("root"))
        else:
            rename = step.select(F.col("node").alias("root"), "up")
            labels = checkpointed(labels.join(rename, "root", "left").select(
                "node", F.coalesce("up", "root").alias("root")))
        left = step.select(F.col("node").alias("a"), F.col("up").alias("na"))
        right = step.select(F.col("node").alias("b"), F.col("up").alias("nb"))
        live = checkpointed(live.join(left, "a").join(right, "b").where("na <> nb").select(
            F.col("na").alias("a"), F.col("nb").alias("b")).distinct())
    return labels if labels is not None else both.select(F.col("a").alias("node"), F.col("b").alias("root"))


def components_of(rows: DataFrame, radius: int) -> DataFrame:
    """fp, root, component_id (the smallest doc_id that links lead to, its own included) of the fingerprints in
    ``rows`` (doc_id, fp; written).  Equal roots mean one component."""
    fps = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(written(links(fps.select("fp"), radius), "simhash-links"))
    linked = fps.join(roots.withColumnRenamed("node", "fp"), "fp")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    named = linked.join(least, "root").select("fp", "root", "least")
    return fps.join(named, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"),
                                                F.coalesce("least", "first").alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id that links lead to, its own included) of every row."""
    rows = written(fingerprints(docs, shingle, id_col, text_col), "simhash")
    return rows.join(components_of(rows, radius), "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp="fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for every component, with all its columns.

    A component is represented by its smallest id, and among its rows with that id by the smallest hash of
    the text; rows equal in both count as one.  Rows of other components never take its place, even where ids repeat.  The choice is made on narrow rows (id, fingerprint, hash).  The
    whole rows then meet the chosen keys once, in a hash join that neither sorts nor groups texts; only
    rows whose key repeats are grouped by it.  Rows without an id stay unless they are near copies of a row
    with one.  A null or empty text has fingerprint 0, so those are one component; an empty table gives no
    rows.
    """
    rows = written(keyed_fingerprints(docs, shingle, id_col, text_col), "simhash")
    found = rows.join(components_of(rows.select("doc_id", "fp"), radius), "fp")
    keys = ["doc_id", "h"]
    named = found.where(F.col("doc_id") == F.col("component_id")).groupBy(*keys, "root").agg(F.count(F.lit(1)).alias("n"))
    first = named.groupBy("doc_id", "root").agg(F.min(F.struct("h", "n")).alias("x")).select("doc_id", "x.h", "x.n")
    nameless = found.where(F.col("component_id").isNull()).groupBy(*keys).agg(F.lit(1).cast("long").alias("n"))
    chosen = written(first.union(nameless), "simhash-chosen")
    mark = "_".join(["hash", *docs.columns])
    whole = docs.withColumn(mark, F.xxhash64(F.col(text_col).cast("string")))

    def those(some: DataFrame) -> DataFrame:
        right = some.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).hint("shuffle_hash")
        return whole.join(right, F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (F.col(mark) == F.col("_h")), "left_semi")

    kept = those(chosen.where("n = 1"))
    repeated = chosen.where("n > 1")
    if not repeated.isEmpty():
        kept = kept.unionByName(those(repeated).dropDuplicates([id_col, mark]))
    return kept.select(docs.columns)


def keyed_fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, fp, h (hash of the text) of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("h", pa.int64())])

    def run(batches):
        def rows():
            for batch in batches:
                for doc_id, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                    yield doc_id, signed(fingerprint(text.as_py(), shingle)), h
        yield from arrow_rows(rows(), schema)

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text")).mapInArrow(
        run, "doc_id long, fp long, h long")
