"""Mixing sources to target weights by pivotal dependent rounding.

A source's target of words over its size is the copies that each of its documents should get.  The whole
part is taken as it is; the fraction is a probability of one more copy, and these are rounded together.
Two documents with fractions are paired: words are moved from one to the other, in a direction drawn so
that both keep their expected copies, until one of them has no fraction left.  The expected words of the
source never change in such a step, so at its end only one document of a source is still between.

Sources are dealt into leaves of bounded size by a hash of the document, so a source that holds most
rows is many leaves.  A task pairs the documents of a leaf in falling size, which leaves a small one
over.  What is left goes up a reduction tree, ``fan`` leaves at a time, until one node a source is left.
There the last fraction is rounded to the nearer side, and some of the decisions, which had been kept
open for it (``KEPT`` of each direction and power of two of the size), are turned over as long as that
brings the words nearer to the target.  A document's copies are always its rate rounded down or up.

Draws are hashes of the rows, so reruns agree whatever the number of tasks.

Defined results: a null text has size 0, as has one without words; nothing is taken of them.  A null
source is a source of its own and the last one.  Repeated rows are mixed each on its own; which of
them gets a copy is not told apart by any column.  If there are no words, all targets are 0.  An empty
table gives no rows.  Columns other than id, text and source are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kredo.llm.common import arrow_rows, written
from kredo.operators.ranges import running_total

#: Documents of a leaf, about; and nodes that the tree joins into one.
LEAF, FAN = 4096, 64
#: Copies of a document at most.
MOST = 3
#: Words match [^\x20\x09-\x0D]+.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Decisions that a node keeps open of each direction and power of two of the size.
KEPT = 16
#: A fraction this near to 0 or 1 is rounding error.
NEAR = 1e-12

STATE = "doc_id long, size long, tree long, leaf long, row long, base int, p double, open boolean"
_STATE = pa.schema([("doc_id", pa.int64()), ("size", pa.int64()), ("tree", pa.int64()), ("leaf", pa.int64()),
                    ("row", pa.int64()), ("base", pa.int32()), ("p", pa.float64()), ("open", pa.bool_())])

Doc = list          # in the order of _STATE


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """source, rows, source_size, tree (the source's number from 0), target.

    sizes: source, rows, source_size.  Targets are in proportion to the weights, which repeat along the
    sources in code point order with null last, and sum to all words.  A target above ``most`` times its
    source's size stops there, and what is left goes to the others by weight, until none is above.
    """
    keyed = sizes.withColumn("all", F.lit(0)).withColumn("one", F.lit(1)).withColumn(
        "key", F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit(""))))
    ranked = running_total(keyed, ["all"], "key", "one", "nth")
    weight = F.element_at(F.lit(list(weights)), (F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = written(ranked.select("source", "rows", "source_size", (F.col("nth") - 1).alias("tree"),
                                  weight.cast("double").alias("weight")), "mix-sources")
    total, weighed = table.agg(F.sum("source_size"), F.sum("weight")).first()
    left, stopped = float(total or 0), 0
    cap = most * F.col("source_size")
    while True:
        share = F.lit(left) * F.col("weight") / F.lit(weighed or 1.0)
        over = share > cap
        row = table.agg(F.count_if(over), F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))).first()
        if row[0] == stopped or not row[2]:
            break
        stopped, left, weighed = row[0], float(total - row[1]), row[2]
    return table.select("source", "rows", "source_size", "tree",
                        F.when(over, cap.cast("double")).otherwise(share).alias("target"))


def draw(seed: int, a: Doc, b: Doc) -> float:
    """A number from 0 to 1 that the two rows decide."""
    said = f"{seed}|{a[0]}|{a[4]}|{b[0]}|{b[4]}".encode()
    return int.from_bytes(hashlib.blake2b(said, digest_size=7).digest(), "big") / float(1 << 56)


def pivot(a: Doc, b: Doc, seed: int) -> tuple[Doc | None, list[Doc]]:
    """Move words between two fractions until one is 0 or 1: what still has a fraction (if any), and the others."""
    size, p = 1, 6
    up = min((1 - a[p]) * a[size], b[p] * b[size])          # words that a can gain from b
    down = min(a[p] * a[size], (1 - b[p]) * b[size])
    words = up if draw(seed, a, b) * (up + down) < down else -down
    a[p] += words / a[size]
    b[p] -= words / b[size]
    left, done = None, []
    for d in (a, b):
        if d[p] < NEAR or d[p] > 1 - NEAR:
            d[p] = float(round(d[p]))
            done.append(d)
        else:
            left = d
    return left, done


class Node:
    """One node of a source's tree: takes documents, keeps one fraction and a few decisions open."""

    def __init__(self, seed: int):
        self.seed, self.left = seed, None
        self.kept: dict[tuple[int, bool], list[Doc]] = {}

    def keep(self, doc: Doc) -> bool:
        """Keep a decision open if there is room for it."""
        held = self.kept.setdefault((doc[1].bit_length(), doc[6] > 0.5), [])
        if len(held) < KEPT:
            held.append(doc)
            return True
        return False

    def add(self, doc: Doc) -> Iterator[Doc]:
        if not doc[1]:
            doc[6] = 0.0                                    # nothing to take
            yield doc
            return
        if doc[6] in (0.0, 1.0):
            done = [doc]
        elif self.left is None:
            self.left, done = doc, []
        else:
            self.left, done = pivot(self.left, doc, self.seed)
        yield from (d for d in done if not self.keep(d))

    def decided(self) -> list[Doc]:
        return [d for held in self.kept.values() for d in held]

    def close(self) -> Iterator[Doc]:
        """All that is open, to go up."""
        for d in [*self.decided(), *([self.left] if self.left else [])]:
            d[7] = True
            yield d

    def settle(self) -> Iterator[Doc]:
        """All that is open, decided."""
        need = 0.0                                          # words that are missing
        if self.left:
            need = (self.left[6] - round(self.left[6])) * self.left[1]
            self.left[6] = float(round(self.left[6]))
        for d in sorted(self.decided(), key=lambda d: (-d[1], d[6], d[0] or 0, d[4])):
            gain = d[1] if d[6] == 0.0 else -d[1]
            if abs(need - gain) < abs(need):
                need -= gain
                d[6] = 1.0 - d[6]
        yield from self.close()


def level(state: DataFrame, seed: int, last: bool) -> DataFrame:
    """The documents after one level of the tree: ``open`` ones go on, at the last level none is open.

    state: the columns of STATE and ``fraction`` (whether a document has one).  Documents whose rate is
    whole are not part of it.
    """
    ordered = state.repartition("tree", "leaf").sortWithinPartitions(
        "tree", "leaf", F.col("size").desc(), F.col("doc_id").asc_nulls_first(), "row")

    def run(batches):
        def rows():
            node, at = None, None
            for batch in batches:
                for doc in zip(*[c.to_pylist() for c in batch.columns]):
                    doc = [*doc[:7], False]
                    if (doc[2], doc[3]) != at:
                        if node:
                            yield from finish(node)
                        node, at = Node(seed), (doc[2], doc[3])
                    yield from node.add(doc)
            if node:
                yield from finish(node)

        def finish(node):
            if not last:
                yield from node.close()
                return
            for d in node.settle():
                d[7] = False
                yield d

        yield from arrow_rows(rows(), _STATE)

    return ordered.select(*_STATE.names).mapInArrow(run, STATE)


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST, seed: int = 12, leaf: int = LEAF,
        fan: int = FAN, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: doc_id, size, source, source_size, target, copies, taken (size times copies)."""
    text = F.col(text_col).cast("string")
    sized = written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        n_words(text).alias("size"), F.xxhash64(F.col(id_col).cast("long"), text).alias("row")), "mix-sizes")
    goals = written(targets(sized.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size")),
                            weights, most), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = goals.select(F.col("source").alias("_source"), "tree", rate.alias("rate"),
                        F.ceil(F.col("rows") / leaf).alias("leaves"))
    whole = F.floor(F.col("rate") + NEAR)
    state = sized.join(goal, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "tree", F.pmod(F.col("row"), F.col("leaves")).alias("leaf"), "row", whole.cast("int").alias("base"),
        F.greatest(F.col("rate") - whole, F.lit(0.0)).alias("p"), F.lit(True).alias("open"))
    high = int(goals.agg(F.max(F.ceil(F.col("rows") / leaf))).first()[0] or 1)
    done = [state.where(F.col("p") <= NEAR).withColumn("p", F.lit(0.0))]
    live = state.where(F.col("p") > NEAR)
    while True:
        now = written(level(live, seed, last=high == 1), "mix-level")
        done.append(now.where("not open"))
        if high == 1:
            break
        high = -(-high // fan)
        live = now.where("open").withColumn("leaf", F.floor(F.col("leaf") / fan))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    copies = (F.col("base") + F.col("p")).cast("long")
    return out.select("doc_id", "size", copies.alias("copies"), (F.col("size") * copies).alias("taken"), "tree").join(
        goals.drop("rows"), "tree").select("doc_id", "size", "source", "source_size", "target", "copies", "taken")
