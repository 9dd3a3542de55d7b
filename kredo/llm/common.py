"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kredo.session import ensure_checkpoint_dir, shared_path

#: Rows are handed to Spark in batches of about this many bytes of payload.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 4096


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there, and a lost
    executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (removed by Spark's cleaner where that is on)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def arrow_rows(rows: Iterable[tuple], schema: pa.Schema, weigh=None) -> Iterator[pa.RecordBatch]:
    """Rows (tuples in schema order) as record batches of bounded size.

    ``weigh(row)`` gives a row's payload bytes (0 when absent).
    """
    pending: list[tuple] = []
    size = 0
    for row in rows:
        pending.append(row)
        size += weigh(row) if weigh else 0
        if len(pending) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield to_batch(pending, schema)
            pending, size = [], 0
    if pending:
        yield to_batch(pending, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; every other column is pruned at the scan."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fold(id_col: str, n: int):
    """crc32 of the id written as text, modulo n: the fold rule of the labelled tables (a null id is fold 0)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % n, F.lit(0))


def among_lowest(h, share: float):
    """Whether a 64-bit hash is among about that share of all hashes, the smallest by unsigned order."""
    return F.shiftrightunsigned(h, 2) < int(min(1.0, share) * 2 ** 62)
