"""Token-id store: every document's ids as its own zstandard frame, with one shared dictionary.

Layout under a folder:

* ``dictionary``: one row (sha256 of the dictionary, its bytes; no bytes if none could be trained);
* ``blocks``: ids in ascending document order.  Each row is one block: its shard, its number in
  the shard, the ids before it in the shard, first and last document id, and ``data``:

      magic "ZIDS" | u32 documents | 32 bytes sha256 of the dictionary
      i64 document ids | u64 frame offsets (documents + 1) | u32 ids per document | u8 bytes per id | u8 id present
      frames

The offset index gives one document without touching the others; the hash refuses a wrong
dictionary.  Spark writes and reads the files, so any storage that Spark reaches will do, and a
lost executor's part is written again.

Defined results: a null or empty text is its end id alone; repeated rows are stored as often as
they occur (texts of one id in hash order); null ids come first; an empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kredo.llm import tokens
from kredo.llm.common import among_lowest, arrow_rows, id_and_text, written

MAGIC = b"ZIDS"
BLOCK_SCHEMA = ("shard int, block int, start_in_shard long, n_docs long, n_ids long, "
                "first_doc long, last_doc long, data binary")
_BLOCKS = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("start_in_shard", pa.int64()),
                     ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("first_doc", pa.int64()),
                     ("last_doc", pa.int64()), ("data", pa.binary())])
FRAME_SCHEMA = "doc_id long, h long, row long, n_ids long, width int, frame binary"
_FRAMES = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("row", pa.int64()), ("n_ids", pa.int64()),
                     ("width", pa.int32()), ("frame", pa.binary())])
DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def narrow(ids: bytes) -> tuple[bytes, int]:
    """Serialized id array in 2 bytes an id where all fit, else 4."""
    a = np.frombuffer(ids, "<u4")
    return (a.astype("<u2").tobytes(), 2) if not a.size or int(a.max()) < 1 << 16 else (ids, 4)


def widen(data: bytes, width: int) -> bytes:
    return data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def train_dictionary(docs: DataFrame, path: str, end_id: int | None, size: int, sample_docs: int,
                     sample_bytes: int) -> bytes:
    """A dictionary from the id arrays of at most ``sample_docs`` documents of at most
    ``sample_bytes`` bytes each, those with the smallest hash of id and text.

    Only this fit looks at a sample; all documents are stored.  The row count (from file footers) sets
    a hash below which a few times the sample falls, so no task sorts or sends more.  With too few
    samples to train on, their concatenation serves as a raw dictionary; with none there is no dictionary.
    """
    h = F.xxhash64("doc_id", "text")
    low = among_lowest(h, 3 * sample_docs / max(1, docs.count()))
    chosen = (docs.where(F.octet_length("text").between(1, sample_bytes)).where(low)
                  .select("text", h.alias("h")).orderBy("h", "text").limit(sample_docs))
    encode = tokens.encoder(path)
    tail = tokens.end_bytes(end_id)
    samples = [narrow(encode.ids(r["text"]) + tail)[0] for r in chosen.select("text").collect()]
    if not samples:
        return b""
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[-size:]


def build_block(docs: list[tuple], dictionary_hash: bytes) -> bytes:
    """docs: (doc_id, ids, bytes per id, frame)."""
    offsets = np.zeros(len(docs) + 1, "<u8")
    np.cumsum([len(frame) for _, _, _, frame in docs], out=offsets[1:])
    return b"".join([MAGIC, struct.pack("<I", len(docs)), dictionary_hash,
                     np.asarray([d[0] or 0 for d in docs], "<i8").tobytes(), offsets.tobytes(),
                     np.asarray([d[1] for d in docs], "<u4").tobytes(), bytes(d[2] for d in docs),
                     bytes(d[0] is not None for d in docs), *[d[3] for d in docs]])


class Block:
    """Random access to the documents of one block."""

    def __init__(self, data: bytes, dictionary_hash: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token-id block")
        self.n = struct.unpack_from("<I", data, 4)[0]
        if data[8:40] != dictionary_hash:
            raise ValueError("the block was written with another dictionary")
        at, n = 40, self.n
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        self.offsets = np.frombuffer(data, "<u8", n + 1, at + 8 * n)
        self.counts = np.frombuffer(data, "<u4", n, at + 16 * n + 8)
        self.widths = np.frombuffer(data, "u1", n, at + 20 * n + 8)
        self.present = np.frombuffer(data, "u1", n, at + 21 * n + 8)
        self.data, self.base = data, at + 22 * n + 8

    def ids(self, k: int, decompress) -> bytes:
        frame = self.data[self.base + int(self.offsets[k]):self.base + int(self.offsets[k + 1])]
        ids = widen(decompress(frame), int(self.widths[k]))
        if len(ids) != 4 * int(self.counts[k]):
            raise ValueError("a frame does not hold the ids that the index names")
        return ids


def _dictionary(data: bytes):
    return zstd.ZstdCompressionDict(data) if data else None


def write_store(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int | None = 2,
                dictionary_size: int = 65536, sample_docs: int = 1000, sample_bytes: int = 16384,
                block_ids: int = 1 << 20, level: int = 3, partitions: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write the store.

    Texts are encoded and compressed where they are scanned.  Only frames are shuffled, once, by ranges of
    id, text hash and row number, so neither a frequent id nor a frequent row falls to one task.
    """
    spark = docs.sparkSession
    docs = id_and_text(docs, id_col, text_col)
    tok = tokenizer_path or tokens.default_path()
    dictionary = train_dictionary(docs, tok, end_id, dictionary_size, sample_docs, sample_bytes)
    digest = hashlib.sha256(dictionary).digest()
    tail = tokens.end_bytes(end_id)

    def compressed(batches) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tok)
        d = _dictionary(dictionary)
        compress = zstd.ZstdCompressor(level=level, dict_data=d, write_content_size=True).compress

        def rows():
            for batch in batches:
                keys = zip(*[c.to_pylist() for c in batch.columns[:3]])
                for key, text in zip(keys, batch.column(3)):
                    ids = encode.ids(text.as_py()) + tail
                    data, width = narrow(ids)
                    yield *key, len(ids) // 4, width, compress(data)

        yield from arrow_rows(rows(), _FRAMES, weigh=lambda r: len(r[-1]))

    def blocks(batches) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()

        def rows():
            block, start, pending, size = 0, 0, [], 0
            for batch in batches:
                for doc in zip(*[c.to_pylist() for c in batch.columns]):
                    pending.append(doc)
                    size += doc[1]
                    if size >= block_ids:
                        yield row(block, start, size, pending)
                        block, start, pending, size = block + 1, start + size, [], 0
            if pending:
                yield row(block, start, size, pending)

        def row(block, start, size, pending):
            return shard, block, start, len(pending), size, pending[0][0], pending[-1][0], build_block(pending, digest)

        yield from arrow_rows(rows(), _BLOCKS, weigh=lambda r: len(r[-1]))

    numbered = docs.select("doc_id", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"), "text")
    frames = written(numbered.mapInArrow(compressed, FRAME_SCHEMA), "token-frames")
    order = ("doc_id", "h", "row")
    ranged = frames.repartitionByRange(partitions, *order) if partitions else frames.repartitionByRange(*order)
    (ranged.sortWithinPartitions(*order).select("doc_id", "n_ids", "width", "frame")
           .mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(f"{path}/blocks"))
    (spark.createDataFrame([(digest.hex(), bytearray(dictionary))], "sha256 string, dictionary binary")
          .coalesce(1).write.parquet(f"{path}/dictionary"))


def open_store(spark: SparkSession, path: str) -> tuple[DataFrame, bytes, bytes]:
    """Blocks, the dictionary and its hash (checked)."""
    row = spark.read.parquet(f"{path}/dictionary").collect()[0]
    dictionary = bytes(row["dictionary"])
    digest = hashlib.sha256(dictionary).digest()
    if digest.hex() != row["sha256"]:
        raise ValueError("the stored dictionary is damaged")
    return spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks"), dictionary, digest


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Every document with its ids and the number of ids of all documents before it.

    Shards are ranges in ascending order, so a shard's first place is the sum of the shards before
    it: one row a shard, summed from the blocks' index columns (the data column is not read for it).
    """
    blocks, dictionary, digest = open_store(spark, path)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))

    def run(batches):
        decompress = zstd.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress

        def rows():
            for batch in batches:
                for start, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                    block = Block(data.as_py(), digest)
                    for k in range(block.n):
                        n = int(block.counts[k])
                        yield int(block.doc_ids[k]) if block.present[k] else None, start, n, block.ids(k, decompress)
                        start += n

        yield from arrow_rows(rows(), _DOCS, weigh=lambda r: len(r[3]))

    placed = blocks.join(before, "shard").select((F.col("before") + F.col("start_in_shard")).alias("start"), "data")
    return placed.mapInArrow(run, DOC_SCHEMA)


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> dict[int, list[bytes]]:
    """The ids of a few documents: only blocks whose range can hold one are read, and only their frames decoded."""
    blocks, dictionary, digest = open_store(spark, path)
    decompress = zstd.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress
    found: dict[int, list[bytes]] = {}
    for wanted in sorted(set(doc_ids)):
        near = blocks.where((F.col("first_doc") <= wanted) & (F.col("last_doc") >= wanted)).orderBy("shard", "block")
        for row in near.select("data").toLocalIterator():
            block = Block(bytes(row["data"]), digest)
            for k in np.flatnonzero((block.doc_ids == wanted) & (block.present == 1)):
                found.setdefault(wanted, []).append(block.ids(int(k), decompress))
    return found
