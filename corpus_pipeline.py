"""Corpus pipeline: raw documents to packed training sequences.

Each stage takes all that its predecessor kept, is written as Parquet and read again.  The first four
return the columns of ``documents``; packing returns its pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kredo.llm import decontam, packing, pii, quality_rules, simhash
from kredo.llm.common import id_and_text, read, written

#: Some stages fit models or hash exactly, so SQL can't express the whole run.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the calibrated classifier of ``labels.quality``."""
    labels = quality_rules.quality_labels(read(spark, sf_dir, "labels"))
    return quality_rules.keep(docs, quality_rules.fit(id_and_text(docs), labels))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every near-duplicate component (3-word shingles, 3 bits)."""
    return simhash.keep_first(docs, shingle=3, radius=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.mask(docs, pii.fit(id_and_text(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 ids."""
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("SimHash near-dedup", deduplicate), ("benchmark decontamination", decontaminate),
          ("PII", mask_pii), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"corpus-{k}")
    return docs
