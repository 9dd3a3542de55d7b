"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kredo.llm import decontam, hard_negatives, langid, merkle, mixing, packing, pii, quality_pu, quality_rules, sharding, simhash, token_store, warc
from kredo.llm.common import fold, fresh_path, id_and_text, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_kdtree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    placed = sharding.kd_shards(read(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op2_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item in every document that holds it."""
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op3_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 ids, with the crc32 of each piece's ids."""
    pieces = packing.pack(read(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query
def op4_bilstm_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: exact base spans, and those that the tagger adds."""
    docs = read(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(id_and_text(docs)))


@query
def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages, each with the checksum of its bytes."""
    made = warc.derivatives(warc.responses(read(spark, sf_dir, "pages")))
    return made.withColumn("record_crc32", F.crc32("record")).drop("record")


@query
def op6_ball_hash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of all documents (3-word shingles, 3 bits)."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@query
def op7_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents, learnt from positives outside the held-out fold."""
    docs = read(spark, sf_dir, "documents")
    seen = fold("doc_id", quality_pu.FOLDS) != quality_pu.HELD_OUT
    labels = quality_rules.quality_labels(read(spark, sf_dir, "labels")).where(seen)
    return quality_pu.score(docs, quality_pu.fit(id_and_text(docs).where(seen), labels))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of all documents, by the model of ``labels.quality``."""
    docs = read(spark, sf_dir, "documents")
    model = quality_rules.fit(id_and_text(docs), quality_rules.quality_labels(read(spark, sf_dir, "labels")))
    return quality_rules.score(docs, model)


@query
def op9_zstd_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the store of all documents and returns what its files hold."""
    path = fresh_path(spark, "token-store")
    token_store.write_store(read(spark, sf_dir, "documents"), path)
    return token_store.read_store(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op10_byte_cnn_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt from those outside the held-out fold."""
    docs = read(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest, proof and verification of all documents in the manifest of the whole table."""
    return merkle.manifest(read(spark, sf_dir, "documents"))


@query
def op11_lemp_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth row of embeddings against all rows."""
    rows = hard_negatives.usable(read(spark, sf_dir, "embeddings"))
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", turned), F.col("vec_id") % 50 == 0)


ORACLE["op11_lemp_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM e a JOIN e r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS nth
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(nth AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE nth <= 3"""


@query
def op12_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all documents takes from each, by sources weighing 1, 2, 3 in turn."""
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
