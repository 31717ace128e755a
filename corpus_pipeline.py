"""From raw documents to packed training sequences, in five written stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanewise.llm import neardup, packing, quality, secrets, toxicity
from lanewise.llm.common import documents, vocabulary_file, written

#: Near-duplicates share 80 percent of their five-word shingles.
FOREST = neardup.Forest(words=5, similarity=80)

#: Remembered ids of a packing task: executors hold the stages before as well.
CACHE_BYTES = 24 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the classifier learns from this corpus and its labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.keep(docs, toxicity.train(docs, labels))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule."""
    return quality.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.keep_one(docs, FOREST)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their places in sequences."""
    return packing.packed(docs, vocabulary_file("word_bpe_49k.json"), cache_bytes=CACHE_BYTES)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("minhash_near_dedup", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("packing", pack_sequences),
]

#: Learned scores and tokenizers are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the documents that every stage keeps; each stage reads what the one before wrote.

    Of several rows of one doc_id the near-duplicate stage keeps that of the least text.
    """
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
