"""Documents to training ids: a chain of stages over the operators of ``rookery.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rookery.llm import bpe, mixing, secret_scan, simhash, site_quality
from rookery.llm.queries import RADIUS_BITS, SHINGLE_WORDS, WORD_BPE, table
from rookery.workspace import stage as written

ORACLE_SQL = None  # trained scores, fingerprints and merges have no SQL form; see tests/llm/test_pipeline.py


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps, fitted on the labelled rows among them."""
    return site_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the smallest doc_id."""
    return simhash.keep_one(docs, shingle=SHINGLE_WORDS, radius=RADIUS_BITS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets masked."""
    return secret_scan.redact(docs)


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy of a document of which the mix takes words."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row left."""
    return bpe.digests(docs, WORD_BPE)


STAGES = [
    ("quality_classifier", good_quality),
    ("simhash_dedup", without_near_copies),
    ("secret_scan", without_secrets),
    ("source_mixing", to_target_weights),
    ("bpe_encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next stage."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES:
        docs = written(step(spark, docs, sf_dir), name)
    return docs
