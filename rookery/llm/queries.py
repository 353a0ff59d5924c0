"""The registered queries of this subpackage: thin forms of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.llm import (
    bit_codes, bpe, mixing, quality_rules, secret_scan, simhash, site_quality, surrogates, token_files, token_rollup,
    vector_codes, vector_topk, whitening,
)
from rookery.workspace import fresh_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# fixed values: the vocabulary file and end id of the contract
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
SHINGLE_WORDS, RADIUS_BITS = 4, 4
SURROGATE_KEY = b"an example key, not for real data"
QUERY_STEP, NEAREST, SCALE = 50, 5, 256
ANN_STEP, ANN_NEAREST = 20, 20


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under its function's name."""
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text through the trigram index."""
    return secret_scan.report(table(spark, sf_dir, "documents"))


ORACLES["op1_secret_scan"] = secret_scan.oracle()


@query
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return vector_topk.top_k(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0), NEAREST, scale=SCALE)


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every text."""
    return quality_rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its personal data replaced; the key of a real run comes from a secret store."""
    return surrogates.replace(table(spark, sf_dir, "documents"), SURROGATE_KEY)


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text by segment-tree merging."""
    return bpe.digests(table(spark, sf_dir, "documents"), WORD_BPE)


@query
def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by source, language and tokenizer version after loading, revising, deleting copies and a replay."""
    folder = fresh_folder(spark, "token-rollup")
    return token_rollup.history(table(spark, sf_dir, "documents"), folder, WORD_BPE).totals()


@query
def op7_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior quality of every document under its source and language section."""
    return site_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.report(table(spark, sf_dir, "documents"))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and the components of those within four bits."""
    return simhash.labelled(table(spark, sf_dir, "documents"), shingle=SHINGLE_WORDS, radius=RADIUS_BITS)


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every text's ids as flat files and read them back."""
    folder = fresh_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, WORD_BPE, END_ID)
    return token_files.checksums(token_files.read_token_files(spark, folder))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector along the four leading components, by contour integration."""
    return whitening.report(table(spark, sf_dir, "embeddings"), k=4, scale=SCALE)


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as eight code bytes, with its error and that of its label."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)


@query
def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest found of every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return bit_codes.search(vectors, vectors.where(F.col("vec_id") % ANN_STEP == 0), ANN_NEAREST)
