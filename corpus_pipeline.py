"""Documents to training ids: five stages, each over all rows that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.llm import bpe, mixing, quality, simhash, templates
from brightloom.llm.shared import stored


def _recounted(docs: DataFrame) -> DataFrame:
    """`n_chars` of texts that a stage changed; the columns stay in their order."""
    return docs.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or are depleted without the common lines of their source, go."""
    return _recounted(quality.keep_good(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go, but for the first document's."""
    return _recounted(templates.dedup_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: fingerprints of three-word shingles, at most three differing bits."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix: a document stands in it once for each pass that takes words of it."""
    return _recounted(mixing.mix(docs))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, text_sha256, decoded_sha256) of every row of the mix."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(
        docs.select("doc_id", "source", "text"), ranks, public_tokenizers.PATTERN, decoded_sha256="decoded_sha256"
    )
    return encoded.select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), "decoded_sha256",
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

# Template trees, components of near-duplicates and merges by rank have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are a written table for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
