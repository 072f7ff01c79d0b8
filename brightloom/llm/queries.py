"""The queries of this package over the given tables, with the SQL each is checked against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from brightloom.llm import (
    bpe, chat, merkle, mixing, personal, phrases, quality, secrets, simhash, substrings, templates, tokenfile, vectors,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_documents(spark, sf_dir))


def op2_personal_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.scan(_documents(spark, sf_dir))


def op3_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_documents(spark, sf_dir))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_digests(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op7_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_documents(spark, sf_dir)).drop("kept")


def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.dedup_lines(_documents(spark, sf_dir), counts=True)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(_documents(spark, sf_dir))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_documents(spark, sf_dir))


def op12_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    # The contract adds this conversation: control strings and backslashes as text.
    odd = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], turns.schema)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return chat.read_back(chat.windows(turns.union(extra), ranks, public_tokenizers.PATTERN))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(_documents(spark, sf_dir))


PLANS = {
    "op1_secret_owners": (op1_secret_owners, None),
    "op2_personal_contexts": (op2_personal_contexts, None),
    "op3_vector_duplicates": (op3_vector_duplicates, None),
    "op4_quality_rules": (op4_quality_rules, quality.JUDGED_SQL),
    "op5_token_files": (op5_token_files, None),
    "op6_byte_bpe": (op6_byte_bpe, None),
    "op7_repeated_bytes": (op7_repeated_bytes, None),
    "op8_line_templates": (op8_line_templates, None),
    "op9_simhash": (op9_simhash, None),
    "op10_mix_sources": (op10_mix_sources, mixing.COUNTS_SQL),
    "op11_collocations": (op11_collocations, phrases.COLLOCATIONS_SQL),
    "op12_chat_windows": (op12_chat_windows, None),
    "op13_merkle_manifest": (op13_merkle_manifest, merkle.CHECK_SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
