"""A training corpus from ``documents``: each stage works on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import bpe, decontaminate, langid, simhash, substrings
from threadloom.llm.common import materialise, remove


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, texts without a letter, and those whose best language scores under one half."""
    return langid.keep_known(docs, public_tokenizers.path("piece_bpe_32k.model"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays. The rule is that for texts with a few words changed, of which query op8's three bits would find few."""
    return simhash.deduplicate(docs, rule=simhash.WORDS)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of more than 50 words are cut out of the texts but for one copy of each, and n_chars counts what is left; every document stays."""
    return substrings.deduplicate(docs, shape=substrings.WORDS_50, keep="first").withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with windows of two or more benchmark items go; of those with windows of one, the hit words are cut out, and n_chars counts what is left."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    clean = decontaminate.decontaminate(docs, benchmark, mode="spans", min_items=1, drop_items=2)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text as ``ids``, and their number as ``n_tokens``, beside the documents' columns."""
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.withColumn("n_tokens", F.size("ids"))


STAGES = [
    ("language", language_stage),
    ("near_duplicates", simhash_stage),
    ("repeated_substrings", substring_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again, and what a stage has read goes when it is done."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, path = materialise(stage(spark, docs, sf_dir), name)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
