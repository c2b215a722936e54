"""Corpus pipeline: stages that each work on all documents their predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm.common import for_texts, read
from tickloom.llm.decontamination import without_leaks
from tickloom.llm.language_id import identify
from tickloom.llm.ngram_join import one_of_each
from tickloom.llm.packing import pack, tokenise
from tickloom.llm.pii import pseudonymise, session_key
from tickloom.llm.queries import LANGUAGES
from tickloom.session import scratch, use_utc


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is identified; their source stands for their host."""
    for_texts(spark)
    found = identify(docs, LANGUAGES, text=F.col("text"), declared=F.col("lang"), host=F.col("source"))
    return found.where("accepted").select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of similar ones."""
    for_texts(spark)
    return one_of_each(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark item is found."""
    return without_leaks(docs, read(spark, sf_dir, "benchmark"))


def private_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values replaced by pseudonyms; n_chars follows the text."""
    done = pseudonymise(docs, session_key(spark), count="n_private")
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col("n_private") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long"))
    return done.select(docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 2048 tokens."""
    for_texts(spark)
    return pack(tokenise(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language_id", languages),
    ("ngram_join", near_copies),
    ("decontamination", benchmarks),
    ("pii", private_values),
    ("packing", sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written as Parquet and read again."""
    use_utc(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
