"""One query per operator, over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm.common import read
from tickloom.llm import language_id, toxicity, window_fill
from tickloom.llm.decontamination import find_leaks
from tickloom.llm.html_extract import extract
from tickloom.llm.infill import fill_in_middle, restored
from tickloom.llm.ngram_join import similar_sets
from tickloom.llm.packing import pack, tokenise
from tickloom.llm.phrases import collocations
from tickloom.llm.pii import pseudonymise, session_key
from tickloom.llm.sharding import interleave
from tickloom.llm.url_filter import HostRule, judge_urls
from tickloom.llm.vector_dedup import link_vectors

URL_RULES = (
    HostRule("com", "/", "allow"),
    HostRule("example.com", "/en/", "block"),
    HostRule("www.example.com", "/en/", "allow"),
    HostRule("net", "/es/", "block"),
    HostRule("net", "/fr/", "block"),
)

LANGUAGES = ("de", "en", "es", "fr")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings linked at cosine 0.9, whatever their labels."""
    return link_vectors(read(spark, sf_dir, "embeddings"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the longest fitting rule, else by the character models."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge_urls(pages, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("llr", 6).alias("llr"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens packed into sequences of at most 2048."""
    pieces = tokenise(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=2048, end=0)
    return pack(pieces, limit=2048)


def op4_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with their best window."""
    found = find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.withColumn("similarity", F.round("similarity", 6))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; its source stands for its host, ``lang`` is what it declares."""
    docs = read(spark, sf_dir, "documents")
    found = language_id.identify(docs, LANGUAGES, text=F.col("text"), declared=F.col("lang"), host=F.col("source"))
    return found.select("doc_id", "source", "lang", "language", F.round("confidence", 6).alias("confidence"), "accepted")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's set of 5-word shingles, and its component at 80 % similarity."""
    return similar_sets(read(spark, sf_dir, "documents"))


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal values replaced by their keyed pseudonyms."""
    return pseudonymise(read(spark, sf_dir, "documents"), session_key(spark))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; labels whose documents are held out teach nothing."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = toxicity.fit(docs, labels.where(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.toxicity(F.col("text"), docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards, row counts at most one apart, each shard like the mixture."""
    rows = read(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = interleave(rows, 16, order=["doc_id", "text_crc32"], seed=20)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    out = extract(read(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fill-in-middle form, and the text rebuilt from it."""
    made = fill_in_middle(read(spark, sf_dir, "documents"))
    rebuilt = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(rebuilt, 256).alias("restored_sha256"),
    )


def op12_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of 4096, filled by solved length combinations."""
    docs = read(spark, sf_dir, "documents")
    return window_fill.pack(window_fill.tokenise(docs, public_tokenizers.path("word_bpe_49k.json"), limit=4096, end=2), limit=4096)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of words that mostly occur together."""
    return collocations(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_near_vectors": op1_near_vectors,
    "op3_packing": op3_packing,
    "op4_leaks": op4_leaks,
    "op5_language": op5_language,
    "op6_ngram_join": op6_ngram_join,
    "op7_pseudonyms": op7_pseudonyms,
    "op2_url_filter": op2_url_filter,
    "op8_toxicity": op8_toxicity,
    "op9_interleave": op9_interleave,
    "op10_html": op10_html,
    "op11_infill": op11_infill,
    "op12_nnls_packing": op12_nnls_packing,
    "op13_collocations": op13_collocations,
}
