"""The registered queries of this package."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coldloop.llm import (
    decontaminate, embedding_dedup, filter_audit, jaccard_join, language_id, line_dedup, mixture, oracle,
    pii, quality_rules, spelling, substring_dedup, token_files, toxicity)
from coldloop.llm.text import load, stored
from coldloop.session import scratch_path

END_ID = 2
TOXIC_FROM = 0.3


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of smaller documents."""
    return substring_dedup.deduplicate(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op2_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix of all sources takes."""
    return mixture.mix(load(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text: base counts and digest, all spans and their scores."""
    def of(kind: str):
        return F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    return pii.detect(load(spark, sf_dir, "documents")).select(
        "doc_id", *(of(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        F.sha2(pii.listed(F.filter("pii", lambda s: s["base"])), 256).alias("base_sha256"),
        pii.listed(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",").alias("scores"))


def remainder(modulus: int) -> Column:
    """crc32 of the document id as text, modulo ``modulus``; rows without an id count as ""."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


def language_profiles(docs: DataFrame) -> language_id.Profiles:
    """Profiles from the documents that are not held out."""
    usable = (remainder(3) != 1) & F.col("text").isNotNull()
    return language_id.learn(language_id.training_rows(docs, usable, "doc_id", "lang"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of benchmark items, also with other numbers or names."""
    return decontaminate.leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"),
                               few_literals=True)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text."""
    docs = load(spark, sf_dir, "documents")
    texts = docs.select("doc_id", (remainder(3) == 1).alias("held_out"), "text")
    return language_id.identify(texts, language_profiles(docs)).drop("text")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated windows of three lines."""
    return line_dedup.deduplicate(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back from the files."""
    store = token_files.write_tokens(
        load(spark, sf_dir, "documents"), scratch_path(spark, "tokens"),
        public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return token_files.read_tokens(spark, store)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with similar sets of four-word shingles."""
    return jaccard_join.join(load(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every whole text."""
    docs = load(spark, sf_dir, "documents")
    model = toxicity.learn(toxicity.training_rows(
        docs, load(spark, sf_dir, "labels"), remainder(4) != 2, "doc_id", "text", "toxic"))
    texts = docs.select("doc_id", (remainder(4) == 2).alias("held_out"), "text")
    return toxicity.score(texts, model).drop("text").withColumn(
        "predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, components and representatives of all vectors."""
    return embedding_dedup.near_duplicates(load(spark, sf_dir, "embeddings"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failed rules and verdict of the policy in use, for every whole text."""
    entries = stored(quality_rules.ledger(load(spark, sf_dir, "documents")), "ledger")
    return quality_rules.apply_policy(entries, quality_rules.SECOND).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (quality_rules.broken(quality_rules.BASE) != 0).alias("base_failed"), "kept", "failures")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, the words one edit away, and the form each one stands for."""
    return spelling.variants(load(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes at each place of all their orders, per language."""
    counts = filter_audit.counted_masks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return filter_audit.audit(counts, filter_audit.letters_of()).drop("filter")


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_mixture": op2_mixture,
    "op3_pii": op3_pii,
    "op4_decontamination": op4_decontamination,
    "op5_language_id": op5_language_id,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_files": op7_token_files,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_toxicity": op9_toxicity,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_quality_rules": op11_quality_rules,
    "op12_spelling": op12_spelling,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL = {
    "op2_mixture": oracle.MIXTURE,
    "op6_line_dedup": oracle.LINE_DEDUP,
    "op11_quality_rules": oracle.QUALITY_RULES,
    "op12_spelling": oracle.SPELLING,
    "op13_filter_audit": oracle.FILTER_AUDIT,
}
