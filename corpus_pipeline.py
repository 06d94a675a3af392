"""A corpus from raw documents: STAGES in order, each on all that the one before it kept.

Every stage but the last returns the columns of documents; ``run`` writes each stage's result and
reads it back as the next one's documents. Empty tables and nulls in any column pass through all
stages as their operators define.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldloop.llm import decontaminate, jaccard_join, language_id, mixture, token_files
from coldloop.llm.queries import END_ID, language_profiles
from coldloop.llm.text import load, stored, without
from coldloop.session import scratch_path

#: Least nearness to a language's profile; noise without any language's n-grams is below it. Texts
#: with fewer letters have too few n-grams for a rank order and are not judged by it.
LEAST_SCORE, LEAST_LETTERS = 0.3, 40
#: Near copies: words per shingle and least Jaccard similarity in hundredths. ``op8`` has its own.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80
#: Text bytes encoded at once and handed to a worker at once. The stages before leave executors with
#: a full heap, so token files take less besides it.
ENCODED_SLICE, ENCODED_BATCH = 1 << 20, 4 << 20


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that are in no language: without letters, or far from all profiles.

    Short texts go only if they have no letter.
    """
    judged = language_id.identify(docs, language_profiles(docs), predicted="_lang", score="_near")
    return judged.where((F.col("_lang") != language_id.UNDETERMINED)
                        & ((F.col("_near") >= LEAST_SCORE)
                           | (F.length(F.regexp_replace("text", r"\P{L}+", "")) < LEAST_LETTERS))
                        ).select(*docs.columns)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number for each row, and that column's name.

    Stages drop by it, as ids may be null or repeated. A stage's documents are a written table, so
    a row has the same number in every scan and in a task that is run again.
    """
    name = "_row"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, F.monotonically_increasing_id()), name


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones: the smallest id, null last, then the first row."""
    rows, row = numbered(docs)
    groups = jaccard_join.join(rows, shingle=NEAR_SHINGLE, percent=NEAR_PERCENT, id_column=row)
    members = rows.select(F.col(row).alias("row"), F.col("doc_id").alias("id")).join(
        groups.select(F.col("doc_id").alias("row"), "component_id"), "row")
    order = F.struct(F.col("id").isNull(), "id", "row")
    # A large group meets in the pre-aggregated minimum only: the anti-join is by row.
    first = members.groupBy("component_id").agg(F.min(order)["row"].alias("row"))
    others = members.select("row").join(first.select("row"), "row", "left_anti")
    return without(rows, others.select(F.col("row").alias(row)), row).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without rows that hold passages of the benchmark."""
    rows, row = numbered(docs)
    found = decontaminate.leaks(rows, load(spark, sf_dir, "benchmark"), id_column=row,
                                few_literals=True)
    return without(rows, found.select(F.col("doc_id").alias(row)), row).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, cut or left out so that the sources have their target weights."""
    return mixture.taken_texts(mixture.mix(docs, keep_rows=True)).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; one row per document written, as read back from the files."""
    store = token_files.write_tokens(docs, scratch_path(spark, "tokens"),
                                     public_tokenizers.path("word_bpe_49k.json"), END_ID,
                                     slice_bytes=ENCODED_SLICE, batch_bytes=ENCODED_BATCH)
    return token_files.read_tokens(spark, store)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identified),
    ("jaccard_join", distinct_documents),
    ("decontamination", decontaminated),
    ("mixture", mixed),
    ("token_files", encoded),
]

#: Profiles, template matching and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
