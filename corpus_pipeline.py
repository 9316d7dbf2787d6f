"""From documents to token ids: five stages, each a table for the next.

Rejected documents go, repeated lines go, one document of each group of near copies
stays, sources are mixed to their weights, and the texts are encoded and decoded.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolane.llm import linededup, mixing, ngramjoin, quality, sentencepieces
from tempolane.sources.shared import new_path, send_package, settled


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits and the learned rules keep."""
    rules = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, rules).filter("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; lines that stand before, exactly or nearly, are gone from them."""
    rows = linededup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    return rows.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by similar ones the one with the smallest id. Documents
    without words, which line dedup may leave, and without an id all stay."""
    linked = ngramjoin.link(docs)
    gone = linked.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    kept = docs.join(gone, F.col("doc_id") == F.col("gone"), "left_anti")
    return kept.dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text and the text that they decode to."""
    return sentencepieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read back."""
    send_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), new_path(spark, name))
    return STAGES[-1][1](spark, docs, sf_dir)


# The stages' learned rules, fuzzy lines and encoder can't be said in SQL.
ORACLE_SQL = None
