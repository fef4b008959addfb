"""From raw documents to packed training sequences: one stage per operator, each table written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wiretide.llm import language_id, mixing, near_duplicates, packing, repetition
from wiretide.llm.common import in_small_batches, read_table, ship_package
from wiretide.llm.queries import WORD_TOKENIZER, tokenizer_path
from wiretide.sources.storage import materialize


@in_small_batches
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, by a model of the labelled ones among them."""
    return language_id.keep_known(docs, language_id.fit(docs))


@in_small_batches
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return repetition.keep_good(docs)


@in_small_batches
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_duplicates.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix(docs)


@in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence."""
    return packing.pack_documents(docs, tokenizer_path(WORD_TOKENIZER))


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("mix", mix_sources),
    ("pack", pack),
]

# Packing needs the tokenizers library: tests/llm hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
