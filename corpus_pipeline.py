"""The corpus pipeline: documents to packed sequences, each stage over all that the one before kept.

In every stage a null text counts as empty, rows may repeat, other columns may have any names and pass unchanged, and an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordloom.llm.common import Scratch, table
from recordloom.llm.exact_dedup import keep_unique
from recordloom.llm.jaccard_join import keep_one
from recordloom.llm.mixing import mixed
from recordloom.llm.packing import pack
from recordloom.llm.quality import accepted, train


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; empty ones are scored like others, rows without a doc_id too."""
    return accepted(docs, train(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one of the largest doc_id; null and empty texts are one group."""
    return keep_unique(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words a shingle, similarity 0.8 or more.

    The one of the smallest doc_id stays, of repeated rows all; documents without words and those without a doc_id have no near copies.
    """
    return keep_one(docs, percent=80, width=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a null source is one of its own, and documents without words cost nothing."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences; a document without text is its end id alone, and rows that repeat a doc_id are packed each."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality classifier", quality), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup), ("mixing sources", mix), ("packing", packing)]

#: A classifier, a similarity join over shingles and a tokenizer are beyond SQL; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; every result but the last is written as Parquet and read again, and removed when the next is written."""
    at = Scratch(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = at.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            at.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
