"""The corpus pipeline: stages over ``documents``, each written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siteledger.llm.common import read_table, saved
from siteledger.llm.mixing import mixed_documents
from siteledger.llm.packing import pack
from siteledger.llm.quality import good_documents
from siteledger.llm.simhash import one_of_each
from siteledger.llm.substring import deduplicated


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return good_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: 3-word shingles, at most 2 bits apart."""
    return one_of_each(docs, shingle=3, radius=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words that earlier ones hold."""
    return deduplicated(docs, window=50)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in sequences of 4096 tokens."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL has neither the tokenizer nor the hashes; tests compare the pipeline with a plain version of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
