"""A corpus pipeline of this library's operators: quality classifier, language ID, SimHash near-duplicates, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandframe.llm import language_id, packing, quality, simhash
from strandframe.llm.common import load, write_table

Stage = tuple[str, object]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that importance resampling selects."""
    return quality.keep_selected(docs, load(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is told; dictionaries come from the documents themselves."""
    return language_id.keep_identified(docs, language_id.train_dictionaries(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: shingles of five words, similarity of 0.8 or more by wide fingerprints."""
    return simhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    return packing.pack(docs)


STAGES: list[Stage] = [("quality classifier", good_quality), ("language ID", known_language), ("SimHash near-dedup", one_of_each), ("packing", packed)]

#: No stage is expressible in SQL; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again as the next one's documents."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
