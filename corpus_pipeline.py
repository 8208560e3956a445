"""From raw documents to mixed and sharded training data.

Each stage works on all rows that the one before has kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import decontamination, mixing, near_duplicates, quality, sharding
from daybook.llm.frames import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

ORACLE_SQL = None  # SQL has no counterpart of the classifier, the fingerprints and the shards


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones."""
    return quality.accepted(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (shingles of three words, at most three bits apart)."""
    return near_duplicates.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with size, text_crc32, law, shard, slot and grown_shard."""
    return sharding.assigned(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
