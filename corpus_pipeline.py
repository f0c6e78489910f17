"""Clean, deduplicate, decontaminate, mix and shard the documents.

Each stage takes the rows its predecessor wrote and returns rows with the columns
of ``documents``; the last adds ``shard`` and ``slot``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from loomcast.llm.common import Scratch, table
from loomcast.llm.decontaminate import DecontaminateSettings, clean_documents
from loomcast.llm.mixing import MixSettings, mixed_documents
from loomcast.llm.near_dup import NearDupSettings, distinct_documents
from loomcast.llm.quality import QualitySettings, good_documents
from loomcast.llm.sharding import ShardSettings, sharded_documents
from loomcast.session import ship_package


def stage(function):
    """A stage that may be called on its own: workers get the package first."""

    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, docs, sf_dir)

    return run


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return good_documents(docs, table(spark, sf_dir, "labels"), QualitySettings())


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8)."""
    return distinct_documents(docs, NearDupSettings(width=5, percent=80))


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of any benchmark item to be contaminated."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"), DecontaminateSettings())


@stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the sources have their target weights."""
    return mixed_documents(docs, MixSettings())


@stage
def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot."""
    return sharded_documents(docs, ShardSettings())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The classifier's decisions have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, function in STAGES:
        docs = scratch.save(function(spark, docs, sf_dir), name)
    return docs
