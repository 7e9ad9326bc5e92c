"""From raw documents to sharded training text, each stage one of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logquarry.llm.common import stored, table
from logquarry.llm.kneser_ney import keep_identified
from logquarry.llm.mixing import mixed_documents
from logquarry.llm.ring import shard_rows
from logquarry.llm.simhash_vptree import one_of_each_group
from logquarry.llm.wu_manber import remove_contaminated


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the models learn from the stage's own input."""
    return keep_identified(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (four words, 4 bits), the one with the smallest id."""
    return one_of_each_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them, none of them without words."""
    return mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their slot in it."""
    return shard_rows(docs)


STAGES = [
    ("language_id", identified),
    ("near_dedup", deduplicated),
    ("decontaminate", decontaminated),
    ("mix", mixed),
    ("shard", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language models and trees of fingerprints are beyond SQL; tests/llm has the rows by brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
