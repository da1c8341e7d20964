"""From raw documents to shards: five stages, each on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factloom.llm import decontaminate, mixing, neardup, quality, shards
from factloom.llm.common import table
from factloom.storage import materialize, release


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.3 or more)."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    release(spark)
    return quality.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return neardup.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    out = decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))
    release(spark)
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixture(docs)


def write_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of each document of the mix."""
    return shards.shard_membership(docs)


STAGES = [
    ("quality", accept_quality),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", write_shards),
]

#: The trained and hashed stages have no SQL form; tests/llm compares run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; every stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
