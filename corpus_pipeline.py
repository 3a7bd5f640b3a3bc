"""From raw documents to a sharded training mix.

Each stage takes the documents the one before it kept and is stored before the next begins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierforge.llm import decontamination, jaccard, mixing, quality_model, sharding
from tierforge.llm.queries import quality_machine, table
from tierforge.scratch import stage

SHARDS = 16


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts; it learns from three of four labels."""
    return quality_model.accepted(docs, quality_machine(docs, table(spark, sf_dir, "labels")))


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are 0.8 alike, or more."""
    return jaccard.one_of_each(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or thinned so that sources meet their target weights."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every record with the shard that owns its virtual slot; shards hold nearly equal bytes."""
    return sharding.assign(docs, sharding.even_map(docs, SHARDS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("accept_quality", accept_quality),
    ("one_of_similar", one_of_similar),
    ("drop_contaminated", drop_contaminated),
    ("mix_to_weights", mix_to_weights),
    ("shard", shard),
]

# The classifier is trained, which SQL cannot express; tests compare the stages by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *before, (_, last) = STAGES
    for name, step in before:
        docs = stage(step(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
