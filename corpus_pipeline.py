"""From raw documents to shards for training: five stages, each an operator of ``doseledger.llm``.

Each stage takes the rows that the one before kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from doseledger.llm import decontam, near_copies, quality_rules, shards, source_mix
from doseledger.session import write_scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash prints within three bits, or four fifths of five-word shingles shared."""
    return near_copies.keep_one_copy(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without much text of the benchmark."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return source_mix.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's shard and its place there."""
    return shards.shard_report(docs)


STAGES = [
    ("quality rules", quality),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
    ("sharding", shard),
]

ORACLE_SQL = None  # SimHash, min-hash bands, apportionment and differencing have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_scratch(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
