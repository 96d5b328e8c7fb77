"""From raw documents to shards: toxic texts go, near copies go, benchmark leaks go, sources are mixed, shards dealt."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerwright.llm.decontaminate import decontaminate
from layerwright.llm.mixing import apply_mix
from layerwright.llm.near_dedup import drop_near_copies
from layerwright.llm.sharding import shard_documents
from layerwright.llm.toxicity import drop_toxic
from layerwright.session import stage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity 0.8 or more."""
    return drop_near_copies(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than 0.8 of the five-word shingles of every benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none to three times."""
    return apply_mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row."""
    return shard_documents(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot")


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# The classifier, the rounding and the packing have no SQL. Tests compare near-dedup with all pairs and hold the others to
# what they promise: columns, rows that stay, words per source, shard sizes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

