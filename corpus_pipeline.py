"""The corpus pipeline: toxicity, near duplicates, benchmark leaks, source weights, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result to the shared folder and reads it
again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, jaccard, mixing, sharding, toxicity
from millrace.llm.common import table
from millrace.session import settle, ship

SHARDS = 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below a half, by a model of the labelled documents outside the held-out fifth."""
    ship(spark)
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    return docs.filter(toxicity.score(F.col("text"), toxicity.train(docs, labels)) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 on five-word shingles, the one with the smallest id."""
    ship(spark)
    return jaccard.keep_one(docs, width=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    ship(spark)
    return mixing.mix(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their size, checksum and shard, and the shard they would have with one more."""
    ship(spark)
    return sharding.assign(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_leaks),
    ("mixing", mix_sources), ("sharding", deal_shards),
]

#: The toxicity scores have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
