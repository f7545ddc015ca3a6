"""The corpus pipeline: quality, near copies, benchmark leaks, source weights, shards.

Every stage takes the documents that the one before kept and gives documents of the same
columns; the last adds each document's shard. Stages are joined by Parquet tables, so each
can be run again alone. Every stage keeps null and empty texts out of harm's way as its
operator's docstring says, and passes through further columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchlens.llm import cotrain, decontaminate, mixing, shards, similar
from watchlens.llm.text import documents
from watchlens.session import materialize

SHARDS = 24
#: Near copies: words of a shingle, and the similarity from which texts are copies.
SHINGLE_WORDS, LEAST_SIMILARITY = 5, 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return cotrain.good_documents(docs, cotrain.learn(docs, labels))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return similar.one_of_each(docs, SHINGLE_WORDS, LEAST_SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' target weights take them."""
    return mixing.mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard of their id."""
    return docs.withColumn("shard", shards.rendezvous([F.col("doc_id")], shards.equal_weights(SHARDS)).cast("int"))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixing_sources),
    ("sharding", sharding),
]
#: Models and searches along the way have no form in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
