"""Training-data pipeline over documents: toxicity, near-duplicates, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and returns a frame;
all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierline.llm.common import staged, table
from tierline.llm.decontaminate import drop_contaminated
from tierline.llm.minhash import drop_near_duplicates
from tierline.llm.mixing import mix_documents
from tierline.llm.sharding import SHARDS, shuffle_into_shards
from tierline.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group linked by 80 % of their 5-word shingles."""
    return drop_near_duplicates(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    items = table(spark, sf_dir, "benchmark").selectExpr("item_id AS id", "text")
    return drop_contaminated(docs, items)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: never, once or twice."""
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents with ``shard`` and ``slot``."""
    return shuffle_into_shards(docs, SHARDS)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Learned scores and hashed draws have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
