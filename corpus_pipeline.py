"""The corpus pipeline: each stage works on what the one before kept.

Toxic documents go, one document of each group of near copies stays, documents with
benchmark passages go, the sources are mixed by weight, and the mix is sharded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lagscope.llm.base import Spill, cut, table
from lagscope.llm.decontam import clean
from lagscope.llm.mixing import mixture
from lagscope.llm.ngram_join import one_of_each_group
from lagscope.llm.sharding import sharded
from lagscope.llm.toxicity import reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharded(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near copies", near_copies),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The first stage learns from labels, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; the tables between stages are removed."""
    docs = table(spark, sf_dir, "documents")
    with Spill(spark, "pipeline") as spill:
        for at, (_, stage) in enumerate(STAGES[:-1]):
            docs = spill.write(stage(spark, docs, sf_dir), f"stage{at}")
        return cut(STAGES[-1][1](spark, docs, sf_dir))
