"""The corpus pipeline: named stages, each over all that its predecessor kept.

Every stage takes tables with nulls, repeats, ties, very long texts and further columns, whatever their
names, and empty ones; all but the last return the columns of the documents.  What each does with such
rows is stated with it; texts are read whole, and rows are never cut, sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontamination, mixing, ngram_join, sharding, toxicity
from tessera.llm.runtime import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half stay.  Null and empty texts score 0 and stay; a score of one half goes; repeated rows are judged alike."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies stays: that of the least id, of several texts under it one.

    Texts without a word are in no class and stay, one row an id; rows without an id stay.
    """
    return ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found stay.  Null and empty texts stay; rows of one id, or of none, are judged each by its own text; null and empty items are found nowhere."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's budget asks, at least once.  A null source is a source; one without words has each document once; repeated rows are rows of their own."""
    return mixing.temperature_mix(docs).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with size, shard and slot, in place of columns of these names.  Equal texts, empty and null ones too, share a shard."""
    return sharding.minimax_shards(docs)


STAGES = [("toxicity", drop_toxic), ("near duplicates", keep_one), ("decontamination", decontaminate), ("mixing", mix), ("sharding", shard)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
