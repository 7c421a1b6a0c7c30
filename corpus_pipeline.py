"""Corpus pipeline: STAGES over ``documents``, each stage one operator.

Every stage but the last returns the columns of its input, in order; a column that
is named like one of the operator's outputs holds that output instead.  Columns
that a stage does not read pass through, whatever their names and values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prismarq.llm import decontaminate, mixing, near_dedup, quality_rules, sharding
from prismarq.llm.common import write_table

ORACLE_SQL = None  # the shuffle's hypergeometric draws are outside SQL; tests hold each stage against brute force


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither their own rules nor their host's reject.

    Null, empty and short texts go; a null source is a host; equal rows stay or go together; an
    empty table stays empty.
    """
    return quality_rules.apply_rules(docs).where("kept").select(*docs.columns)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each near-duplicate component (5-word shingles, similarity 0.8).

    Rows without doc_id or words stay; rows that share doc_id and text are one document and stay
    or go together; an empty table stays empty.
    """
    return near_dedup.drop_near_duplicates(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark contaminates.

    Null and empty texts are clean; documents below the threshold stay whole; equal rows stay or
    go together; an empty table, of documents or items, changes nothing.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it: repeated rows are its copies.

    Texts without words come as often as their source's certain copies; a null source is a source;
    rows that are equal are drawn one by one; an empty table stays empty.
    """
    return mixing.repeat_rows(mixing.mix_sources(docs), docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with law, shard and slot; columns of these names are replaced.

    Nulls are values like others; equal rows get slots of their own; an empty table stays empty.
    """
    return sharding.shuffle_into_shards(docs)


STAGES = [("quality_rules", rules), ("near_dedup", dedup), ("decontamination", clean), ("mixing", mix), ("sharding", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: documents with law, shard and slot."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
