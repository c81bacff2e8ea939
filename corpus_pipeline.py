"""Corpus pipeline: five stages from raw documents to sharded training data.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns of the documents they get.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from inkspring.llm import decontaminate, jaccard, mixing, quality, sharding
from inkspring.llm.common import forget, stored, table


#: Rows of an Arrow batch, at most. Rows are whole texts here, and an executor's JVM and its Python workers each hold
#: some batches at a time. It is a setting of the session, since a stage's result is only run when it is written.
BATCH_ROWS = 2_000
_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``stage`` with Arrow batches of BATCH_ROWS rows; a smaller setting of the session stays."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not 0 < int(spark.conf.get(_BATCHES)) <= BATCH_ROWS:
            spark.conf.set(_BATCHES, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


@in_small_batches
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest doc_id."""
    return jaccard.keep_one(docs)


@in_small_batches
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages: spans are cut, documents mostly made of them go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: one row per document and pass of the mix that uses it."""
    return mixing.mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place there."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The stages are not expressible in SQL; tests/llm/test_pipeline.py holds them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        # what the last stage read is written anew by now
        forget(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
