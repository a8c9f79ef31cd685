"""A corpus prepared for training in five stages; each works on all rows that the one before kept.

Reject low quality, keep one of each group of exact copies and one of each class of near copies, mix
sources to target weights, and pack what is left into sequences. Every stage but the last returns the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillrun.llm.exact_dedup import exact_dedup
from quillrun.llm.jaccard_join import one_row_per_class
from quillrun.llm.mixing_query import BUDGET, SEED, margins
from quillrun.llm.model_queries import learnt_quality, pack
from quillrun.llm.quality import keep_good
from quillrun.llm.raking import mix_sources
from quillrun.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels, doesn't reject."""
    return keep_good(docs, learnt_quality(spark, docs, sf_dir))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_row_per_class(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs, margins(), BUDGET, SEED)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact_copies),
          ("n-gram Jaccard join", near_copies), ("mixing", mixture), ("packing", packed)]

# stages 1, 3 and 5 cannot be said in SQL; tests compare each with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
