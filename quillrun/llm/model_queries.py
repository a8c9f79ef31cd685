"""Queries of the quality classifier and of packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from quillrun.llm.packing import pack_documents
from quillrun.llm.quality import fit_quality, score_quality
from quillrun.llm.registry import query, table


def pack(docs):
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"),
                          ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          pattern=public_tokenizers.PATTERN)


@query("op2_cost_balanced_packing")
def op2_cost_balanced_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))


def held_out(id_col: str = "doc_id"):
    """A third of the ids, which the classifier never learns from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def learnt_quality(spark, docs, sf_dir):
    return fit_quality(docs, table(spark, sf_dir, "labels").where(~held_out()))


@query("op6_nb_svm_quality")
def op6_nb_svm_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = learnt_quality(spark, docs, sf_dir)
    return (score_quality(docs, model).withColumn("held_out", held_out("id"))
            .select(F.col("id").alias("doc_id"), "held_out", "score", "predicted"))
