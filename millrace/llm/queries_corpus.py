"""Queries over the corpus as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.common import table
from millrace.llm.registry import query
from millrace.llm.signature_trees import jaccard_groups
from millrace.llm.vector_sharding import shard_documents
from millrace.llm.wand_decontamination import find_contamination


@query("op4_vector_sharding")
def op4_vector_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op5_signature_trees")
def op5_signature_trees(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(table(spark, folder, "documents").select("doc_id", "text"), width=4, percent=85).select(
        "doc_id", "n_shingles", "component_id", "class_id")


@query("op6_wand_decontamination")
def op6_wand_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_contamination(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
