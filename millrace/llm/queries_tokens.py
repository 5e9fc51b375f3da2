"""Queries that write token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.best_fit_packing import pack_best_fit
from millrace.llm.common import table
from millrace.llm.registry import query
from millrace.llm.squares_packing import pack_squares


@query("op9_squares_packing")
def op9_squares_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_squares(table(spark, folder, "documents").select("doc_id", "text"))


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_best_fit(table(spark, folder, "documents").select("doc_id", "text"))
