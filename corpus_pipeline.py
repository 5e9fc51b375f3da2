"""From raw documents to packed token windows in five stages.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and read again as the
``docs`` of the next. All but the last return the columns of ``documents``. Extra columns pass through. Null and
empty texts have too few words and end at the first stage; an empty table passes all stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.llm.common import free_name, keep, may_be_among, table
from millrace.llm.line_quality import clean_lines
from millrace.llm.pii_transduce import mask_personal_data
from millrace.llm.signature_trees import jaccard_groups
from millrace.llm.squares_packing import pack_squares
from millrace.llm.wand_decontamination import match_items
from millrace.operators.once import with_once
from millrace.session import tune


def _with_text(docs: DataFrame, columns: list[str], text: Column) -> list[Column]:
    """The columns with another text, and its length where the text changed."""
    changed = ~text.eqNullSafe(F.col("text"))
    replaced = {"text": text.alias("text"), "n_chars": F.when(changed, F.length(text)).otherwise(F.col("n_chars")).cast(
        docs.schema["n_chars"].dataType).alias("n_chars") if "n_chars" in docs.columns else None}
    return [replaced.get(c) if replaced.get(c) is not None else F.col(f"`{c}`") for c in columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that fail, or lose too much by it, go."""
    verdict = clean_lines(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("q_text")), "q_text")
    once = with_once(verdict.select("row", F.struct("kept", "cleaned_text").alias("v")), "verdict", F.col("v")).filter("verdict.kept")
    flat = once.select("row.*", F.col("verdict.cleaned_text").alias("_cleaned"))
    return flat.select(*_with_text(docs, docs.columns, F.when(F.col("text").isNotNull(), F.col("_cleaned"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the one with the smallest id, then the smallest hash of its text.

    Rows are told apart by id and text, so different texts that share an id are documents of their own. Rows without
    id have no group and stay. Texts are shuffled only of rows that may have to go.
    """
    row, copy = free_name(docs, "_row", "_copy")
    told = docs.withColumn(row, F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64("text").alias("text_hash"))))
    groups = keep(jaccard_groups(told.select(row, "text"), width=5, percent=80, key=row).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("component_id").alias("component_id")), "groups")
    unsure = may_be_among(groups.filter("rows > 1 OR doc_id <> component_id"), "doc_id")(F.col(row))
    first = groups.filter("doc_id = component_id").select(F.col("doc_id").alias(row))
    stay = told.filter(F.col(row).isNotNull() & unsure).join(first, row, "left_semi")
    others = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]))
    # Of equal rows each task passes one on.
    one = stay.withColumn(copy, F.row_number().over(Window.partitionBy(row).orderBy(others))).filter(F.col(copy) == 1)
    sure = told.filter(F.col(row).isNull() | ~unsure)
    return one.unionByName(sure, allowMissingColumns=True).select(*[F.col(f"`{c}`") for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a verified test item go."""
    matched = match_items(docs, table(spark, sf_dir, "benchmark"))
    return matched.filter(F.size("benchmark_items") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, disguised or not, gives way to its kind in brackets."""
    masked = docs.withColumn("_masked", mask_personal_data(F.col("text")))
    return masked.select(*_with_text(docs, docs.columns, F.col("_masked")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 1,024 token ids."""
    return pack_squares(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Tokenizing cannot be said in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
