"""Queries that make and grade training examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.common import table
from millrace.llm.fill_middle import fill_in_middle, restore
from millrace.llm.registry import query
from millrace.llm.subword_classifier import classify, fit_classifier


@query("op13_fill_middle", r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
               regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units FROM documents),
    g AS (SELECT doc_id, t, units, len(units) AS n, [CAST('0x' || h[8 * i + 1:8 * i + 8] AS BIGINT) FOR i IN [0, 1, 2, 3]] AS r FROM d),
    c AS (
        SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
               CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 50 THEN 'plain'
                    WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM g),
    p AS (
        SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix, coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
               coalesce(array_to_string(units[b + 1:], ''), '') AS suffix FROM c)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form,
           CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p
""")
def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    cut = fill_in_middle(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", F.col("fim_units").alias("n"), F.col("fim_form").alias("form"), F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"), F.sha2("fim_text", 256).alias("output_sha256"),
        F.sha2(restore(F.col("fim_form"), F.col("fim_text")), 256).alias("restored_sha256"))


def held_out(key: str) -> Column:
    """A fifth of the keys, by checksum of their text; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


@query("op12_subword_classifier")
def op12_subword_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Training runs while the query is built; what it learns from is bounded (see ``fit_classifier``)."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality").filter(~held_out("doc_id"))
    scored = classify(docs, fit_classifier(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
