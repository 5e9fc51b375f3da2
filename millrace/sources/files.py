"""Readers for landed files and in-memory rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.functions import whole_json
from millrace.operators.once import with_once
from millrace.sources.payloads import BATCH_ENVELOPE_KEYS, unwrap_envelope
from millrace.sources.pieces import array_parts

SUFFIX_FORMATS = {
    ".csv": "csv", ".json": "json", ".jsonl": "jsonl", ".ndjson": "jsonl", ".parquet": "parquet",
    ".pq": "parquet",
}
FORMAT_NAMES = {"csv": "csv", "json": "json", "jsonl": "jsonl", "ndjson": "jsonl", "parquet": "parquet",
                "pq": "parquet", "iceberg": "iceberg"}


def format_of(path: str) -> str:
    """Format by file suffix; Parquet when the suffix says nothing."""
    lower = path.lower()
    return next((f for suffix, f in SUFFIX_FORMATS.items() if lower.endswith(suffix)), "parquet")


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    *,
    schema: T.StructType | str | None = None,
    header: bool = True,
) -> DataFrame:
    """Read one dataset.

    CSV columns are text unless a schema is given, so no file is read twice. ``json`` and ``jsonl``
    both mean one JSON object per line; for whole-file documents see :func:`read_json_document`.
    """
    name = FORMAT_NAMES.get((fmt or format_of(path)).lower())
    if name is None:
        raise ValueError(f"unsupported format {fmt!r}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if name == "csv":
        return reader.option("header", header).csv(path)
    if name in ("json", "jsonl"):
        return reader.json(path)
    if name == "iceberg":
        return spark.read.format("iceberg").load(path)
    return reader.parquet(path)


def read_json_document(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType | str | None = None,
    keys: Sequence[str] = BATCH_ENVELOPE_KEYS,
) -> DataFrame:
    """Read files that are one JSON document each: an array of records or an enveloped object.

    With a schema the JSON reader streams the elements of a top-level array. Without one each
    document is parsed as a variant and unwrapped; the result has one variant column ``record``. A file
    that is no such document fails the read; :func:`json_documents` keeps it and says why.
    """
    if schema is not None:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    documents = json_documents(spark, path)
    strict = F.when(F.col("problem").isNull(), F.col("body")).otherwise(
        F.raise_error(F.concat_ws(": ", "path", "problem")).cast("variant"))
    return unwrap_envelope(documents.select(strict.alias("body")), "body", keys=keys)


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """Objects of files that are top-level JSON arrays of any size, element by element: ``path, record, corrupt``.

    Several tasks read a file, and only an element has to fit into a row. What is not part of an array stands as text in
    ``corrupt``, beside the path of its file; records before and after it are still told.
    """
    parts = array_parts(spark, path)
    parsed = with_once(parts, "elements", F.try_variant_get(whole_json("body"), "$", "array<variant>"))
    wrong = F.when(F.col("elements").isNull(), F.coalesce("problem", "body"))
    # One row without a record for a part that is none.
    listed = F.when(F.col("elements").isNull(), F.array(F.lit(None).cast("variant"))).otherwise(
        F.filter("elements", lambda v: F.schema_of_variant(v).startswith("OBJECT")))
    return parsed.select(F.col("file").alias("path"), F.explode(listed).alias("record"), wrong.alias("corrupt"))


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``path``, its document as a variant ``body``, and the ``problem`` of a file that has none."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    parsed = with_once(texts, "body", whole_json("value"))
    kind = F.schema_of_variant("body")
    return parsed.select("path", "body", F.when(F.col("body").isNull(), "not one JSON document").when(
        ~kind.rlike("^(OBJECT|ARRAY)"), "neither an array nor an object").alias("problem"))


def rows_to_table(spark: SparkSession, rows: Iterable[Mapping[str, Any]], schema: T.StructType | str) -> DataFrame:
    """In-memory rows as a table; an empty list gives an empty table, a missing key gives null."""
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return spark.createDataFrame([tuple(r.get(n) for n in struct.names) for r in rows], struct)


def merge_datasets(datasets: Sequence[DataFrame]) -> DataFrame:
    """Concatenate datasets; columns are united by name and missing ones are null."""
    if not datasets:
        raise ValueError("merge needs at least one dataset")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), datasets)


def read_datasets(spark: SparkSession, base: str, datasets: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Read and merge configured datasets ``{"path": .., "format": ..}`` below a base path."""
    return merge_datasets([
        read_table(spark, f"{base.rstrip('/')}/{str(d['path']).strip('/')}", d.get("format"))
        for d in datasets
    ])
