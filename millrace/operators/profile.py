"""Table profiles, JSON schema inference and volume estimates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions import variant_kind, variant_lookup, whole_json
from millrace.operators.once import with_once

# Fixed value: records assumed per sampled record when a source states no total.
EXTRAPOLATION = 50


def _unfold(folded: DataFrame, columns: Sequence[str], fields: dict[str, dict[str, Column]]) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("column"), *[v.alias(k) for k, v in fields[c].items()]) for c in columns]
    return folded.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, columns and null count, from one pass."""
    columns = df.columns
    folded = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    # An empty table has no columns to speak of.
    return _unfold(folded.filter("n > 0"), columns, {
        c: {
            "row_count": F.col("n"),
            "column_count": F.lit(len(columns)).cast("bigint"),
            "null_count": F.col(f"n{i}"),
        }
        for i, c in enumerate(columns)
    })


# Base-2 logarithm of the registers of a sketch, and the error that three of its standard deviations make.
SKETCH_SIZE = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_SIZE / 2)


def _narrow(df: DataFrame, column: str) -> Column:
    """A value of at most eight bytes that tells the values of a column apart: itself if it is so small, else its 64-bit hash."""
    c = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c
    return F.when(c.isNotNull(), F.xxhash64(c))


def quality_profile(
    df: DataFrame, columns: Sequence[str] | None = None, *, approximate: bool = False
) -> DataFrame:
    """One row per column: row count, null count and distinct count.

    Distinct counts are those of the values, or of their 64-bit hashes where a value may be longer, so no text is
    shuffled. They cost one shuffle of the distinct values per column; ``approximate`` uses sketches and needs none.
    """
    columns = list(columns or df.columns)
    if approximate:
        return merged_profile(profile_sketches(df, columns), columns)
    narrow = df.select(*[_narrow(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    measures = [F.count(F.lit(1)).alias("n")]
    for i in range(len(columns)):
        measures += [F.count_if(F.col(f"c{i}").isNull()).alias(f"n{i}"), F.count_distinct(f"c{i}").alias(f"d{i}")]
    return _profile_rows(narrow.agg(*measures), columns)


def _profile_rows(folded: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _unfold(folded, columns, {
        c: {"row_count": F.col("n"), "null_count": F.col(f"n{i}"), "unique_count": F.col(f"d{i}")}
        for i, c in enumerate(columns)
    })


def profile_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per part of a table, or for all of it: ``n``, null counts ``n0..`` and distinct sketches ``s0..``.

    Sketches of parts merge, so a table that grows by partitions keeps the sketches of old ones. They are folded in each
    task, and a part's row holds some kilobytes per column whatever its size.
    """
    measures = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        hashed = F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(F.col(f"`{c}`")))
        measures += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}"), F.hll_sketch_agg(hashed, SKETCH_SIZE).alias(f"s{i}")]
    return df.groupBy(*by).agg(*measures)


def merged_profile(parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The profile of all parts together; distinct counts are estimates within :data:`SKETCH_ERROR` in 997 cases of 1,000."""
    measures = [F.coalesce(F.sum("n"), F.lit(0)).alias("n")]
    for i in range(len(columns)):
        measures += [F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}"),
                     F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"s{i}")), F.lit(0)).alias(f"d{i}")]
    return _profile_rows(parts.agg(*measures), columns)


def infer_json_schema(df: DataFrame, json_column: str) -> DataFrame:
    """One row per top-level key of JSON objects: sorted type names, and whether null occurs.

    The kinds of a key are folded to at most seven names inside each task, so a key that every
    record carries is no burden. Text that is not a JSON object is passed over.
    """
    body = F.try_variant_get(whole_json(json_column), "$", "map<string,variant>")
    items = with_once(df.select(F.explode(body).alias("key", "item")), "shape", F.schema_of_variant("item"))
    kinds = items.select("key", variant_kind(F.col("item"), F.col("shape")).alias("kind"))
    return kinds.groupBy("key").agg(
        F.array_sort(F.collect_set("kind")).alias("types"),
        F.bool_or(F.col("kind") == "null").alias("nullable"),
    )


def merged_schema(df: DataFrame, json_column: str) -> DataFrame:
    """One row: the schema that holds every JSON text of the column.

    Keys are united, conflicting types widen, and what cannot be reconciled becomes VARIANT.
    """
    return df.agg(F.schema_of_variant_agg(whole_json(json_column)).alias("schema"))


def create_table_ddl(df: DataFrame, json_column: str) -> str:
    """The merged schema as a Spark struct type, for ``spark.read.schema`` or CREATE TABLE."""
    return merged_schema(df, json_column).first()["schema"].replace("OBJECT<", "STRUCT<")


def estimate_volume(
    bodies: DataFrame,
    source: str,
    body: str,
    *,
    total_field: str,
    sample_size: Column,
    stated_total: Column | None = None,
) -> DataFrame:
    """One row per source: total stated by metadata, else by a body, else extrapolated from samples.

    ``body`` is a variant column of landed response bodies. The body total may be an integer or a
    text of digits.
    """
    bodies = with_once(bodies, "__raw", variant_lookup(F.col(body), total_field, "variant"))
    raw = F.col("__raw")
    bodies = with_once(bodies, "__shape", F.schema_of_variant(raw))
    kind = variant_kind(raw, F.col("__shape"))
    text = raw.try_cast("string")
    in_body = F.when(
        (kind == "integer") | ((kind == "string") & text.rlike("^[0-9]+$")), text.try_cast("bigint")
    )
    stated = stated_total if stated_total is not None else F.lit(None)
    folded = bodies.select(
        F.col(source),
        stated.cast("bigint").alias("__stated"),
        F.when(raw.isNotNull(), in_body).alias("__in_body"),
        sample_size.cast("bigint").alias("__sample"),
    ).groupBy(source).agg(
        F.max("__stated").alias("__stated"),
        F.max("__in_body").alias("__in_body"),
        F.sum("__sample").alias("__sample"),
    )
    return folded.select(
        source,
        F.coalesce("__stated", "__in_body", F.col("__sample") * EXTRAPOLATION, F.lit(0)).alias("estimate"),
    )
