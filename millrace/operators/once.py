"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column that later expressions may use many times.

    A plain ``withColumn`` is an alias, and a filter on anything derived from it is pushed below it
    with the whole expression copied into every use. Parsing the same JSON text a dozen times per row
    is the usual result. Filters do not pass a generator, so a one-element ``explode`` keeps the
    expression where it is; columns and filters that do not depend on it are still pruned and pushed.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))
