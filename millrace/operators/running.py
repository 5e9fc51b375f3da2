"""Running maximum over an ordered sequence, computed in parallel.

A window over one key (or over no key at all) puts the whole sequence of that key into one task. Here rows
are cut into slices by ranges of keys and all order columns together, so slices hold about equal numbers of rows
whatever the keys and ties are: each slice folds to one maximum per key, the folds of keys that lie in several slices
are scanned, and each slice then runs its own window from the maximum carried in. Slice and key together
form the *place* of a row, which decides its partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

FEWEST_SLICES = 16
# Rows looked at per slice to find the ranges; they are all that passes the driver.
SAMPLE_PER_SLICE = 60


def default_slices(df: DataFrame) -> int:
    """As many slices as the session has shuffle partitions, and a few at least."""
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(FEWEST_SLICES, wanted)


def slice_bounds(df: DataFrame, columns: Sequence[str], slices: int) -> list[Row]:
    """At most ``slices - 1`` rows of the named columns that cut the table into ranges of about equal row count.

    They come from a sample whose expected size is set by ``slices``, not by the data.
    """
    positions = df.select(*columns)
    wanted, total = slices * SAMPLE_PER_SLICE, df.count()
    sample = positions if total <= wanted else positions.sample(fraction=wanted / total, seed=1)
    # Spark sorts, so that the order is that of its structs: nulls first, fields from the left.
    rows = sample.select(F.struct(*columns).alias("at")).sort("at").collect()
    cuts = [rows[i * len(rows) // slices]["at"] for i in range(1, slices)] if rows else []
    return [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]]


def _literal(row: Row, schema: T.StructType) -> Column:
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in schema])


def slice_number(position: Column, bounds: Column, count: int) -> Column:
    """How many of ``count`` bounds lie at or below the position, by binary search."""
    if not count:
        return F.lit(0)
    widths = [1]
    while widths[0] * 2 <= count:
        widths.insert(0, widths[0] * 2)

    def advance(at: Column, width: Column) -> Column:
        return F.when((at + width <= count) & (F.get(bounds, at + width - 1) <= position), at + width).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, widths)), F.lit(0), advance)


@dataclass(frozen=True)
class Placed:
    """A table whose rows know their place; ``sliced`` tells whether there are several slices."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    sliced: bool

    def but(self, df: DataFrame) -> Placed:
        """The same places for a table derived from this one."""
        return replace(self, df=df)


def place_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None
) -> Placed:
    """Add ``__place``, made of key and slice number, and ``__shared`` for rows whose key may lie in several slices.

    ``order`` must be unique within a key. The place is a struct, so that a null key is a value like any
    other in joins and windows.
    """
    columns = [*keys, *[c for c in order if c not in keys]]
    bounds = slice_bounds(df, columns, slices or default_slices(df))
    if not bounds:
        df = df.withColumns({"__slice": F.lit(0), "__shared": F.lit(False)})
        return Placed(df.withColumn("__place", F.struct(*keys, "__slice")), tuple(keys), tuple(order), False)
    schema = df.select(*columns).schema
    cuts = F.array(*[_literal(b, schema) for b in bounds])
    df = df.withColumn("__slice", slice_number(F.struct(*columns), cuts, len(bounds)))
    # A key lies in several slices only if a bound is one of its rows: the last bound below this row, or the next one.
    shared = F.lit(True)
    for k in keys:
        shared = shared & F.get(cuts, F.col("__slice") - 1)[k].eqNullSafe(F.col(k))
    after = F.lit(True)
    for k in keys:
        after = after & F.get(cuts, F.col("__slice"))[k].eqNullSafe(F.col(k))
    below = (F.col("__slice") > 0) & shared
    above = (F.col("__slice") < len(bounds)) & after
    df = df.withColumn("__shared", below | above)
    return Placed(df.withColumn("__place", F.struct(*keys, "__slice")), tuple(keys), tuple(order), True)


def earlier_max(placed: Placed, value: Column, out: str) -> Placed:
    """Add ``out``: the greatest value among earlier rows of the same key, null when there is none.

    Rows move once, to their place; a second running maximum over the result finds them there.
    """
    valued = placed.df.withColumn("__value", value)
    within = Window.partitionBy("__place").orderBy(*placed.order).rowsBetween(Window.unboundedPreceding, -1)
    local = F.max("__value").over(within)
    if not placed.sliced:
        return placed.but(valued.withColumn(out, local).drop("__value"))
    per_slice = (
        valued.filter("__shared").groupBy(*placed.keys, "__slice", "__place").agg(F.max("__value").alias("__top"))
    )
    scan = Window.partitionBy(*placed.keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slice.select(F.col("__place").alias("__from"), F.max("__top").over(scan).alias("__carried"))
    # Each bound has one key, and a key is shared only by the slices beside its bounds: at most two rows per slice.
    joined = valued.join(F.broadcast(carried), F.col("__place") == F.col("__from"), "left")
    return placed.but(
        joined.withColumn(out, F.greatest(local, F.col("__carried"))).drop("__value", "__carried", "__from")
    )
