"""What the operators of this package share: whole-text columns, words, and tables kept between jobs."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import scratch_dir

FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# The six ASCII white-space characters that part words.
WHITE = " \t\n\x0b\x0c\r"


def whole(text: Column | str) -> Column:
    """The text as it is; null becomes empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit(""))


def parts(text: Column) -> Column:
    """Words between ASCII white space."""
    # Translation looks up every character; most texts have only blanks and line ends.
    plain = F.when(text.rlike(r"[\t\x0B\f\r]"), F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text)
    return F.array_remove(F.split(F.replace(plain, F.lit("\n"), F.lit(" ")), " "), "")


def count_of(text: Column, characters: str) -> Column:
    """How many of the given characters the text holds."""
    some = "[" + "".join(f"\\x{ord(c):02x}" for c in characters) + "]"
    return F.when(text.rlike(some), F.length(text) - F.length(F.translate(text, characters, ""))).otherwise(0)


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write a table into the folder that all executors share and read it back.

    Later jobs then start from files instead of a lineage that a lost executor would replay.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")  # the shuffles of this write serve no other job
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(FILE_CLEANUP) if before is None else spark.conf.set(FILE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


MOST_BITS = 1 << 26


def may_be_among(keys: DataFrame, column: str) -> Callable[[Column], Column]:
    """A test that holds for every key of the table, and for few others as long as it has under ten million keys.

    One bit for each hash, 8 MB at most, goes with the tasks: rows that cannot have a partner need not be shuffled.
    """
    bits = min(MOST_BITS, max(1 << 15, 1 << (16 * keys.count()).bit_length()))
    at = F.xxhash64(column).bitwiseAND(F.lit(bits - 1))
    slices = keys.select(F.shiftright(at, 15).alias("slice"), at.bitwiseAND(F.lit((1 << 15) - 1)).alias("at")).repartition(
        "slice").groupBy("slice").agg(F.bitmap_construct_agg("at").alias("bits")).collect()
    found = np.zeros((bits >> 15, 1 << 12), np.uint8)
    for r in slices:
        found[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    found = found.ravel()

    @F.pandas_udf("boolean")
    def held(hashed: pd.Series) -> pd.Series:
        bit = hashed.to_numpy() & (bits - 1)
        return pd.Series((found[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1)

    return lambda key: held(F.xxhash64(key))


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that the table does not use yet, whatever its own columns are called."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


CHUNK, LEVELS = 64, 3


def _chunks(items: Column) -> Column:
    """The array cut into arrays of ``CHUNK`` elements."""
    return let(items, lambda a: F.transform(
        F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1, F.lit(CHUNK))).otherwise(F.array().cast("array<int>")),
        lambda i: F.slice(a, i + 1, F.lit(CHUNK))))


def scan(items: Column, begin: dict[str, Column], step: Callable[[Column, Column], tuple[list[Column], Column]], out: str) -> Column:
    """Walk an array from the left and collect what the steps give out, nulls left out.

    ``begin`` names the fields of the state; ``step(state, item)`` returns them, in this order, as they are after the
    item, and an ``out`` value or null. ``aggregate`` copies its whole state at every step, results so far included, so the
    walk goes over chunks of chunks, each of which starts with no results: copies grow with the length, not its square.
    """
    none = F.array().cast(f"array<{out}>")

    def one(acc: Column, x: Column) -> Column:
        state, given = step(acc, x)
        return F.struct(*state, let(given, lambda g: F.when(g.isNull(), acc["done"]).otherwise(F.array_append(acc["done"], g))).alias("done"))

    def over(level: int) -> Callable[[Column, Column], Column]:
        if level == 0:
            return one
        return lambda acc, part: let(
            F.aggregate(part, F.struct(*[acc[n].alias(n) for n in begin], none.alias("done")), over(level - 1)),
            lambda r: F.struct(*[r[n].alias(n) for n in begin], F.concat(acc["done"], r["done"]).alias("done")))

    nested = items
    for _ in range(LEVELS - 1):
        nested = _chunks(nested)
    start = F.struct(*[value.alias(n) for n, value in begin.items()], none.alias("done"))
    return F.aggregate(nested, start, over(LEVELS - 1), lambda acc: acc["done"])


SPAN = "struct<start:int,end:int,value:string>"


def spans_of(text: Column, pattern: str | Column, group: int = 0, size=F.length) -> Column:
    """Leftmost non-overlapping matches in code points: array of (start, end, value of the group).

    Spark has no function for match positions; the pieces between matches and the matches themselves add
    up to the text, so their running lengths are the positions. ``size`` may measure in another unit.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern

    def steps(matches: Column) -> Column:
        values = matches if group == 0 else F.regexp_extract_all(text, pattern, F.lit(group))
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
        return F.zip_with(
            between, F.arrays_zip(matches.alias("m"), values.alias("v")),
            lambda gap, x: F.struct(size(gap).alias("gap"), size(x["m"]).alias("size"), x["v"].alias("value")))

    def step(acc: Column, x: Column) -> tuple[list[Column], Column]:
        start = acc["at"] + x["gap"]
        return [(start + x["size"]).alias("at")], F.struct(start.alias("start"), (start + x["size"]).alias("end"), x["value"].alias("value"))

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda matches: F.when(F.size(matches) > 0, scan(
        steps(matches), {"at": F.lit(0)}, step, SPAN)).otherwise(F.array().cast(f"array<{SPAN}>")))
