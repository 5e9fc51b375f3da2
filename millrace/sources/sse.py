"""Server-sent-event text to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions import strip_text, whole_json
from millrace.operators.once import with_once
from millrace.sources.pieces import gather, read_pieces

DONE = "[DONE]"
TO_END = 2**31 - 1


def read_sse(spark: SparkSession, path: str, *, stream: bool = False, newline: str | None = None) -> DataFrame:
    """Event blocks of landed text files, one per row.

    Blocks end at blank lines, whichever line ends a file uses or mixes, and may lie across the ranges that a file is
    cut into. Where all files are known to end their lines with ``newline``, blocks are split by the reader alone and
    nothing moves; so they are in a stream, whose line end is a line feed unless named.
    """
    if stream or newline:
        reader = spark.readStream if stream else spark.read
        blocks = reader.option("lineSep", (newline or "\n") * 2).text(path)
        return blocks.select(F.explode(F.split("value", r"\r?\n\r?\n")).alias("value"))
    lines = read_pieces(spark, path)
    # The blank line that closes a block is its last piece.
    blocks = gather(lines, F.col("piece") == "", "\n").select(F.rtrim(F.col("value"), F.lit("\n")).alias("value"))
    return blocks.filter("value <> ''")


def sse_fields(block: Column) -> tuple[Column, Column]:
    """Payload (``data:`` lines joined by newlines, null without any) and event id of a block."""
    lines = F.transform(F.split(block, "\n"), lambda line: F.rtrim(line, F.lit("\r")))
    data = F.filter(lines, lambda line: line.startswith("data:"))
    ids = F.filter(lines, lambda line: line.startswith("id:"))
    left_stripped = F.transform(data, lambda d: strip_text(F.substring(d, 6, TO_END), "left"))
    payload = F.when(F.size(data) > 0, F.array_join(left_stripped, "\n"))
    last_id = strip_text(F.substring(F.get(ids, F.size(ids) - 1), 4, TO_END))
    return payload, F.nullif(last_id, F.lit(""))


def parse_sse(df: DataFrame, block: str = "value") -> DataFrame:
    """Replace the block column by ``record`` (variant object), ``value``, ``raw`` and ``_sse_id``.

    Exactly one of the three is set: an object payload is a record, any other JSON is a value, text
    that is not JSON is raw. Blocks without data and ``[DONE]`` are dropped. An ``_sse_id`` inside
    the object takes precedence over the id line.
    """
    rest = [c for c in df.columns if c != block]
    payload, event_id = sse_fields(F.col(block))
    fields = F.struct(payload.alias("payload"), event_id.alias("id"))
    parts = with_once(df, "__f", fields).select(*rest, F.col("__f.payload").alias("__payload"), F.col("__f.id").alias("__id"))
    parsed = with_once(parts.filter(F.col("__payload") != DONE), "__json", whole_json("__payload"))
    parsed = with_once(parsed, "__is_object", F.schema_of_variant("__json").startswith("OBJECT"))
    is_object = F.col("__is_object")
    own_id = F.when(is_object, F.try_variant_get(F.col("__json"), "$._sse_id", "string"))
    return parsed.select(
        *rest,
        F.when(is_object, F.col("__json")).alias("record"),
        F.when(~is_object, F.col("__json")).alias("value"),
        F.when(F.col("__json").isNull(), F.col("__payload")).alias("raw"),
        F.coalesce(own_id, F.col("__id")).alias("_sse_id"),
    )
