"""Records of text files that may lie across the places where Spark cuts a file.

Spark's text reader cuts a file into byte ranges (blocks) and hands out whole pieces between separators, whatever the
size of the blocks is. A record is a run of pieces. Inside a block a window numbers the records; the counts of
the blocks are scanned per file, a row per block; and only the first and last run of each block, which may
belong together, are joined once more. So a block is the most that one task holds, and no file has to fit anywhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.session import scratch_dir

BLOCK = ("file", "start")


def read_pieces(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """Pieces of text files with their places: ``file, file_size, start, seq, piece``.

    ``start`` is where the block begins that the piece was read in, ``seq`` grows along it. Without a separator the pieces
    are lines, ended by any of the three usual line ends.
    """
    reader = spark.read.option("lineSep", separator) if separator else spark.read
    # A task reads its blocks one after the other, so its row numbers grow along each of them.
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("seq"), F.col("value").alias("piece"))


def _block_offsets(rows: DataFrame, **steps: Column) -> DataFrame:
    """By block, the sum of each step over all earlier blocks of the file: ``_file, _start, _o_<name>``."""
    sums = rows.groupBy(*BLOCK).agg(*[F.sum(step).alias(f"_n_{name}") for name, step in steps.items()])
    # One row per block of a file.
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(F.col("file").alias("_file"), F.col("start").alias("_start"), *[
        F.coalesce(F.sum(f"_n_{name}").over(before), F.lit(0)).alias(f"_o_{name}") for name in steps])


def _with_offsets(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    return rows.join(offsets, (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start")))


def _earlier_sum(step: Column) -> Column:
    """The sum of a step over the earlier pieces of the block."""
    earlier = Window.partitionBy(*BLOCK).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(step).over(earlier), F.lit(0))


def from_block_starts(pieces: DataFrame, **steps: Column) -> DataFrame:
    """Add, by name, the sum of each step over all earlier pieces of the file."""
    joined = _with_offsets(pieces, _block_offsets(pieces, **steps))
    return joined.withColumns({name: F.col(f"_o_{name}") + _earlier_sum(step) for name, step in steps.items()}).drop(
        "_file", "_start", *[f"_o_{name}" for name in steps])


def _written(df: DataFrame, label: str) -> DataFrame:
    """The table read back from the scratch folder, so that what made it runs once and not for every use."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gather(pieces: DataFrame, closes: Column, joiner: str, *, written: bool = False) -> DataFrame:
    """Records as ``file, record, value, closed``: pieces up to and with one that ``closes``, joined.

    ``record`` counts from 0 in each file. The last record of a file may be left open. With ``written`` the runs of
    all blocks are written down when this is called, and what made the pieces runs no second time.
    """
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "piece"))), lambda x: x["piece"]), joiner)
    numbered = pieces.withColumn("_closes", closes).withColumn("_run", _earlier_sum(F.col("_closes").cast("long")))
    runs = numbered.groupBy(*BLOCK, "_run").agg(text.alias("value"), F.bool_or("_closes").alias("closed"))
    if written:
        runs = _written(runs, "runs")
    offsets = _block_offsets(runs, record=F.col("closed").cast("long"))
    placed = _with_offsets(runs, offsets).withColumn("record", F.col("_o_record") + F.col("_run"))
    # Runs of one block have numbers of their own, but for the first and an open last one.
    edge = (F.col("_run") == 0) | ~F.col("closed")
    joined = placed.filter(edge).groupBy("file", "record").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "value"))), lambda x: x["value"]), joiner).alias("value"),
        F.bool_or("closed").alias("closed"))
    return placed.filter(~edge).select("file", "record", "value", "closed").unionByName(joined)


ESCAPE = r"(?s)\\."
IN_QUOTES = r'"[^"]*+(?:"|$)'
NOTHING = r"^[\x20\t\r\n]*$"


def array_parts(spark: SparkSession, path: str) -> DataFrame:
    """Top-level JSON arrays cut behind their objects: ``file, part, body, problem``.

    ``body`` is the JSON text of an array of the elements of a part: one object, and what stands before it that is no
    object. ``problem`` holds the raw text of a part that cannot be one. A part is all that has to fit into a row.

    A brace that ends an element is told from one inside it by the sums of quotes and brackets before it. Pieces with what
    is counted in them, and the runs they make up, are written down in jobs of their own, when this is called.
    """
    raw = read_pieces(spark, path, "}")
    bare = F.when(F.contains("piece", F.lit("\\")), F.regexp_replace("piece", ESCAPE, "")).otherwise(F.col("piece"))
    # Bytes without some signs; ``replace`` searches bytes, where ``translate`` looks up every character.
    without = lambda c, signs: F.octet_length(reduce(lambda x, sign: F.replace(x, F.lit(sign), F.lit("")), signs, c))
    # Opening brackets less closing ones.
    depth = lambda c: without(c, "]") - without(c, "{[")
    # All pieces but a last one without it have lost a brace; the bytes of the file tell.
    counted = raw.select(
        *BLOCK, "seq", "piece", "file_size", F.octet_length("piece").alias("bytes"),
        ((F.octet_length(bare) - without(bare, '"')) % 2).alias("quotes"),
        depth(bare).alias("all"), depth(F.regexp_replace(bare, IN_QUOTES, "")).alias("outside"))
    # A piece that begins inside quotes has outside what another has inside. Blocks are put together, for few files.
    told = _written(counted.repartition(*BLOCK), "pieces").withColumn("inside", F.col("all") - F.col("outside"))
    placed = from_block_starts(told, before=F.col("bytes") + 1, quotes_before=F.col("quotes"))
    braced = placed.withColumn("brace", F.col("before") + F.col("bytes") < F.col("file_size"))
    ends_outside = (F.col("quotes_before") + F.col("quotes")) % 2 == 0
    step = F.when(F.col("quotes_before") % 2 == 1, F.col("inside")).otherwise(F.col("outside")) - F.when(F.col("brace") & ends_outside, 1).otherwise(0)
    deep = from_block_starts(braced.withColumn("step", step), depth_before=F.col("step"))
    closes = F.col("brace") & ends_outside & (F.col("depth_before") + F.col("step") == 1)
    whole = F.when(F.col("brace"), F.concat("piece", F.lit("}"))).otherwise(F.col("piece"))
    parts = gather(deep.select(*BLOCK, "seq", whole.alias("piece"), closes.alias("closing")), F.col("closing"), "", written=True)
    first = F.col("record") == 0
    opening, comma, tail = F.lit(r"^[\x20\t\r\n]*\["), F.lit(r"^[\x20\t\r\n]*,"), r"\][\x20\t\r\n]*$"
    # Constant patterns, which are compiled once; others are for every row.
    opened = F.when(first, F.rlike("value", opening)).otherwise(F.rlike("value", comma))
    ended = F.rlike("value", F.lit(tail))
    inner = F.when(first, F.regexp_replace("value", opening, F.lit(""))).otherwise(F.regexp_replace("value", comma, F.lit("")))
    rest = F.regexp_replace(inner, tail, "")
    # The end may follow an element at once; a comma before it must be followed by something.
    bare_end = ~F.col("closed") & ~first & F.rlike("value", F.lit(r"^[\x20\t\r\n]*\][\x20\t\r\n]*$"))
    empty = ~F.col("closed") & first & opened & ended & F.rlike(rest, F.lit(NOTHING))
    body = F.when(F.col("closed") & opened, F.concat(F.lit("["), inner, F.lit("]"))).when(
        bare_end | empty, F.lit("[]")).when(~F.col("closed") & opened & ended & ~F.rlike(rest, F.lit(NOTHING)), F.concat(F.lit("["), rest, F.lit("]")))
    held = parts.select("file", F.col("record").alias("part"), "value", "closed", body.alias("body"))
    # A file whose last part is closed has no end.
    last = held.groupBy("file").agg(F.max(F.struct("part", "closed")).alias("last")).filter("last.closed").select(
        "file", (F.col("last.part") + 1).alias("part"), F.lit("").alias("value"), F.lit(None).cast("string").alias("body"))
    return held.select("file", "part", "value", "body").unionByName(last).select(
        "file", "part", "body", F.when(F.col("body").isNull(), F.col("value")).alias("problem"))
