"""High-water-mark filters: let a record pass only when it is newer than everything before it.

Two marks exist, on an id and on an event time. The id mark moves with every record whose id is new;
the time mark moves with the records that passed the id test. Missing ids, and times that cannot be
read, pass and leave the mark alone. Marks are kept per key; without keys there is one global mark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from millrace.functions import event_epoch, number_text
from millrace.operators.running import Placed, earlier_max, place_rows
from millrace.sinks.staged import Folder

BATCH = "__batch"
# As many as Spark keeps batches to go back to.
MARKS_RETAINED = 100
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _comparable_id(df: DataFrame, id_column: str) -> Column:
    """The id as something whose order is that of the marks.

    Numbers, and texts that are numbers, compare as numbers. Other texts compare as text and come
    after the numbers.
    """
    c = F.col(id_column)
    if isinstance(df.schema[id_column].dataType, T.NumericType):
        return c
    number = number_text(c)
    return F.when(c.isNotNull(), F.struct(
        number.isNull().alias("is_text"), number.alias("number"),
        F.when(number.isNull(), c.cast("string")).alias("text"),
    ))


def _passes(placed: Placed, value: Column, mark: Column | None = None) -> Placed:
    """Rows whose value is null or greater than the mark left by the rows before them, and than ``mark``."""
    marked = earlier_max(placed.but(placed.df.withColumn("__v", value)), F.col("__v"), "__before").df
    before = F.col("__before") if mark is None else F.greatest("__before", mark)
    kept = marked.filter(F.col("__v").isNull() | before.isNull() | (F.col("__v") > before))
    return placed.but(kept.drop("__v", "__before"))


def high_water_filter(
    df: DataFrame,
    *,
    order: Sequence[str],
    keys: Sequence[str] = (),
    id_column: str | None = None,
    time_column: str | None = None,
    slices: int | None = None,
    id_mark: Column | None = None,
    time_mark: Column | None = None,
) -> DataFrame:
    """Filter a table in arrival order.

    ``order`` is the arrival order, unique within a key; keys and order together cut the table into slices that are
    worked on in parallel. ``id_mark`` and ``time_mark`` are marks that rows before this table left, as constants.
    """
    columns = df.columns
    placed = place_rows(df, keys, order, slices)
    if id_column:
        placed = _passes(placed, _comparable_id(df, id_column), id_mark)
    if time_column:
        placed = _passes(placed, _event_time(df, time_column), time_mark)
    return placed.df.select(*columns)


def _event_time(df: DataFrame, time_column: str) -> Column:
    return event_epoch(F.col(time_column), df.schema[time_column].dataType)


class _MarkKeeper(StatefulProcessor):
    """Marks of one key in Spark's keyed state; lets the rows of a batch pass in arrival order."""

    def __init__(self, mark_schema: T.StructType, columns: Sequence[str], order: Sequence[str]) -> None:
        self.mark_schema, self.columns, self.order = mark_schema, list(columns), list(order)
        self.parts = mark_schema.names[:-1]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.marks = handle.getValueState("marks", self.mark_schema)

    def handleInputRows(self, key: object, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        held = self.marks.get() if self.marks.exists() else None
        # The state is flat: the parts of the id, all null before the first one, and the time.
        seen_id, seen_at = (tuple(held[:-1]), held[-1]) if held else (None, None)
        if seen_id is not None and all(v is None for v in seen_id):
            seen_id = None
        moved, made = None, Row(*self.columns)
        for row in sorted(rows, key=lambda r: [_ordered(r[c]) for c in self.order]):
            own, at = tuple(row[p] for p in self.parts), row["__at"]
            if own[0] is not None:
                if seen_id is not None and _ordered(own) <= _ordered(seen_id):
                    continue
                seen_id, moved = own, True
            if at is not None:
                if seen_at is not None and at <= seen_at:
                    continue
                seen_at, moved = at, True
            yield made(*[row[c] for c in self.columns])
        if moved:
            self.marks.update((*(seen_id or [None] * len(self.parts)), seen_at))

    def close(self) -> None:
        pass


def _ordered(value: object) -> tuple:
    """A value that compares like Spark's: nulls first, several values one after the other."""
    if isinstance(value, tuple):
        return tuple(_ordered(v) for v in value)
    return (0,) if value is None else (1, value)


def _constant(value: object, data_type: T.DataType) -> Column:
    """A value read from a table as a constant of its type."""
    if value is None or not isinstance(data_type, T.StructType):
        return F.lit(value).cast(data_type)
    return F.struct(*[_constant(value[f.name], f.dataType).alias(f.name) for f in data_type])


def _without_keys(
    stream: DataFrame, order: Sequence[str], sink: str, checkpoint: str, id_column: str | None, time_column: str | None, trigger: dict,
) -> StreamingQuery:
    """Each batch is a table, filtered in slices from the one pair of marks that the batch before it left.

    The marks of a batch are a row beside Spark's own checkpoint, written when its rows stand in the sink. So a batch with
    marks is done, and one without them replaces whatever it had written.
    """
    spark, schema = stream.sparkSession, stream.schema
    id_value = _comparable_id(stream, id_column) if id_column else F.lit(None).cast("bigint")
    at = _event_time(stream, time_column) if time_column else F.lit(None).cast("double")
    mark_schema = stream.select(id_value.alias("id"), at.alias("at")).schema
    target, marks = Folder(spark, sink), Folder(spark, f"{checkpoint.rstrip('/')}/marks")
    if target.fs.exists(target.below("_spark_metadata")):
        raise ValueError(f"{sink} has a log of Spark's file sink; readers would not see the batches written beside it")

    def take(batch: DataFrame, number: int) -> None:
        own = f"{marks.path}/{number}"
        if marks.fs.exists(marks.below(f"{number}/_SUCCESS")):
            return
        session = batch.sparkSession
        # Batches count from 0 without gaps; a later one whose marks are lost must not begin anew.
        held = session.read.schema(mark_schema).parquet(f"{marks.path}/{number - 1}").first() if number else (None, None)
        id_mark, time_mark = (_constant(v, f.dataType) for v, f in zip(held, mark_schema))
        kept = high_water_filter(batch, order=order, id_column=id_column, time_column=time_column, id_mark=id_mark, time_mark=time_mark)
        rows = f"{target.path}/{BATCH}={number}"
        kept.write.mode("overwrite").parquet(rows)
        # Every id moves its mark, but only times of rows that passed do.
        ids, times = batch.agg(F.max(id_value).alias("id")), session.read.schema(schema).parquet(rows).agg(F.max(at).alias("at"))
        moved = ids.crossJoin(times).select(F.greatest("id", id_mark).alias("id"), F.greatest("at", time_mark).alias("at"))
        moved.coalesce(1).write.mode("overwrite").parquet(own)
        marks.remove(str(number - MARKS_RETAINED))

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def high_water_stream(
    stream: DataFrame,
    *,
    order: Sequence[str],
    sink: str,
    checkpoint: str,
    keys: Sequence[str] = (),
    id_column: str | None = None,
    time_column: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run the same filter over a stream and append what passes to ``sink``.

    Without keys a batch is filtered in slices, as a table is, and stands in a folder ``__batch=<number>`` of the sink. Its marks
    are one row in the checkpoint.

    With keys the marks of a key are a value in Spark's keyed state, in the RocksDB store: a batch reads and writes the marks of
    the keys that it holds and no others, and a restart finds them in the checkpoint. Rows of one key pass in arrival
    order, so a batch sorts the rows of a key in one task. Those rows are bounded by what a batch admits
    (``maxFilesPerTrigger`` or the like on the source).

    ``sink`` and ``checkpoint`` are folders all executors share; replayed batches count once.
    """
    trigger = trigger or {"availableNow": True}
    if not keys:
        return _without_keys(stream, order, sink, checkpoint, id_column, time_column, trigger)
    columns = stream.columns
    id_value = _comparable_id(stream, id_column) if id_column else F.lit(None).cast("bigint")
    at = _event_time(stream, time_column) if time_column else F.lit(None).cast("double")
    valued = stream.withColumns({"__id": id_value, "__at": at})
    # Keyed state and its rows hold plain values, so a structured id is taken apart.
    id_type = valued.schema["__id"].dataType
    own = {f"__id_{f.name}": F.col(f"__id.{f.name}") for f in id_type} if isinstance(id_type, T.StructType) else {"__id_value": F.col("__id")}
    valued = valued.withColumns(own).drop("__id")
    mark = T.StructType([valued.schema[n] for n in (*own, "__at")])
    kept = valued.groupBy(*keys).transformWithState(
        statefulProcessor=_MarkKeeper(mark, columns, order), outputStructType=stream.schema, outputMode="Append", timeMode="None")
    spark = stream.sparkSession
    before = spark.conf.get(STATE_STORE, None)
    # A query keeps the settings that it starts with.
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        writer = kept.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger).start(sink)
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)
