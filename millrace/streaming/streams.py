"""Stream sources over landed files and Kafka topics, and a sink that lands each micro-batch."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import whole_json
from millrace.operators.once import with_once
from millrace.sources.payloads import normalize_observation


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "json",
    *,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Files that keep landing in a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(fmt).load(path)


def read_kafka(
    spark: SparkSession, servers: str, topic: str, group: str = "millrace", **options: str
) -> DataFrame:
    """Message texts of a topic from the earliest offset; needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("kafka.group.id", group)
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select(F.col("value").cast("string").alias("message"), "topic", "partition", "offset")


def land_stream(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    fmt: str = "parquet",
    *,
    partition_by: tuple[str, ...] = (),
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Append a stream to a folder; the file sink's log and the checkpoint make it exactly-once."""
    writer = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**(dict(trigger) if trigger else {"availableNow": True})).start(sink)


def normalize_polls(df: DataFrame, body: str, station: str, fetched_at: str) -> DataFrame:
    """Landed polls of station observations to flat rows; works on tables and streams.

    A poll whose body is null failed, and stays visible as a ``fetch_error`` row. The landed text stays beside
    the flat columns as ``raw_observation``.
    """
    rest = [c for c in df.columns if c not in (body, station, fetched_at)]
    parsed = with_once(df, "__body", whole_json(body))
    flat = normalize_observation(F.col("__body"), F.col(station), F.col(fetched_at))
    return parsed.select(*rest, *[c.alias(n) for n, c in flat.items()], F.col(body).alias("raw_observation"))
