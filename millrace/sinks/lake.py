"""Writers for the raw and curated zones, with a receipt of what was written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace.sinks.staged import Folder, publish


class EmptyWriteError(ValueError):
    """Raised instead of writing a dataset without rows."""


@dataclass
class WriteReceipt:
    destination: str
    records_written: int
    bytes_written: int
    partitions: list[str]
    format: str
    timestamp: datetime = field(default_factory=lambda: datetime.now(timezone.utc))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the data files below a path, from the file system alone."""
    return sum(size for _, size in Folder(spark, path.rpartition("/")[0]).files(path.rstrip("/").rpartition("/")[2]))


def _spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather each partition value into few files; a large value is split into several tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("records")), observation


def _save(df: DataFrame, path: str, fmt: str, partition_by: Sequence[str], told: Sequence[str], mode: str = "append") -> WriteReceipt:
    """One job: it writes the files, counts the rows and shows, in the files it wrote, their bytes."""
    counted, observation = _counted(df)

    def write(stage: str) -> int:
        _spread(counted, partition_by).write.partitionBy(*partition_by).format(fmt).save(stage)
        try:
            return observation.get["records"]
        except Py4JJavaError:
            return 0  # a plan known to be empty is not run, so nothing was observed

    rows, size = publish(df.sparkSession, path, write, mode)
    if not rows:
        raise EmptyWriteError("refusing to write a dataset without rows")
    return WriteReceipt(path, rows, size, list(told), fmt)


def write_raw(
    df: DataFrame,
    base: str,
    source_id: str,
    partition_values: Mapping[str, Any] | None = None,
    *,
    fmt: str = "parquet",
) -> WriteReceipt:
    """Append to ``<base>/raw/<source_id>/<k>=<v>/..`` with partition keys in sorted order.

    The values are constant for the whole write, so they name the folder and no rows move.
    """
    parts = [f"{k}={v}" for k, v in sorted((partition_values or {}).items())]
    path = "/".join([base.rstrip("/"), "raw", source_id, *parts])
    constant = [c for c in df.columns if c in (partition_values or {})]
    return _save(df.drop(*constant), path, fmt, (), parts)


def write_jsonl(df: DataFrame, base: str, source_id: str) -> WriteReceipt:
    """Append JSON lines to ``<base>/raw/<source_id>``."""
    return write_raw(df, base, source_id, fmt="json")


def write_curated(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    *,
    base: str | None = None,
    fmt: str = "parquet",
) -> WriteReceipt:
    """Append to a curated table, creating it when absent, partitioned by column values.

    With ``base`` the table is a folder ``<base>/curated/<table>``. Without it the table lives in the
    session catalog; ``fmt="iceberg"`` then uses that connector when it is on the class path.
    """
    if base is not None:
        return _save(df, f"{base.rstrip('/')}/curated/{table.replace('.', '_')}", fmt, partition_by, partition_by)
    # A catalog table has a commit of its own, so its emptiness is looked at before.
    if df.isEmpty():
        raise EmptyWriteError("refusing to write a dataset without rows")
    spark = df.sparkSession
    counted, observation = _counted(df)
    spread = _spread(counted, partition_by)
    exists = spark.catalog.tableExists(table)
    before = _table_bytes(spark, table, fmt) if exists else 0
    if fmt != "iceberg":
        spread.write.format(fmt).mode("append").partitionBy(*partition_by).saveAsTable(table)
    elif exists:
        spread.writeTo(table).append()
    else:
        creator = spread.writeTo(table).using(fmt)
        if partition_by:
            creator = creator.partitionedBy(*[F.col(c) for c in partition_by])
        creator.create()
    written = _table_bytes(spark, table, fmt) - before
    return WriteReceipt(table, observation.get["records"], max(written, 0), list(partition_by), fmt)


def _table_bytes(spark: SparkSession, table: str, fmt: str) -> int:
    """Size of a catalog table from its file list, never from its rows."""
    if fmt == "iceberg":
        return spark.table(f"{table}.files").agg(F.sum("file_size_in_bytes").alias("n")).first()["n"] or 0
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()
    return stored_bytes(spark, details["data_type"]) if details else 0


def overwrite_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), *, fmt: str = "parquet", dynamic: bool = False
) -> WriteReceipt:
    """Replace a folder, or with ``dynamic`` only the partitions that occur in the data.

    The old data stay until the new ones are written: a write that fails half-way changes nothing.
    """
    return _save(df, path, fmt, partition_by, partition_by, "partitions" if dynamic and partition_by else "overwrite")
