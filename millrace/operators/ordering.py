"""Priority order and bounded samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def priority_order(df: DataFrame, priority: str, arrival: str) -> DataFrame:
    """Lowest priority number first, ties by arrival.

    Sorting on both columns lets the range partitioner cut inside one priority level.
    """
    return df.orderBy(F.col(priority).asc(), F.col(arrival).asc())


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of an order; every task keeps only its own best ``n``."""
    return df.orderBy(*order).limit(n)


def first_rows_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group.

    The rank filter lets Spark limit each group inside every task before the shuffle, so a hot
    group sends ``n`` rows per task.
    """
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    return numbered.filter(F.col(rank) <= n)


def recent_runs(runs: DataFrame, started: str, run_id: str, n: int = 20) -> DataFrame:
    """The latest ``n`` runs, newest first, with the total number of runs on every row."""
    total = runs.agg(F.count(F.lit(1))).scalar()
    latest = first_rows(runs, [F.col(started).desc(), F.col(run_id).desc()], n)
    return latest.withColumn("total_runs", total)
