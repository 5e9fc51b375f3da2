"""Counters and histograms over run logs. All of them are partial aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import error_category, zone_name

# Upper bounds of the duration histogram, in seconds.
DURATION_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0, 120.0)


def counter(df: DataFrame, labels: Sequence[str], amounts: dict[str, Column | str]) -> DataFrame:
    """Sum of amounts per label set; negative and missing amounts count as zero."""
    sums = []
    for name, amount in amounts.items():
        value = F.col(amount) if isinstance(amount, str) else amount
        sums.append(F.sum(F.greatest(F.coalesce(value, F.lit(0)), F.lit(0))).alias(name))
    return df.groupBy(*labels).agg(*sums)


def storage_writes(df: DataFrame, zone: str, size: str) -> DataFrame:
    """Write operations and bytes per normalised storage zone."""
    return counter(
        df.withColumn("zone", zone_name(F.col(zone))), ["zone"],
        {"writes": F.lit(1).cast("bigint"), "bytes_written": size},
    )


def duration_histogram(df: DataFrame, labels: Sequence[str], seconds: str) -> DataFrame:
    """Cumulative bucket counts per label set; negative and missing durations are skipped.

    Rows are (labels, le, bucket_count, total_count, total_seconds), one per bound plus infinity.
    """
    valid = df.filter(F.col(seconds) >= 0)
    counts = [F.count_if(F.col(seconds) <= b).alias(f"b{i}") for i, b in enumerate(DURATION_BOUNDS)]
    folded = valid.groupBy(*labels).agg(*counts, F.count(F.lit(1)).alias("n"), F.sum(seconds).alias("s"))
    rows = [F.struct(F.lit(f"{b:g}").alias("le"), F.col(f"b{i}").alias("bucket_count"))
            for i, b in enumerate(DURATION_BOUNDS)]
    rows.append(F.struct(F.lit("inf").alias("le"), F.col("n").alias("bucket_count")))
    return folded.select(
        *labels, F.explode(F.array(*rows)).alias("r"),
        F.col("n").alias("total_count"), F.col("s").alias("total_seconds"),
    ).select(*labels, "r.le", "r.bucket_count", "total_count", "total_seconds")


def error_counts(df: DataFrame, labels: Sequence[str], errors: str) -> DataFrame:
    """Errors per label set and category, from an array column of messages."""
    return (
        df.select(*labels, F.explode(errors).alias("message"))
        .withColumn("error_type", error_category(F.col("message")))
        .groupBy(*labels, "error_type").agg(F.count(F.lit(1)).alias("errors"))
    )


def quality_totals(df: DataFrame, source: str, passed: str, failed: str, rate: str, at: str, run: str) -> DataFrame:
    """Checks passed and failed per source, and the pass rate of its latest result; of equal times the larger run."""
    return df.groupBy(source).agg(
        F.sum(passed).alias("passed"), F.sum(failed).alias("failed"),
        F.max_by(rate, F.struct(at, run)).alias("latest_pass_rate"),
    )
