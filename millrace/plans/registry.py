"""Registered queries, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.session import tune


class Tables:
    """The given tables by name, e.g. ``tables.orders``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a query function under a name."""
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = Query(name, build, sql)
        return build
    return register


def all_queries() -> dict[str, Query]:
    from millrace.plans import (  # noqa: F401  (importing registers them)
        queries_flows,
        queries_governance,
        queries_quality,
        queries_sources,
        queries_steps,
        queries_streaming,
    )
    return QUERIES
