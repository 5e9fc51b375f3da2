"""Statistics of one ingestion run, gathered while its rows pass by."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, functions as F


@dataclass
class SourceStats:
    """Counts of a source, filled by the first action on :attr:`df`."""

    source_id: str
    df: DataFrame
    observation: Observation
    started_at: datetime
    completed_at: datetime | None = None
    errors: list[str] = field(default_factory=list)

    def result(self) -> dict:
        """Records, bytes, times and errors; call it after the action."""
        measured = self.observation.get
        self.completed_at = self.completed_at or datetime.now(timezone.utc)
        return {
            "source_id": self.source_id,
            "records_fetched": measured["records"],
            "bytes_fetched": measured.get("bytes") or 0,
            "started_at": self.started_at,
            "completed_at": self.completed_at,
            "errors": [*self.errors, *([f"{measured['bad']} records could not be read"] if measured.get("bad") else [])],
        }


def observe_source(df: DataFrame, source_id: str, *, payload: Column | None = None, bad: Column | None = None) -> SourceStats:
    """Attach record and byte counters to a source.

    ``payload`` is the text whose bytes are counted, ``bad`` the test of a record that could not be read.
    """
    observation = Observation(f"source:{source_id}")
    measures = [F.count(F.lit(1)).alias("records")]
    if payload is not None:
        measures.append(F.sum(F.octet_length(payload)).alias("bytes"))
    if bad is not None:
        measures.append(F.count_if(bad).alias("bad"))
    return SourceStats(source_id, df.observe(observation, *measures), observation, datetime.now(timezone.utc))
