"""What each micro-batch of a stream counted: source statistics and gate findings, read from its progress."""

from __future__ import annotations

import threading
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.operators.quality import gate_findings, gate_measures

SOURCE, GATE = "source", "gate"


def observe_stream(stream: DataFrame, *, payload: Column | None = None, bad: Column | None = None) -> DataFrame:
    """Count the records of every batch of a source, the bytes of ``payload`` and the records that are ``bad``."""
    return stream.observe(
        SOURCE, F.count(F.lit(1)).alias("records"),
        (F.coalesce(F.sum(F.octet_length(payload)), F.lit(0)) if payload is not None else F.lit(0).cast("bigint")).alias("bytes"),
        (F.count_if(F.coalesce(bad, F.lit(False))) if bad is not None else F.lit(0).cast("bigint")).alias("bad"))


def observe_gate(stream: DataFrame, checks: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Evaluate the row-level checks of a gate on every batch; the rows pass on whatever it finds."""
    types = {f.name: f.dataType for f in stream.schema}
    return stream.observe(GATE, *[c.alias(n) for n, c in gate_measures(list(checks), types).items()])


class BatchStats(StreamingQueryListener):
    """Measures of the batches of the streams of a session, gathered while they run.

    Use it as a context: inside, every stream of the session is listened to. One entry is kept per batch, so a
    caller of an endless stream takes them away with :meth:`take`.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.batches, self.ended, self.changed = spark, {}, set(), threading.Condition()

    def __enter__(self) -> BatchStats:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event: Any) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event: Any) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event: Any) -> None:  # noqa: N802
        progress = event.progress
        measured = {name: row.asDict() for name, row in (progress.observedMetrics or {}).items()}
        with self.changed:
            # A batch that is run again after a failure counts as it was run last.
            if measured:
                self.batches[str(progress.id), progress.batchId] = measured
            self.changed.notify_all()

    def onQueryTerminated(self, event: Any) -> None:  # noqa: N802
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait(self, query: StreamingQuery, timeout: float = 60) -> None:
        """Until the query has ended and its last batch has been heard of."""
        query.awaitTermination()
        with self.changed:
            if not self.changed.wait_for(lambda: str(query.runId) in self.ended, timeout):
                raise TimeoutError("the end of the stream was not told")

    def take(self) -> list[dict[str, Any]]:
        """Per batch with rows: ``batch_id``, its source counts, and the ``findings`` of its gate; then forget them."""
        with self.changed:
            held, self.batches = sorted(self.batches.items()), {}
        found = []
        for (_, batch_id), measured in held:
            counts = measured.get(SOURCE, {})
            gate = measured.get(GATE)
            if (counts.get("records") or 0) or (gate and gate.get("rows")):
                found.append({"batch_id": batch_id, **counts, "findings": gate_findings(gate) if gate else []})
        return found
