"""Queries over high-water marks, messages and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import whole_json
from millrace.operators.once import with_once
from millrace.plans.registry import Tables, query
from millrace.session import scratch_dir
from millrace.streaming.marks import high_water_filter, high_water_stream
from millrace.streaming.messages import quarantined_messages, valid_messages
from millrace.streaming.progress import BatchStats, observe_gate, observe_stream
from millrace.streaming.streams import land_stream, normalize_polls, read_stream


def _arrivals(t: Tables) -> DataFrame:
    """Events in an arrival order that differs from their ids, with event times that jump about."""
    noise = F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 8), 16, 10).cast("bigint")
    return t.events.select(
        "event_id", "user_id", "value",
        (F.col("event_id") * 100 + noise % 5000).alias("arrival"),
        (F.col("event_id") * 60 + noise % 7200).alias("happened"),
    )


ARRIVALS = """
    n AS (SELECT event_id, user_id, value, CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) AS noise FROM events),
    a AS (SELECT event_id, user_id, value, event_id * 100 + noise % 5000 AS arrival, event_id * 60 + noise % 7200 AS happened FROM n)
"""


def _kept(partition: str) -> str:
    return f"""
    ids AS (SELECT *, max(event_id) OVER ({partition} ORDER BY arrival, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen_id FROM a),
    fresh AS (SELECT * FROM ids WHERE seen_id IS NULL OR event_id > seen_id),
    times AS (SELECT *, max(happened) OVER ({partition} ORDER BY arrival, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen_at FROM fresh)
    """


@query("hwm_id_batch", f"WITH {ARRIVALS}, {_kept('')} SELECT event_id, user_id, value FROM fresh")
def hwm_id_batch(t: Tables) -> DataFrame:
    kept = high_water_filter(_arrivals(t), order=["arrival", "event_id"], id_column="event_id")
    return kept.select("event_id", "user_id", "value")


@query("hwm_ts_batch", f"""
    WITH {ARRIVALS}, {_kept('PARTITION BY user_id')}
    SELECT event_id, user_id, happened FROM times WHERE seen_at IS NULL OR happened > seen_at
""")
def hwm_ts_batch(t: Tables) -> DataFrame:
    kept = high_water_filter(_arrivals(t), order=["arrival", "event_id"], keys=["user_id"],
                             id_column="event_id", time_column="happened")
    return kept.select("event_id", "user_id", "happened")


@query("hwm_stream", f"""
    WITH {ARRIVALS}, {_kept('')}
    SELECT event_id, user_id, happened FROM times WHERE seen_at IS NULL OR happened > seen_at
""")
def hwm_stream(t: Tables) -> DataFrame:
    """Two waves of files with a restart in between; the marks live on in the checkpointed state.

    The streams run while the query is built.
    """
    base = scratch_dir(t.spark, "marks")
    arrivals = _arrivals(t)
    middle = arrivals.agg(F.percentile_approx("arrival", 0.5)).first()[0] or 0
    for wave in (F.col("arrival") <= middle, F.col("arrival") > middle):
        arrivals.filter(wave).write.mode("append").parquet(f"{base}/landing")
        stream = read_stream(t.spark, f"{base}/landing", arrivals.schema, "parquet")
        high_water_stream(
            stream, order=["arrival", "event_id"], id_column="event_id", time_column="happened",
            sink=f"{base}/kept", checkpoint=f"{base}/checkpoint",
        ).awaitTermination()
    return t.spark.read.schema(arrivals.schema).parquet(f"{base}/kept").select("event_id", "user_id", "happened")


@query("stream_scan", "SELECT event_id, user_id, event_type, value, props FROM events")
def stream_scan(t: Tables) -> DataFrame:
    base = scratch_dir(t.spark, "stream")
    events = t.events.select("event_id", "user_id", "event_type", "value", "props")
    events.write.json(f"{base}/landing")
    stream = read_stream(t.spark, f"{base}/landing", events.schema)
    land_stream(stream, f"{base}/landed", f"{base}/checkpoint").awaitTermination()
    return t.spark.read.schema(events.schema).parquet(f"{base}/landed")


def _messages(t: Tables) -> DataFrame:
    kind, key = F.col("event_type"), F.col("event_id").cast("string")
    text = (
        F.when(kind == "click", F.concat(F.lit('{"source_id":" s'), key, F.lit(' ","action":"ingest"}')))
        .when(kind == "view", F.concat(F.lit('{"source_id":"s'), key, F.lit('","action":"backfill","priority":'),
                                       F.col("user_id").cast("string"), F.lit(',"payload":{"v":1}}')))
        .when(kind == "error", F.lit('{"source_id":"","action":"drop","priority":0,"payload":[1]}'))
        .when(kind == "purchase", F.lit("[1,2]")).otherwise(F.lit("{broken")))
    return t.events.select("event_id", text.alias("message"))


@query("validate_messages", """
    SELECT event_id, 's' || event_id AS source_id, 'ingest' AS action, 3 AS priority, '{}' AS payload
    FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, 's' || event_id, 'backfill', CAST(user_id AS INTEGER), '{"v":1}'
    FROM events WHERE event_type = 'view' AND user_id BETWEEN 1 AND 5
""")
def validate_messages(t: Tables) -> DataFrame:
    return valid_messages(_messages(t), "message")


@query("quarantine_messages", """
    SELECT event_id, 'priority not within 1..5' AS reasons FROM events
    WHERE event_type = 'view' AND user_id NOT BETWEEN 1 AND 5
    UNION ALL SELECT event_id, 'source_id missing,action not allowed,priority not within 1..5,payload is not an object'
    FROM events WHERE event_type = 'error'
    UNION ALL SELECT event_id, 'message is not a JSON object' FROM events WHERE event_type IN ('purchase', 'signup')
""")
def quarantine_messages(t: Tables) -> DataFrame:
    return quarantined_messages(_messages(t), "message").select(
        "event_id", F.array_join("reasons", ",").alias("reasons"))


FILES, FILES_PER_BATCH = 12, 2


@query("source_stats", """
    SELECT CAST(6 AS BIGINT) AS batches, count(*) AS records, sum(strlen(props)) + 2 * count(*) FILTER (event_id % 10 = 0) AS bytes,
           count(*) FILTER (event_id % 10 = 0) AS bad, count(*) FILTER (value > 50) AS dear, count(*) AS landed,
           count(*) FILTER (event_id % 10 = 0) AS unread
    FROM events
""")
def source_stats(t: Tables) -> DataFrame:
    """Landed responses streamed in several batches; a tenth of them cannot be read. Each batch tells what it held.

    The stream runs while the query is built.
    """
    base = scratch_dir(t.spark, "stats")
    broken = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{{"), F.col("props"))).otherwise(F.col("props"))
    landed = t.events.select("event_id", "value", broken.alias("body"))
    landed.repartition(FILES).write.parquet(f"{base}/landing")
    stream = read_stream(t.spark, f"{base}/landing", landed.schema, "parquet", files_per_trigger=FILES_PER_BATCH)
    parsed = with_once(stream, "parsed", whole_json("body"))
    watched = observe_gate(observe_stream(parsed, payload=F.col("body"), bad=F.col("parsed").isNull()), [{"type": "valid_range", "column": "value", "max": 50}])
    with BatchStats(t.spark) as stats:
        stats.wait(land_stream(watched.select("event_id", F.col("parsed").isNull().alias("unread")), f"{base}/landed", f"{base}/checkpoint"))
    told = stats.take()
    # A handful of batches, each a row of counts.
    totals = {name: sum(b[name] for b in told) for name in ("records", "bytes", "bad")}
    totals |= {"batches": len(told), "dear": sum(f["failed"] for b in told for f in b["findings"])}
    kept = t.spark.read.schema("event_id bigint, unread boolean").parquet(f"{base}/landed")
    return kept.agg(*[F.lit(n).cast("long").alias(name) for name, n in totals.items()],
                    F.count(F.lit(1)).alias("landed"), F.count_if("unread").alias("unread"))


@query("stream_polls", """
    SELECT event_id, 'K' || user_id AS station_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS temperature_c,
           CASE WHEN event_type = 'error' THEN 'fetch_error' ELSE 'clear' END AS description FROM events
""")
def stream_polls(t: Tables) -> DataFrame:
    """Polls, failed ones included, admitted a few files at a time over two runs of one stream that loses and doubles none.

    The streams run while the query is built.
    """
    base = scratch_dir(t.spark, "polls")
    body = F.when(F.col("event_type") != "error", F.format_string(
        '{"properties":{"temperature":{"value":%s},"textDescription":"clear"}}', F.col("value").cast("string")))
    polls = t.events.select(
        "event_id", F.concat(F.lit("K"), "user_id").alias("station"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("fetched_at"), body.alias("body"))
    for wave in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1):
        polls.filter(wave).repartition(FILES).write.mode("append").parquet(f"{base}/landing")
        stream = read_stream(t.spark, f"{base}/landing", polls.schema, "parquet", files_per_trigger=FILES_PER_BATCH)
        flat = normalize_polls(stream, "body", "station", "fetched_at").select("event_id", "station_id", "temperature_c", "description")
        query = land_stream(flat, f"{base}/landed", f"{base}/checkpoint")
        query.awaitTermination()
        admitted = sum(p.numInputRows > 0 for p in query.recentProgress)
        if admitted > FILES // FILES_PER_BATCH:
            raise AssertionError(f"{admitted} batches admitted more than the files of this wave")
    return t.spark.read.schema("event_id bigint, station_id string, temperature_c double, description string").parquet(f"{base}/landed")
