import random

import pytest
from helpers import values
from pyspark.sql import functions as F

from millrace.streaming import messages as M
from millrace.streaming.marks import high_water_filter, high_water_stream
from millrace.streaming.progress import BatchStats, observe_gate, observe_stream
from millrace.streaming.streams import land_stream, normalize_polls, read_kafka, read_stream

SCHEMA = "seq bigint, key string, id bigint, at double"


def reference_filter(rows, keyed, marks=None):
    """The rule applied one row after another."""
    marks = {} if marks is None else marks
    kept = []
    for seq, key, rid, at in sorted(rows):
        mark = marks.setdefault(key if keyed else None, [None, None])
        if rid is not None:
            if mark[0] is not None and rid <= mark[0]:
                continue
            mark[0] = rid
        if at is not None:
            if mark[1] is not None and at <= mark[1]:
                continue
            mark[1] = at
        kept.append((seq, key, rid, at))
    return kept


def make_rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", None])
        rid = None if rng.random() < 0.05 else seq + rng.randint(-8, 8)
        at = None if rng.random() < 0.05 else float(seq + rng.randint(-8, 8))
        rows.append((seq, key, rid, at))
    return rows


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("slices", [1, 7, None])
def test_batch_equals_row_by_row(spark, keyed, slices):
    rows = make_rows(slices or 3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = high_water_filter(df, order=["seq"], keys=["key"] if keyed else [], id_column="id", time_column="at", slices=slices)
    assert values(got) == sorted(reference_filter(rows, keyed), key=repr)


def test_text_ids(spark):
    df = spark.createDataFrame([(1, "9"), (2, "10"), (3, "10.0"), (4, "b"), (5, "a"), (6, "c"), (7, None)], "seq int, id string")
    got = high_water_filter(df, order=["seq"], id_column="id")
    assert [r.seq for r in got.orderBy("seq").collect()] == [1, 2, 4, 6, 7]


def test_text_times(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01T00:00:00Z"), (2, "2024-01-01T01:00:00+02:00"), (3, "later"), (4, "2024-01-02")], "seq int, at string")
    assert values(high_water_filter(df, order=["seq"], time_column="at"), "seq") == [(1,), (3,), (4,)]


@pytest.mark.parametrize("keyed", [False, True])
def test_stream_with_restarts_equals_batch(spark, tmp_path, keyed):
    rows = make_rows(11, 300)
    everything = spark.createDataFrame(rows, SCHEMA)
    for low in range(0, 300, 60):
        everything.filter(f"seq >= {low} AND seq < {low + 60}").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        stream = read_stream(spark, f"{tmp_path}/in", everything.schema)
        high_water_stream(
            stream, order=["seq"], keys=["key"] if keyed else [], id_column="id", time_column="at",
            sink=f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp",
        ).awaitTermination()
    got = spark.read.schema(everything.schema).parquet(f"{tmp_path}/out")
    assert values(got.select("seq", "key", "id", "at")) == sorted(reference_filter(rows, keyed), key=repr)


def test_replayed_batch_changes_nothing(spark, tmp_path):
    rows = make_rows(5, 120)
    everything = spark.createDataFrame(rows, SCHEMA)

    def run():
        stream = read_stream(spark, f"{tmp_path}/in", everything.schema)
        high_water_stream(stream, order=["seq"], id_column="id", time_column="at",
                          sink=f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp").awaitTermination()

    for low in (0, 40, 80):
        everything.filter(f"seq >= {low} AND seq < {low + 40}").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        run()
    # As if the job had died after writing its output but before committing the batch.
    for committed in (tmp_path / "cp" / "commits").glob("*2*"):
        committed.unlink()
    run()
    got = spark.read.schema(everything.schema).parquet(f"{tmp_path}/out")
    assert values(got.select("seq", "key", "id", "at")) == sorted(reference_filter(rows, False), key=repr)


def test_a_stream_without_keys_is_filtered_by_many_tasks(spark, tmp_path):
    rows = [(seq, None, rid, at) for seq, _, rid, at in make_rows(7, 4000)]
    everything = spark.createDataFrame(rows, SCHEMA)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        for low in (0, 2000):
            everything.filter(f"seq >= {low} AND seq < {low + 2000}").write.mode("append").json(f"{tmp_path}/in")
            query = high_water_stream(read_stream(spark, f"{tmp_path}/in", everything.schema), order=["seq"], id_column="id",
                                      time_column="at", sink=f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp")
            query.awaitTermination()
            # No state that takes all rows of a batch into one task.
            assert query.lastProgress.stateOperators == []
    finally:
        spark.conf.set(coalesce, before)
    got = spark.read.schema(everything.schema).parquet(f"{tmp_path}/out")
    assert values(got.select("seq", "key", "id", "at")) == sorted(reference_filter(rows, False), key=repr)
    assert got.select(F.input_file_name()).distinct().count() >= 8


def test_a_batch_that_died_before_its_marks_is_written_again(spark, tmp_path):
    rows = make_rows(9, 120)
    everything = spark.createDataFrame(rows, SCHEMA)

    def run():
        high_water_stream(read_stream(spark, f"{tmp_path}/in", everything.schema), order=["seq"], id_column="id", time_column="at",
                          sink=f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp").awaitTermination()

    for low in (0, 60):
        everything.filter(f"seq >= {low} AND seq < {low + 60}").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        run()
    for committed in (tmp_path / "cp" / "commits").glob("*1*"):
        committed.unlink()
    for part in (tmp_path / "cp" / "marks" / "1").iterdir():
        part.unlink()
    run()
    got = spark.read.schema(everything.schema).parquet(f"{tmp_path}/out")
    assert values(got.select("seq", "key", "id", "at")) == sorted(reference_filter(rows, False), key=repr)


def test_text_ids_in_a_stream(spark, tmp_path):
    for part, ids in enumerate((["9", "10"], ["10.0", "b"], ["a", "c"])):
        df = spark.createDataFrame([(part * 10 + i, v) for i, v in enumerate(ids)], "seq bigint, id string")
        df.coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        high_water_stream(read_stream(spark, f"{tmp_path}/in", df.schema), order=["seq"], id_column="id",
                          sink=f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp").awaitTermination()
    got = spark.read.schema("seq bigint, id string").parquet(f"{tmp_path}/out")
    assert values(got, "id") == [("10",), ("9",), ("b",), ("c",)]


def test_land_stream_resumes(spark, tmp_path):
    for part in (1, 2):
        spark.range(part * 10, part * 10 + 3).write.mode("append").json(f"{tmp_path}/in")
        stream = read_stream(spark, f"{tmp_path}/in", "id bigint", files_per_trigger=1)
        land_stream(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert values(spark.read.parquet(f"{tmp_path}/out")) == [(10,), (11,), (12,), (20,), (21,), (22,)]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka(spark, "host:1", "commands")


@pytest.mark.parametrize("message, reasons", [
    ('{"source_id":" s ","action":"ingest"}', []),
    ('{"source_id":" ","action":"ingest","priority":"5","payload":{}}', []),
    ('{"source_id":"s","action":"ingest","priority":3.0}', []),
    ('{"source_id":"s","action":"ingest","priority":"high"}', ["priority not within 1..5"]),
    ('{"source_id":"s","action":"ingest","priority":99999999999}', ["priority not within 1..5"]),
    ('{"source_id":"s","action":"ingest","payload":null}', ["payload is not an object"]),
    ('{"source_id":"","action":"ingest"}', ["source_id missing"]),
    ('{"action":"backfill","priority":1}', ["source_id missing"]),
    ('{"source_id":7,"action":"ingest"}', ["source_id missing"]),
    ('{"source_id":"s","action":"INGEST"}', ["action not allowed"]),
    ('{"source_id":"s","action":"transform","priority":6}', ["priority not within 1..5"]),
    ('{"source_id":"s","action":"transform","priority":1.5}', ["priority not within 1..5"]),
    ('{"source_id":"s","action":"transform","priority":null}', ["priority not within 1..5"]),
    ('{"source_id":"s","action":"transform","payload":[1]}', ["payload is not an object"]),
    ('[1]', ["message is not a JSON object"]), ("nope", ["message is not a JSON object"]), (None, ["message is not a JSON object"]),
])
def test_message_rules(spark, message, reasons):
    df = spark.createDataFrame([(message,)], "m string")
    assert M.check_messages(df, "m").first().reasons == reasons


def test_valid_message_fields(spark):
    df = spark.createDataFrame([('{"source_id":" s ","action":"ingest","payload":{"a":1}}',)], "m string")
    assert M.valid_messages(df, "m").first() == ("s", "ingest", 3, '{"a":1}')
    assert M.quarantined_messages(df, "m").count() == 0


def test_polls(spark):
    good = '{"properties":{"timestamp":"t1","temperature":{"value":1},"windSpeed":{"value":2.5},"textDescription":"ok"}}'
    df = spark.createDataFrame([("A", good, "f1"), ("B", None, "f2"), ("C", '{"properties":5}', "f3")], "st string, body string, f string")
    assert values(normalize_polls(df, "body", "st", "f")) == [
        ("A", "t1", 1.0, None, 9.0, "ok", good), ("B", "f2", None, None, None, "fetch_error", None),
        ("C", "f3", None, None, None, "", '{"properties":5}')]


def test_polls_as_stream(spark, tmp_path):
    df = spark.createDataFrame([("A", '{"properties":{}}', "f1")], "st string, body string, f string")
    df.write.json(f"{tmp_path}/in")
    flat = normalize_polls(read_stream(spark, f"{tmp_path}/in", df.schema), "body", "st", "f")
    land_stream(flat, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").select("station_id", "timestamp").first() == ("A", "f1")


def test_batches_tell_what_they_held(spark, tmp_path):
    df = spark.range(0, 60).selectExpr("id", "IF(id % 7 = 0, NULL, repeat('é', CAST(id AS INT))) AS body", "CAST(id AS DOUBLE) AS v")
    for low in range(0, 60, 20):
        df.filter(f"id >= {low} AND id < {low + 20}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = read_stream(spark, f"{tmp_path}/in", df.schema, "parquet", files_per_trigger=1)
    watched = observe_gate(observe_stream(stream, payload=F.col("body"), bad=F.col("body").isNull()), [
        {"type": "not_null", "columns": ["body"]}, {"type": "valid_range", "column": "v", "min": 20}])
    with BatchStats(spark) as stats:
        stats.wait(land_stream(watched, f"{tmp_path}/out", f"{tmp_path}/cp"))
    told = stats.take()
    assert len(told) == 3 and stats.take() == []
    assert sorted(b["records"] for b in told) == [20, 20, 20] and sum(b["bad"] for b in told) == 9
    assert sum(b["bytes"] for b in told) == sum(2 * i for i in range(60) if i % 7)
    failed = {}
    for b in told:
        for f in b["findings"]:
            failed[f["rule"]] = failed.get(f["rule"], 0) + (f["failed"] if f["column"] is None else 0)
    assert failed == {"not_null": 9, "valid_range": 20}
