import json

import pytest
from helpers import values
from pyspark.sql import functions as F

from millrace.functions import digits_only
from millrace.operators import lineage as L, privacy as P, rollups as R
from millrace.operators.ordering import first_rows_per_group, priority_order, recent_runs
from millrace.operators import profile as D


def test_name_hints():
    assert [P.name_hint(c) for c in ("user-Email", "Home Phone", "ssn", "customer_name", "zip code", "birth_date", "x")] == [
        "email", "phone", "ssn", "name", "address", "dob", None]
    assert P.name_hint("description") == "ip_address" and P.name_hint("description", match="token") is None
    assert P.name_hint("client_ip", match="token") == "ip_address"


def test_scan_finds_first_value_in_order(spark):
    rows = [(1, "n/a"), (2, "call 555-123-4567"), (3, "mail a@b.org"), (4, None)]
    df = spark.createDataFrame(rows, "id bigint, contact string")
    found = {r.column: (r.by_name, r.by_value, r.pii_type, r.scanned_rows) for r in P.scan_columns(df, "id").collect()}
    assert found == {"contact": (None, "phone", "phone", 4), "id": (None, None, None, 4)}


@pytest.mark.parametrize("text, kind", [
    ("write to a.b@c.io", "email"), ("+1 (212) 555-0199", "phone"), ("id 123-45-6789", "ssn"), ("666-45-6789", None),
    ("host 10.0.0.255 up", "ip_address"), ("host 10.0.0.256", None), ("4111-1111-1111-1111", "credit_card"),
    ("   ", None), (None, None),
])
def test_value_type(spark, text, kind):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(P.value_type(F.col("t"), digits_only(F.col("t")))).first()[0]
    if kind == "credit_card":
        # The last ten of its digits also read as a phone number when nothing stands in front of them.
        assert got in ("phone", "credit_card")
    else:
        assert got == kind


def test_classification(spark):
    people = spark.createDataFrame([("A", "123-45-6789")], "name string, ssn string")
    row = P.classify(people, "s", "name", {"classification": "public"}).first()
    assert (row.classification, row.pii_fields, row.scanned_columns, row.scanned_rows) == (
        "confidential", {"name": "name", "ssn": "ssn"}, 2, 1)
    assert P.classify(people, "s", "name", {"classification": "restricted"}).first().classification == "restricted"
    plain = spark.createDataFrame([("NY", 5)], "state string, population bigint")
    row = P.classify(plain, "s", "state", {"classification": "public"}).first()
    assert (row.classification, row.pii_fields) == ("public", {})
    assert P.classify(plain, "s", "state", {"classification": "odd"}).first().classification == "internal"
    empty = P.classify(people.filter("false"), "s", "name", {"classification": "public"}).first()
    assert (empty.classification, empty.pii_fields, empty.scanned_columns, empty.scanned_rows) == ("public", {}, 0, 0)


@pytest.fixture
def lineage(spark):
    ref = "struct<namespace:string,name:string,facets:string>"
    runs = spark.createDataFrame(
        [("r1", "j1", "2024-01-01", [("api", "src_a", "{}")], [("local", "raw/src_a", "{}")]),
         ("r2", "j2", "2024-01-02", [("local", "raw/src_a", "{}"), ("local", "dim", "{}")], [("lake", "mart", "{}")]),
         ("r3", "j3", "2024-01-03", [("lake", "mart", '{"source":{"source_id":"tagged"}}')], [("lake", "report", "{}")])],
        f"run_id string, job_name string, started_at string, inputs array<{ref}>, outputs array<{ref}>",
    ).withColumn("started_at", F.col("started_at").cast("timestamp"))
    ends = spark.createDataFrame(
        [("r1", "COMPLETE", [("local", "raw/src_a", "{}")], None, None), ("r2", "COMPLETE", [("lake", "mart", "{}")], None, None),
         ("r3", "FAIL", [("lake", "report", "{}")], None, "boom \"x\""), ("r9", "COMPLETE", None, None, None)],
        f"run_id string, event_type string, outputs array<{ref}>, facets string, error_message string",
    ).withColumn("event_time", F.lit("2024-01-05").cast("timestamp"))
    starts = L.start_events(runs)
    return starts, L.end_events(starts, ends)


def test_end_events_inherit_and_fail_without_outputs(lineage):
    rows = {r.run_id: r for r in lineage[1].collect()}
    assert rows["r2"].job_name == "j2" and len(rows["r2"].inputs) == 2
    assert rows["r3"].outputs == [] and json.loads(rows["r3"].facets) == {"errorMessage": 'boom "x"'}
    assert (rows["r9"].job_name, rows["r9"].inputs, rows["r9"].outputs) == ("unknown", [], [])


def test_neighbors(lineage):
    starts, ends = lineage
    events = starts.unionByName(ends)
    found = values(L.neighbors(events, "src_a"))
    # Both datasets named after the source belong to it, so only the mart lies beyond them.
    assert found == [("downstream", "lake:mart")]
    assert values(L.neighbors(events, "dim")) == [("downstream", "lake:mart")]
    assert values(L.neighbors(events, "tagged")) == [("upstream", "local:dim"), ("upstream", "local:raw/src_a")]
    assert values(L.neighbors(events, "nobody")) == []
    # Events without a time, and equal events, count as well.
    undated = events.withColumn("event_time", F.lit(None).cast("timestamp"))
    assert values(L.neighbors(undated.unionAll(events), "tagged")) == values(L.neighbors(events, "tagged"))


def test_latest_start_of_a_run_counts(lineage):
    starts, ends = lineage
    again = starts.withColumns({"job_name": F.lit("old"), "event_time": F.col("event_time") - F.expr("INTERVAL 1 DAY")})
    runs = starts.filter("event_type = 'START'").select("run_id", "job_name", F.col("event_time"), "inputs", "job_namespace")
    done = runs.select("run_id", F.lit("COMPLETE").alias("event_type"), "event_time", F.col("inputs").alias("outputs"),
                       F.lit(None).cast("string").alias("facets"), F.lit(None).cast("string").alias("error_message"))
    once = L.end_events(starts, done)
    twice = L.end_events(starts.unionByName(again).unionByName(starts), done)
    assert values(twice, "run_id", "job_name") == values(once, "run_id", "job_name")


def test_lineage_json_and_facets(lineage, products):
    body = json.loads(L.lineage_json(lineage[1]).filter("run_id = 'r2'").first().json)
    assert body["eventType"] == "COMPLETE" and body["eventTime"] == "2024-01-05T00:00:00.000000Z"
    assert body["run"] == {"runId": "r2"} and body["inputs"][1]["name"] == "dim" and body["job"]["facets"] == {}
    ref = L.dataset_with_facets(products, "ns", "p", profile=D.quality_profile(products), steps=["a"], source_id="s").first()
    facets = json.loads(ref.facets)
    assert facets["schema"]["fields"][0] == {"name": "name", "type": "string"}
    assert facets["dataQuality"]["rowCount"] == 5 and facets["dataQuality"]["uniqueCounts"]["category"] == 4
    assert facets["transform"]["steps"] == ["a"] and facets["source"] == {"source_id": "s"}
    assert set(json.loads(L.dataset_with_facets(products, "ns", "p").first().facets)) == {"schema"}


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("a", None)], "k string, v int")
    assert values(D.null_profile(df)) == [("k", 3, 2, 1), ("v", 3, 2, 1)]
    assert D.null_profile(df.filter("false")).count() == 0
    assert values(D.quality_profile(df)) == values(D.quality_profile(df, approximate=True)) == [("k", 3, 1, 1), ("v", 3, 1, 1)]


def test_schema_inference(spark):
    df = spark.createDataFrame([('{"age":25}',), ('{"age":null,"tags":[]}',), ('{"age":3.5}',), ("[1]",), ("{oops",)], "j string")
    assert values(D.infer_json_schema(df, "j")) == [("age", ["integer", "null", "number"], True), ("tags", ["array"], False)]
    good = df.filter("j LIKE '%age%'")
    assert "age" in D.merged_schema(good, "j").first().schema
    two = spark.createDataFrame([('{"a":1}',), ('{"b":{"c":"x"}}',)], "j string")
    assert D.create_table_ddl(two, "j") == "STRUCT<a: BIGINT, b: STRUCT<c: STRING>>"


def test_rollups(spark):
    runs = spark.createDataFrame(
        [("a", "Raw", -5, 0.004, "2024-01-01", 0.5), ("a", " raw", 7, 200.0, "2024-01-03", 0.9), ("b", None, None, -1.0, "2024-01-02", 0.1)],
        "source string, zone string, n bigint, s double, at string, rate double")
    assert values(R.counter(runs, ["source"], {"n": "n"})) == [("a", 7), ("b", 0)]
    assert values(R.storage_writes(runs, "zone", "n")) == [("raw", 2, 7), ("unknown", 1, 0)]
    buckets = {r.le: r.bucket_count for r in R.duration_histogram(runs, ["source"], "s").collect()}
    assert len(buckets) == 15 and buckets["0.005"] == 1 and buckets["120"] == 1 and buckets["inf"] == 2
    assert values(R.quality_totals(runs, "source", "n", "n", "rate", "at", "zone"), "source", "latest_pass_rate") == [("a", 0.9), ("b", 0.1)]


def test_order_and_samples(spark):
    commands = spark.createDataFrame([(3, 1), (1, 2), (5, 3), (1, 4)], "priority int, seq int")
    assert [r.seq for r in priority_order(commands, "priority", "seq").collect()] == [2, 4, 1, 3]
    top = first_rows_per_group(spark.range(100).selectExpr("id", "id % 2 AS g"), ["g"], [F.col("id").desc()], 3)
    assert values(top, "id") == [(94,), (95,), (96,), (97,), (98,), (99,)]
    runs = recent_runs(spark.range(30).selectExpr("id", "id AS at"), "at", "id")
    assert (runs.count(), runs.agg(F.min("id"), F.max("total_runs")).first()) == (20, (10, 30))


def test_profiles_merge_within_their_error(spark):
    df = spark.range(0, 40_000, 1, 4).selectExpr("id % 7 AS part", "md5(CAST(id % 9000 AS STRING)) AS text", "IF(id % 10 = 0, NULL, id) AS n", "CAST(NULL AS STRING) AS gone")
    parts = D.profile_sketches(df, ["text", "n", "gone"], ["part"])
    assert parts.count() == 7
    merged = {r.column: r for r in D.merged_profile(parts, ["text", "n", "gone"]).collect()}
    exact = {r.column: r for r in D.quality_profile(df, ["text", "n", "gone"]).collect()}
    for c, r in exact.items():
        assert (merged[c].row_count, merged[c].null_count) == (r.row_count, r.null_count)
        assert abs(merged[c].unique_count - r.unique_count) <= r.unique_count * D.SKETCH_ERROR
    assert (exact["text"].unique_count, exact["n"].unique_count, exact["gone"].unique_count) == (9000, 36_000, 0)
    empty = {r.column: r.unique_count for r in D.merged_profile(D.profile_sketches(df.filter("false"), ["n"], ["part"]), ["n"]).collect()}
    assert empty == {"n": 0}


def test_no_text_is_expanded(spark):
    df = spark.range(10).selectExpr("id", "md5(CAST(id AS STRING)) AS text")
    plan = D.quality_profile(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and "text" not in plan.split("Expand")[1].split("\n")[0]
