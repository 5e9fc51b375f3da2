"""Queries over privacy, lineage, schema discovery and run logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.functions import whole_json
from millrace.operators import lineage as L, privacy as P, rollups as R
from millrace.operators.once import with_once
from millrace.operators.ordering import recent_runs
from millrace.operators.profile import estimate_volume, infer_json_schema, merged_schema, quality_profile
from millrace.plans.registry import Tables, query

# The look-aheads of the SSN rule, spelled out for an engine that has none.
SSN_SQL = (
    r"\b(?:00[1-9]|0[1-9]\d|[1-578]\d\d|6[0-57-9]\d|66[0-57-9])[-\s]?(?:0[1-9]|[1-9]\d)[-\s]?"
    r"(?:000[1-9]|00[1-9]\d|0[1-9]\d\d|[1-9]\d{3})\b"
)


def _luhn_sql(text: str) -> str:
    digits = f"reverse(regexp_replace({text}, '[^0-9]', '', 'g'))"
    digit = f"CAST(substr({digits}, i, 1) AS INTEGER)"
    return f"""coalesce(CASE WHEN length({digits}) BETWEEN 13 AND 19 THEN list_sum([
        CASE WHEN i % 2 = 1 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END
        FOR i IN range(1, length({digits}) + 1)]) % 10 = 0 END, FALSE)"""


FLAGS = {
    "email": r"regexp_matches(text, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}')",
    "phone": r"regexp_matches(text, '(?:\+?1[-.\s]?)?\(?([0-9]{3})\)?[-.\s]?([0-9]{3})[-.\s]?([0-9]{4})\b')",
    "ssn": f"regexp_matches(text, '{SSN_SQL}')",
    "ip_address": f"regexp_matches(text, '{P.IP_ADDRESS}')",
    "credit_card": _luhn_sql("text"),
}
FLAG_SQL = ", ".join(f"{sql} AS has_{kind}" for kind, sql in FLAGS.items())
KIND_SQL = "CASE " + " ".join(f"WHEN {sql} THEN '{kind}'" for kind, sql in FLAGS.items()) + " END"


@query("pii_flags", f"SELECT doc_id, {FLAG_SQL} FROM documents")
def pii_flags(t: Tables) -> DataFrame:
    return P.flag_rows(t.documents, "text").select("doc_id", *[f"has_{k}" for k in P.VALUE_TYPES])


@query("pii_value_scan", f"""
    WITH k AS (SELECT doc_id, {KIND_SQL} AS kind FROM documents),
    first_hit AS (SELECT arg_min(kind, doc_id) FILTER (kind IS NOT NULL) AS kind, count(*) AS n FROM k)
    SELECT c AS "column", CAST(NULL AS VARCHAR) AS by_name, CASE WHEN c = 'text' THEN kind END AS by_value,
           CASE WHEN c = 'text' THEN kind END AS pii_type, n AS scanned_rows
    FROM first_hit, (SELECT unnest(['lang', 'source', 'text']) AS c)
""")
def pii_value_scan(t: Tables) -> DataFrame:
    return P.scan_columns(t.documents, "doc_id", columns=["lang", "source", "text"])


def _scan_sql(table: str, order: str, columns: Sequence[str]) -> str:
    """Rows (c, kind, n): the type found first by value in each column of a table, and the rows of the table."""
    parts = [f"SELECT '{c}' AS c, arg_min(kind, row(place, kind)) FILTER (kind IS NOT NULL) AS kind, count(*) AS n FROM ("
             f"SELECT {order} AS place, {KIND_SQL} AS kind FROM (SELECT {order}, CAST({c} AS VARCHAR) AS text FROM {table}))" for c in columns]
    return " UNION ALL ".join(parts)


LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                "l_linestatus")


@query("pii_columns", f"""
    WITH found AS ({_scan_sql("lineitem", "l_orderkey", LINE_COLUMNS)})
    SELECT c AS "column", CAST(NULL AS VARCHAR) AS by_name, kind AS by_value, kind AS pii_type, n AS scanned_rows FROM found
    UNION ALL SELECT c, k, NULL, k, n FROM (SELECT count(*) AS n FROM lineitem), (VALUES ('l_comment_email', 'email'), ('l_shipdate', 'ip_address')) v(c, k)
""")
def pii_columns(t: Tables) -> DataFrame:
    """Every column of the table by name, and by value where its name says nothing."""
    return P.scan_columns(t.lineitem.withColumn("l_comment_email", F.lit("-")), "l_orderkey")


@query("classify_tables", f"""
    WITH d AS ({_scan_sql("documents", "doc_id", ("doc_id", "text", "lang", "source", "n_chars"))}),
    c AS ({_scan_sql("customer", "c_custkey", ("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"))}),
    l AS ({_scan_sql("labels", "doc_id", ("doc_id", "quality", "toxic"))}),
    p AS ({_scan_sql("part", "p_partkey", ("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice"))}),
    named AS (
        SELECT 'documents' AS source_id, 'public' AS level, c, kind, n FROM d
        UNION ALL SELECT 'customer', 'public', c, kind, n FROM c UNION ALL SELECT 'customer', 'public', 'c_name', 'name', count(*) FROM customer
        UNION ALL SELECT 'labels', 'public', c, kind, n FROM l
        UNION ALL SELECT 'part', 'internal', c, kind, n FROM p UNION ALL SELECT 'part', 'internal', 'p_name', 'name', count(*) FROM part)
    SELECT source_id, CASE WHEN level = 'public' AND count(kind) > 0 THEN 'confidential' ELSE level END AS classification,
           coalesce(string_agg(c || ':' || kind, ',' ORDER BY c) FILTER (kind IS NOT NULL), '') AS pii, count(*) AS scanned_columns, max(n) AS scanned_rows
    FROM named GROUP BY source_id, level
""")
def classify_tables(t: Tables) -> DataFrame:
    public = {"classification": "Public"}
    found = [
        P.classify(t.documents, "documents", "doc_id", public),
        P.classify(t.customer, "customer", "c_custkey", public),
        P.classify(t.labels, "labels", "doc_id", public),
        P.classify(t.part, "part", "p_partkey", {"classification": "secret"}),
    ]
    entries = F.transform(F.map_entries("pii_fields"), lambda e: F.concat(e.key, F.lit(":"), e.value))
    result = found[0]
    for one in found[1:]:
        result = result.unionByName(one)
    return result.select("source_id", "classification", F.array_join(entries, ",").alias("pii"),
                         "scanned_columns", "scanned_rows")


# ---------------------------------------------------------------- lineage


def _lineage_events(t: Tables) -> tuple[DataFrame, DataFrame]:
    """One run per event: users read a feed per event type and write to a lake table."""
    key = F.col("event_id").cast("string")
    feed = L.dataset_ref(F.lit("api"), F.concat(F.lit("feed-"), F.col("event_type")))
    user = L.dataset_ref(F.lit("users"), F.concat(F.lit("u"), F.col("user_id")))
    table = L.dataset_ref(
        F.lit("lake"), F.concat(F.lit("raw/"), F.col("event_type")),
        F.when(F.col("event_type") == "purchase", F.to_json(F.struct(F.struct(F.lit("shop").alias("source_id")).alias("source"))))
        .otherwise("{}"))
    report = L.dataset_ref(F.lit("lake"), F.concat(F.lit("report/"), F.col("user_id") % 10))
    reads_table = F.col("value") > 400
    runs = t.events.select(
        key.alias("run_id"), F.concat(F.lit("ingest:"), F.col("event_type")).alias("job_name"),
        F.col("ts").cast("timestamp").alias("started_at"),
        F.when(reads_table, F.array(table)).otherwise(F.array(feed, user)).alias("inputs"),
        F.when(reads_table, F.array(report)).otherwise(F.array(table)).alias("outputs"))
    # Every run was tried before, with another job and other inputs; only its last start counts.
    retried = runs.withColumns({"job_name": F.lit("stale"), "inputs": F.array(L.dataset_ref(F.lit("users"), F.lit("stale"))), "started_at": F.col("started_at") - F.expr("INTERVAL 1 MINUTE")})
    starts = L.start_events(runs.unionByName(retried))
    failed = F.col("value") < 20
    ends = t.events.select(
        key.alias("run_id"), F.when(failed, "FAIL").otherwise("COMPLETE").alias("event_type"),
        (F.col("ts").cast("timestamp") + F.expr("INTERVAL 5 SECONDS")).alias("event_time"),
        F.when(reads_table, F.array(report)).otherwise(F.array(table)).alias("outputs"),
        F.lit(None).cast("string").alias("facets"),
        F.when(failed, F.concat(F.lit("value "), F.col("value").cast("string"))).alias("error_message"))
    return starts, L.end_events(starts, ends)


@query("lineage_complete", """
    SELECT CASE WHEN value < 20 THEN 'FAIL' ELSE 'COMPLETE' END AS event_type, CAST(event_id AS VARCHAR) AS run_id,
           'ingest:' || event_type AS job_name,
           CASE WHEN value > 400 THEN 'lake:raw/' || event_type
                ELSE 'api:feed-' || event_type || ',users:u' || user_id END AS inputs,
           CASE WHEN value < 20 THEN '' WHEN value > 400 THEN 'lake:report/' || (user_id % 10)
                ELSE 'lake:raw/' || event_type END AS outputs,
           CASE WHEN value < 20 THEN '{"errorMessage":"value ' || CAST(value AS VARCHAR) || '"}' ELSE '{}' END AS facets
    FROM events
""")
def lineage_complete(t: Tables) -> DataFrame:
    _, ends = _lineage_events(t)
    keys = {r: F.array_join(F.transform(r, L.dataset_key), ",").alias(r) for r in ("inputs", "outputs")}
    return ends.select("event_type", "run_id", "job_name", keys["inputs"], keys["outputs"], "facets")


@query("lineage_neighbors", """
    SELECT DISTINCT 'upstream' AS direction, d AS dataset FROM (
        SELECT unnest(['api:feed-purchase', 'users:u' || user_id]) AS d FROM events
        WHERE event_type = 'purchase' AND value BETWEEN 20 AND 400)
    UNION ALL
    SELECT DISTINCT 'downstream', 'lake:report/' || (user_id % 10) FROM events
    WHERE event_type = 'purchase' AND value > 400
""")
def lineage_neighbors(t: Tables) -> DataFrame:
    starts, ends = _lineage_events(t)
    return L.neighbors(starts.unionByName(ends), "shop")


@query("lineage_facets", """
    SELECT 'lake' AS namespace, 'orders' AS name, count(*) AS row_count, count(*) - count(o_orderstatus) AS null_count,
           count(DISTINCT o_orderstatus) AS unique_count, count(DISTINCT o_totalprice) AS unique_prices, count(DISTINCT o_orderdate) AS unique_dates,
           'o_orderkey' AS first_field, 'bigint' AS first_type, 'o_orderpriority' AS last_field, 'derive' AS second_step, 'shop' AS source_id
    FROM (SELECT o_totalprice, o_orderdate, nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders)
""")
def lineage_facets(t: Tables) -> DataFrame:
    orders = t.orders.withColumn("o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    ref = L.dataset_with_facets(orders, "lake", "orders", profile=quality_profile(orders),
                                steps=["filter", "derive"], source_id="shop")

    def at(path: str):
        return F.get_json_object("facets", path)

    return ref.select(
        "namespace", "name",
        at("$.dataQuality.rowCount").cast("bigint").alias("row_count"),
        at("$.dataQuality.nullCounts.o_orderstatus").cast("bigint").alias("null_count"),
        at("$.dataQuality.uniqueCounts.o_orderstatus").cast("bigint").alias("unique_count"),
        at("$.dataQuality.uniqueCounts.o_totalprice").cast("bigint").alias("unique_prices"),
        at("$.dataQuality.uniqueCounts.o_orderdate").cast("bigint").alias("unique_dates"),
        at("$.schema.fields[5].name").alias("last_field"), at("$.schema.fields[0].name").alias("first_field"), at("$.schema.fields[0].type").alias("first_type"),
        at("$.transform.steps[1]").alias("second_step"), at("$.source.source_id").alias("source_id"))


@query("lineage_json", """
    SELECT CAST(event_id AS VARCHAR) AS run_id, CASE WHEN value < 20 THEN 'FAIL' ELSE 'COMPLETE' END AS kind,
           strftime(ts + INTERVAL 5 SECOND, '%Y-%m-%dT%H:%M:%S.%fZ') AS at, 'ingest:' || event_type AS job,
           CASE WHEN value > 400 THEN 'raw/' || event_type ELSE 'feed-' || event_type END AS first_input,
           CASE WHEN value < 20 THEN 'value ' || CAST(value AS VARCHAR) END AS error
    FROM events
""")
def lineage_json(t: Tables) -> DataFrame:
    _, ends = _lineage_events(t)

    shape = ("struct<eventType:string,eventTime:string,run:struct<runId:string>,inputs:array<struct<name:string>>,"
             "job:struct<name:string,facets:struct<errorMessage:string>>>")
    read = with_once(L.lineage_json(ends), "e", F.from_json("json", shape))
    return read.select(
        F.col("e.run.runId").alias("run_id"), F.col("e.eventType").alias("kind"), F.col("e.eventTime").alias("at"),
        F.col("e.job.name").alias("job"), F.get("e.inputs", 0)["name"].alias("first_input"),
        F.col("e.job.facets.errorMessage").alias("error"))


# ---------------------------------------------------------------- discovery


def _json_records(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    body = F.concat(
        F.lit('{"id":'), F.col("event_id"), F.lit(',"reading":'),
        F.when(kind == "error", "null").when(kind == "view", '"n/a"').when(kind == "click", "12")
        .otherwise(F.concat(F.col("value").cast("string"))),
        F.when(kind == "signup", F.lit(',"tags":["a"],"ok":true')).otherwise(F.lit("")),
        F.lit(',"props":'), F.col("props"), F.lit("}"))
    return t.events.select("event_type", body.alias("body"))


@query("infer_json_schema", """
    WITH k AS (
        SELECT 'id' AS key, 'integer' AS kind FROM events
        UNION ALL SELECT 'props', 'object' FROM events
        UNION ALL SELECT 'tags', 'array' FROM events WHERE event_type = 'signup'
        UNION ALL SELECT 'ok', 'boolean' FROM events WHERE event_type = 'signup'
        UNION ALL SELECT 'reading', CASE event_type WHEN 'error' THEN 'null' WHEN 'view' THEN 'string'
            WHEN 'click' THEN 'integer' ELSE 'number' END FROM events)
    SELECT key, string_agg(DISTINCT kind, ',' ORDER BY kind) AS types, bool_or(kind = 'null') AS nullable FROM k GROUP BY 1
""")
def inferred_schema(t: Tables) -> DataFrame:
    return infer_json_schema(_json_records(t), "body").select(
        "key", F.array_join("types", ",").alias("types"), "nullable")


@query("merged_schema", """
    SELECT 'OBJECT<id: BIGINT, ' || CASE WHEN bool_or(event_type = 'signup') THEN 'ok: BOOLEAN, ' ELSE '' END
        || 'props: OBJECT<k: BIGINT>, reading: ' || CASE WHEN bool_or(event_type = 'view') AND bool_or(event_type IN ('click', 'signup', 'purchase'))
        THEN 'VARIANT' ELSE 'STRING' END || CASE WHEN bool_or(event_type = 'signup') THEN ', tags: ARRAY<STRING>' ELSE '' END
        || '>' AS schema
    FROM events
""")
def merged(t: Tables) -> DataFrame:
    return merged_schema(_json_records(t), "body")


@query("estimate_volume", """
    SELECT event_type, CASE event_type WHEN 'click' THEN max(event_id) WHEN 'view' THEN max(event_id)
        WHEN 'error' THEN max(event_id) + 1 WHEN 'signup' THEN 50 * count(*) ELSE 0 END AS estimate
    FROM events GROUP BY 1
""")
def volume(t: Tables) -> DataFrame:
    kind, key = F.col("event_type"), F.col("event_id").cast("string")
    body = (
        F.when(kind == "click", F.concat(F.lit('{"totalHits":'), key, F.lit("}")))
        .when(kind == "view", F.concat(F.lit('{"totalHits":"'), key, F.lit('"}')))
        .when(kind == "error", F.lit('{"totalHits":1}'))
        .when(kind == "signup", F.lit('{"totalHits":"many"}')).otherwise(F.lit("[]")))
    bodies = t.events.select(
        "event_type", whole_json(body).alias("body"),
        F.when(kind == "error", F.col("event_id") + 1).alias("stated"))
    sample = F.when(F.col("event_type") == "purchase", 0).otherwise(1)
    return estimate_volume(bodies, "event_type", "body", total_field="totalHits", sample_size=sample,
                           stated_total=F.col("stated"))


# ---------------------------------------------------------------- run logs


def _run_log(t: Tables) -> DataFrame:
    """One ingestion run per event."""
    kind = F.col("event_type")
    errors = F.when(kind == "error", F.array(
        F.concat(F.lit("Poll HTTP "), F.col("user_id")), F.lit("Read Timeout on http"), F.lit("bad CONFIG"), F.lit(" ")
    )).when(kind == "view", F.array(F.lit("403 Forbidden"), F.lit("disk full"))).otherwise(F.array().cast("array<string>"))
    return t.events.select(
        F.col("event_id").alias("run_id"), F.concat(F.lit("user-"), F.col("user_id")).alias("source_id"),
        kind.alias("source_type"), (F.col("event_id") % 7 - 1).alias("records"),
        (F.col("value") / 10 - 1).alias("seconds"), F.col("ts").alias("started_at"),
        F.when(kind == "click", " RAW ").when(kind == "view", "curated").when(kind == "error", "")
        .otherwise("Archive").alias("zone"), errors.alias("errors"),
        (F.col("event_id") % 5).alias("passed"), (F.col("event_id") % 3).alias("failed"), "value")


@query("rollup_counters", """
    SELECT 'user-' || user_id AS source_id, event_type AS source_type,
           CAST(sum(greatest(event_id % 7 - 1, 0)) AS BIGINT) AS records FROM events GROUP BY 1, 2
""")
def rollup_counters(t: Tables) -> DataFrame:
    return R.counter(_run_log(t), ["source_id", "source_type"], {"records": "records"})


@query("rollup_storage", """
    SELECT CASE event_type WHEN 'click' THEN 'raw' WHEN 'view' THEN 'curated' WHEN 'error' THEN 'unknown' ELSE 'archive' END AS zone,
           count(*) AS writes, CAST(sum(greatest(event_id % 7 - 1, 0)) AS BIGINT) AS bytes_written
    FROM events GROUP BY 1
""")
def rollup_storage(t: Tables) -> DataFrame:
    return R.storage_writes(_run_log(t), "zone", "records")


@query("rollup_histogram", """
    WITH d AS (SELECT event_type AS source_type, value / 10 - 1 AS s FROM events WHERE value / 10 - 1 >= 0),
    b AS (SELECT unnest([0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0, 120.0]) AS bound,
                 unnest(['0.005', '0.01', '0.025', '0.05', '0.1', '0.25', '0.5', '1', '2.5', '5', '10', '30', '60', '120']) AS le)
    SELECT source_type, le, count(*) FILTER (s <= CAST(bound AS DOUBLE)) AS bucket_count, count(*) AS total_count,
           round(sum(s), 4) AS total_seconds FROM d, b GROUP BY 1, 2
    UNION ALL SELECT source_type, 'inf', count(*), count(*), round(sum(s), 4) FROM d GROUP BY 1
""")
def rollup_histogram(t: Tables) -> DataFrame:
    return R.duration_histogram(_run_log(t), ["source_type"], "seconds").withColumn(
        "total_seconds", F.round("total_seconds", 4))


@query("classify_errors", """
    SELECT 'user-' || user_id AS source_id, error_type, count(*) AS errors FROM (
        SELECT user_id, unnest(['http', 'timeout', 'configuration', 'unknown']) AS error_type FROM events WHERE event_type = 'error'
        UNION ALL SELECT user_id, unnest(['auth', 'generic']) FROM events WHERE event_type = 'view') GROUP BY 1, 2
""")
def classify_errors(t: Tables) -> DataFrame:
    return R.error_counts(_run_log(t), ["source_id"], "errors")


@query("rollup_quality", """
    SELECT 'user-' || user_id AS source_id, CAST(sum(event_id % 5) AS BIGINT) AS passed,
           CAST(sum(event_id % 3) AS BIGINT) AS failed, arg_max(value, (ts, event_id)) AS latest_pass_rate FROM events GROUP BY 1
""")
def rollup_quality(t: Tables) -> DataFrame:
    return R.quality_totals(_run_log(t), "source_id", "passed", "failed", "value", "started_at", "run_id")


@query("recent_runs", """
    SELECT event_id AS run_id, 'user-' || user_id AS source_id, (SELECT count(*) FROM events) AS total_runs
    FROM events ORDER BY ts DESC, event_id DESC LIMIT 20
""")
def latest_runs(t: Tables) -> DataFrame:
    return recent_runs(_run_log(t), "started_at", "run_id").select("run_id", "source_id", "total_runs")
