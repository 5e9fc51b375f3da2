"""Queries over sources and sinks. Round trips write below the shared scratch folder."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F

from millrace.functions import json_lookup, parse_count, parse_measure, whole_json
from millrace.plans.registry import Tables, query
from millrace.session import scratch_dir
from millrace.sinks import EmptyWriteError, WriteReceipt, write_curated, write_jsonl, write_raw
from millrace.sinks.lake import overwrite_table
from millrace.sources.files import json_documents, json_elements, merge_datasets, read_table, rows_to_table
from millrace.sources.payloads import (
    BATCH_ENVELOPE_KEYS,
    FEATURE_KEYS,
    assemble_pages,
    header_rows,
    unwrap_envelope,
)
from millrace.sources.sse import parse_sse, read_sse
from millrace.streaming.streams import normalize_polls


@query("scan_parquet", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderstatus = 'F'
""")
def scan_parquet(t: Tables) -> DataFrame:
    return (
        read_table(t.spark, f"{t.folder}/orders.parquet")
        .filter("o_orderdate >= TIMESTAMP_NTZ '1997-01-01 00:00:00' AND o_orderstatus = 'F'")
        .select("o_orderkey", "o_custkey", "o_totalprice")
    )


@query("scan_csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "csv")
    t.customer.write.option("header", True).csv(path)
    return read_table(t.spark, path, "csv", schema=t.customer.schema)


@query("scan_json_array", """
    SELECT o_orderkey, o_orderstatus, o_totalprice, NULL AS doc, NULL AS corrupt FROM orders
    UNION ALL SELECT DISTINCT NULL, NULL, NULL, o_orderkey // 20000, '[{"o_orderkey":}]' FROM orders WHERE o_orderkey // 20000 % 3 = 1
""")
def scan_json_array(t: Tables) -> DataFrame:
    """Large top-level arrays, element by element; a third of the files hold an element that is broken."""
    records = F.to_json(F.collect_list(F.struct("o_orderkey", "o_orderstatus", "o_totalprice")))
    arrays = t.orders.groupBy(F.expr("o_orderkey DIV 20000").alias("doc")).agg(records.alias("text"))
    broken = F.concat(F.expr("left(text, length(text) - 1)"), F.lit(',{"o_orderkey":}]'))
    path = scratch_dir(t.spark, "arrays")
    arrays.select("doc", F.when(F.col("doc") % 3 == 1, broken).otherwise(F.col("text")).alias("value")).write.partitionBy("doc").text(path)
    read = json_elements(t.spark, path)
    typed = F.variant_get(F.col("record"), "$", "struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>")
    number = F.when(F.col("corrupt").isNotNull(), F.regexp_extract("path", "doc=([0-9]+)", 1).cast("bigint"))
    return read.select(typed.alias("r"), number.alias("doc"), "corrupt").select("r.*", "doc", "corrupt")


@query("scan_jsonl_roundtrip", """
    SELECT event_id, user_id, event_type, value, props,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text
    FROM events
""")
def scan_jsonl_roundtrip(t: Tables) -> DataFrame:
    events = t.events.select(
        "event_id", "user_id", "event_type", "value", "props",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_text"),
    )
    receipt = write_jsonl(events, scratch_dir(t.spark, "jsonl"), "events")
    return read_table(t.spark, receipt.destination, "jsonl", schema=events.schema)


@query("scan_json_doc", """
    WITH d AS (SELECT *, o_orderkey // 1000 AS doc, CASE o_orderkey // 1000 % 7 WHEN 3 THEN 'not one JSON document'
        WHEN 4 THEN 'not one JSON document' WHEN 5 THEN 'not one JSON document' WHEN 6 THEN 'neither an array nor an object' END AS problem FROM orders)
    SELECT o_orderkey, o_orderstatus, o_totalprice, NULL AS problem FROM d WHERE problem IS NULL
    UNION ALL SELECT DISTINCT doc, NULL, NULL, problem FROM d WHERE problem IS NOT NULL
""")
def scan_json_doc(t: Tables) -> DataFrame:
    # A document of at most 1,000 records each; the key is unique, so no document grows. Some have text behind
    # them, a second document, a missing end, or are a bare text.
    whole = F.to_json(F.struct(F.lit("ignored").alias("data"), F.collect_list(
        F.struct("o_orderkey", "o_orderstatus", "o_totalprice")).alias("records")))
    kind = F.col("doc") % 7
    text = F.when(kind == 3, F.concat("text", F.lit(" end"))).when(kind == 4, F.concat("text", F.lit(" "), "text")).when(
        kind == 5, F.expr("left(text, length(text) - 3)")).when(kind == 6, F.lit('"text"')).otherwise(F.col("text"))
    documents = t.orders.groupBy(F.expr("o_orderkey DIV 1000").alias("doc")).agg(whole.alias("text"))
    path = scratch_dir(t.spark, "documents")
    documents.select("doc", text.alias("value")).write.partitionBy("doc").text(path)
    read = json_documents(t.spark, path)
    record = unwrap_envelope(read.filter("problem IS NULL"), "body", keys=BATCH_ENVELOPE_KEYS)
    typed = F.variant_get(F.col("record"), "$", "struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>")
    good = record.select(typed.alias("r"), "problem").select("r.*", "problem")
    number = F.regexp_extract("path", "doc=([0-9]+)", 1).cast("bigint")
    bad = read.filter("problem IS NOT NULL").select(
        number.alias("o_orderkey"), F.lit(None).cast("string").alias("o_orderstatus"), F.lit(None).cast("double").alias("o_totalprice"), "problem")
    return good.unionByName(bad)


@query("unwrap_envelope", """
    SELECT event_id, 'list' AS part, value FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, 'twin' AS part, value FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, 'item' AS part, value FROM events WHERE event_type = 'view'
    UNION ALL SELECT event_id, 'self' AS part, value FROM events WHERE event_type = 'purchase'
    UNION ALL SELECT event_id, 'top' AS part, value FROM events WHERE event_type = 'signup'
""")
def unwrap_bodies(t: Tables) -> DataFrame:
    def record(part: str):
        return F.format_string('{"event_id":%d,"part":"' + part + '","value":%s}',
                               F.col("event_id"), F.col("value").cast("string"))

    kind = F.col("event_type")
    body = (
        F.when(kind == "click", F.concat(F.lit('{"total":2,"data":['), record("list"), F.lit(",7,"),
                                         record("twin"), F.lit("]}")))
        .when(kind == "view", F.concat(F.lit('{"results":"none","items":['), record("item"), F.lit("]}")))
        .when(kind == "error", F.lit('{"data":[],"items":[{"event_id":0}]}'))
        .when(kind == "signup", F.concat(F.lit('["x",'), record("top"), F.lit(",null]")))
        .otherwise(record("self"))
    )
    bodies = t.events.select(whole_json(body).alias("body"))
    found = unwrap_envelope(bodies, "body")
    typed = F.variant_get(F.col("record"), "$", "struct<event_id:bigint,part:string,value:double>")
    return found.select(typed.alias("r")).select("r.*")


@query("unwrap_features", """
    SELECT page_id, url FROM pages WHERE url LIKE 'https:%'
""")
def unwrap_features(t: Tables) -> DataFrame:
    secure = F.col("url").startswith("https:")
    body = F.when(secure, F.to_json(F.struct(F.array(F.struct("page_id", "url")).alias("features")))).otherwise(
        F.lit('{"title":"no features"}'))
    bodies = t.pages.select(whole_json(body).alias("body"))
    found = unwrap_envelope(bodies, "body", keys=FEATURE_KEYS, keep_body=False)
    return found.select(F.variant_get(F.col("record"), "$", "struct<page_id:bigint,url:string>").alias("r")).select("r.*")


@query("header_rows_to_table", """
    SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, c_mktsegment AS segment
    FROM customer WHERE c_acctbal >= 0
""")
def header_rows_to_table(t: Tables) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    row = F.when(F.col("c_acctbal") >= 0, F.array(key, F.lit("first"), "c_mktsegment", "c_name")).otherwise(F.array(key, "c_name"))
    # At most 100 rows per body, because the key is unique.
    bodies = t.customer.groupBy(F.expr("c_custkey DIV 100").alias("block")).agg(
        F.to_json(F.concat(
            F.array(F.array(F.lit("key"), F.lit("name"), F.lit("segment"), F.lit("name"))), F.collect_list(row)
        )).alias("body")
    )
    record = header_rows(bodies.select("body"), "body")
    return record.select(*[F.col("record")[c].alias(c) for c in ("key", "name", "segment")])


@query("header_rows_loose", """
    SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_acctbal >= 0 THEN c_name END AS name, NULL AS "row", NULL AS value
    FROM customer WHERE c_custkey // 100 % 2 = 0
    UNION ALL SELECT NULL, NULL, CAST(row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey) - 1 AS VARCHAR), CAST(c_custkey AS VARCHAR)
    FROM customer WHERE c_custkey // 100 % 2 = 1
""")
def header_rows_loose(t: Tables) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    row = F.when(F.col("c_acctbal") >= 0, F.array(key, "c_name", F.lit("beyond"))).otherwise(F.array(key))
    table = F.to_json(F.concat(F.array(F.array(F.lit("key"), F.lit("name"))), F.collect_list(row)))
    numbers = F.to_json(F.sort_array(F.collect_list("c_custkey")))
    bodies = t.customer.groupBy(F.expr("c_custkey DIV 100").alias("block")).agg(
        F.when(F.col("block") % 2 == 0, table).otherwise(numbers).alias("body"))
    record = header_rows(bodies.select("body"), "body", strict=False)
    return record.select(*[F.col("record")[c].alias(c) for c in ("key", "name", "row", "value")])


@query("in_memory_rows", """
    SELECT n_name AS name, CASE WHEN n_regionkey = 0 THEN NULL ELSE n_regionkey END AS region, count(c_custkey) AS customers
    FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2
""")
def in_memory_rows(t: Tables) -> DataFrame:
    """Rows that the driver holds (the nations, a table that does not grow) beside a table that Spark reads; a missing key is null."""
    held = [{"key": r.n_nationkey, "name": r.n_name} | ({"region": r.n_regionkey} if r.n_regionkey else {}) for r in t.nation.collect()]
    nations = rows_to_table(t.spark, held, "key int, name string, region int")
    counts = t.customer.groupBy(F.col("c_nationkey").alias("key")).agg(F.count(F.lit(1)).alias("customers"))
    return nations.join(counts, "key", "left").select("name", "region", F.coalesce("customers", F.lit(0)).alias("customers"))


@query("merge_datasets", """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL
    SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier
""")
def merge_two(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return merge_datasets([customers, suppliers])


@query("assemble_pages", """
    WITH kept AS (
        SELECT o_orderkey, o_orderkey // 5000 AS endpoint, (o_orderkey % 5000) // 50 + 1 AS page
        FROM orders WHERE o_totalprice >= 1500
    ), sizes AS (SELECT endpoint, page, count(*) AS n FROM kept GROUP BY 1, 2),
    stops AS (SELECT endpoint, min(CASE WHEN n < 50 OR page >= 90 THEN page END) AS last FROM sizes GROUP BY 1)
    SELECT k.endpoint, k.o_orderkey, k.page AS _ingest_page, 'orders' AS _ingest_query
    FROM kept k JOIN stops s ON k.endpoint = s.endpoint WHERE s.last IS NULL OR k.page <= s.last
""")
def assemble_order_pages(t: Tables) -> DataFrame:
    # At most 50 records per page, because the key is unique.
    pages = (
        t.orders.filter("o_totalprice >= 1500")
        .select("o_orderkey", F.expr("o_orderkey DIV 5000").alias("endpoint"),
                F.expr("(o_orderkey % 5000) DIV 50 + 1").alias("page"))
        .groupBy("endpoint", "page").agg(F.collect_list("o_orderkey").alias("records"))
        .withColumn("total_pages", F.lit(90))
    )
    rows = assemble_pages(
        pages, "records", endpoint=["endpoint"], page="page", page_size=50, total_pages="total_pages",
        provenance={"_ingest_query": F.lit("orders")}, into="o_orderkey",
    )
    return rows.select("endpoint", "o_orderkey", "_ingest_page", "_ingest_query")


@query("json_path", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           json_extract_string('{"a":{"b":' || props || '}}', '$.a.b.k') AS deep,
           CAST(NULL AS VARCHAR) AS missing
    FROM events
""")
def json_path(t: Tables) -> DataFrame:
    nested = F.concat(F.lit('{"a":{"b":'), F.col("props"), F.lit("}}"))
    return t.events.select(
        "event_id",
        json_lookup(F.col("props"), "k").cast("bigint").alias("k"),
        json_lookup(nested, "a.b.k").alias("deep"),
        json_lookup(F.col("props"), "k.inner").alias("missing"),
    )


@query("sse_parse", """
    SELECT event_id, value, CAST(NULL AS VARCHAR) AS scalar, CAST(NULL AS VARCHAR) AS raw,
           CAST(event_id AS VARCHAR) AS sse_id FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, value, NULL, NULL, 'own' FROM events WHERE event_type = 'view'
    UNION ALL SELECT NULL, NULL, NULL, 'broken {' || event_id, 'r' || event_id FROM events WHERE event_type = 'purchase'
    UNION ALL SELECT NULL, NULL, CAST(event_id AS VARCHAR), NULL, NULL FROM events WHERE event_type = 'signup'
    UNION ALL SELECT NULL, NULL, NULL, CASE WHEN value > 50 THEN '{"event_id":1} more' ELSE '{"event_id":1}{"event_id":2}' END, 't'
        FROM events WHERE event_type = 'error' AND value <= 100
""")
def sse_records(t: Tables) -> DataFrame:
    key, kind = F.col("event_id").cast("string"), F.col("event_type")
    fields = F.concat(F.lit('"event_id":'), key, F.lit(',\ndata:  "value":'), F.col("value").cast("string"), F.lit("}"))
    block = (
        F.when(kind == "click", F.concat(F.lit("event: x\nid: "), key, F.lit("\r\ndata: {"), fields))
        .when(kind == "view", F.concat(F.lit("id: "), key, F.lit('\ndata:{"_sse_id":"own",'), fields))
        .when(kind == "purchase", F.concat(F.lit("id: r"), key, F.lit("\ndata: broken {"), key))
        .when(kind == "signup", F.concat(F.lit(": ping\ndata: "), key))
        .when((kind == "error") & (F.col("value") <= 50), F.lit('id: t\ndata: {"event_id":1}{"event_id":2}'))
        .when((kind == "error") & (F.col("value") <= 100), F.lit('id: t\r\ndata: {"event_id":1} more'))
        .when(F.col("value") > 100, F.lit("data: [DONE]"))
        .otherwise(F.lit("id: 1\nretry: 10"))
    )
    # Half of the files end their lines with line feeds (and mix them), half with carriage returns before them.
    path = scratch_dir(t.spark, "sse")
    odd = F.col("event_id") % 2 == 1
    t.events.filter(~odd).select(block.alias("value")).write.option("lineSep", "\n\n").text(f"{path}/ends=feed")
    returned = F.regexp_replace(block, r"\r?\n", "\r\n")
    t.events.filter(odd).select(returned.alias("value")).write.option("lineSep", "\r\n\r\n").text(f"{path}/ends=return")
    parsed = parse_sse(read_sse(t.spark, path))
    return parsed.select(
        F.try_variant_get("record", "$.event_id", "bigint").alias("event_id"),
        F.try_variant_get("record", "$.value", "double").alias("value"),
        F.col("value").cast("string").alias("scalar"), "raw", F.col("_sse_id").alias("sse_id"),
    )


@query("write_raw_roundtrip", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'b1' AS batch, 'landing' AS zone FROM orders
""")
def write_raw_roundtrip(t: Tables) -> DataFrame:
    base = scratch_dir(t.spark, "raw")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    write_raw(orders, base, "orders", {"zone": "landing", "batch": "b1"})
    return t.spark.read.parquet(f"{base}/raw/orders")


@query("write_curated_roundtrip", """
    SELECT l_returnflag, l_linestatus, count(*) AS line_count,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty
    FROM lineitem GROUP BY 1, 2
""")
def write_curated_roundtrip(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_quantity", "l_returnflag", "l_linestatus")
    receipt = write_curated(lines, "sales.lines", ["l_returnflag"], base=scratch_dir(t.spark, "curated"))
    return t.spark.read.parquet(receipt.destination).groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum(F.col("l_quantity").cast("bigint")).alias("sum_qty"))


@query("normalize_observation", """
    SELECT event_id,
           CASE WHEN event_type = 'view' THEN 'OWN' ELSE 'K' || user_id END AS station_id,
           CASE WHEN event_type IN ('view', 'error') THEN '2024-02-01T00:00:00Z'
                ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS timestamp,
           CASE WHEN event_type IN ('click', 'signup') THEN value END AS temperature_c,
           CASE WHEN event_type = 'click' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS humidity,
           CAST(CASE WHEN event_type = 'click' THEN 36.0 WHEN event_type = 'purchase' THEN 4.43 END AS DOUBLE) AS wind_speed_kmh,
           CASE event_type WHEN 'click' THEN 'clear' WHEN 'view' THEN '' WHEN 'error' THEN 'fetch_error'
                ELSE 'short' END AS description,
           CASE event_type
               WHEN 'click' THEN '{"properties":{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '","temperature":{"value":' || CAST(value AS VARCHAR)
                   || '},"relativeHumidity":' || replace(props, '"k"', '"value"') || ',"windSpeed":{"value":10},"textDescription":"clear"}}'
               WHEN 'view' THEN '{"station_id":"OWN","properties":{"timestamp":12,"temperature":{"value":null}}}'
               WHEN 'purchase' THEN '{"properties":{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S')
                   || '","temperature":{"value":"n/a"},"windSpeed":{"value":"1.23"},"textDescription":"","shortForecast":"short"}}'
               WHEN 'signup' THEN '{"properties":{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '","temperature":{"value":'
                   || CAST(value AS VARCHAR) || '},"windSpeed":7,"shortForecast":"short"}}' END AS raw_observation
    FROM events
""")
def normalize_observations(t: Tables) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value").cast("string")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")

    def fill(template: str, *args):
        return F.format_string(template, *args)

    body = (
        F.when(kind == "click", fill(
            '{"properties":{"timestamp":"%s","temperature":{"value":%s},"relativeHumidity":%s,'
            '"windSpeed":{"value":10},"textDescription":"clear"}}',
            stamp, value, F.regexp_replace("props", '"k"', '"value"')))
        .when(kind == "view", F.lit('{"station_id":"OWN","properties":{"timestamp":12,"temperature":{"value":null}}}'))
        .when(kind == "purchase", fill(
            '{"properties":{"timestamp":"%s","temperature":{"value":"n/a"},"windSpeed":{"value":"1.23"},'
            '"textDescription":"","shortForecast":"short"}}', stamp))
        .when(kind == "signup", fill(
            '{"properties":{"timestamp":"%s","temperature":{"value":%s},"windSpeed":7,"shortForecast":"short"}}',
            stamp, value))
    )
    polls = t.events.select(
        "event_id", body.alias("body"), F.concat(F.lit("K"), F.col("user_id")).alias("station"),
        F.lit("2024-02-01T00:00:00Z").alias("fetched_at"))
    return normalize_polls(polls, "body", "station", "fetched_at")


@query("normalize_counts", """
    SELECT c_custkey,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey END AS population,
           CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL ELSE c_acctbal END AS rate
    FROM customer
""")
def normalize_counts(t: Tables) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    segment = F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey",
        parse_count(F.when(F.col("c_acctbal") < 0, F.concat(F.lit("-"), key)).otherwise(key)).alias("population"),
        parse_measure(F.when(segment == "BUILDING", "-").when(segment == "MACHINERY", "")
                      .otherwise(F.col("c_acctbal").cast("string"))).alias("rate"),
    )


@query("overwrite_static", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def overwrite_static(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "overwrite")
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    overwrite_table(orders, path, ["o_orderstatus"])
    overwrite_table(orders.filter("o_orderstatus = 'F'"), path, ["o_orderstatus"])
    return t.spark.read.parquet(path)


@query("overwrite_dynamic", """
    SELECT o_orderkey, o_totalprice + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS o_totalprice, o_orderstatus FROM orders
""")
def overwrite_dynamic(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "overwrite")
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    overwrite_table(orders, path, ["o_orderstatus"])
    dearer = orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    overwrite_table(dearer, path, ["o_orderstatus"], dynamic=True)
    return t.spark.read.parquet(path)


@query("overwrite_failing", "SELECT o_orderkey, o_totalprice, o_orderstatus, 'refused' AS outcome FROM orders")
def overwrite_failing(t: Tables) -> DataFrame:
    """Overwrites that fail half-way, whole or by partition, and one without rows: the table stays as it was."""
    path = scratch_dir(t.spark, "overwrite")
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    overwrite_table(orders, path, ["o_orderstatus"])
    late = F.when(F.col("o_orderkey") % 1000 == 1, F.raise_error(F.lit("half-way")).cast("double")).otherwise(0.0)
    outcome = "refused"
    for df, dynamic in ((orders.withColumn("o_totalprice", late), False), (orders.withColumn("o_totalprice", late), True), (orders.filter("false"), False)):
        try:
            overwrite_table(df, path, ["o_orderstatus"], dynamic=dynamic)
            outcome = "written"
        except (EmptyWriteError, PySparkException):
            pass
    return t.spark.read.parquet(path).withColumn("outcome", F.lit(outcome))


@query("write_receipts", """
    SELECT 'raw' AS zone, count(*) AS records_written, true AS has_bytes, 'batch=b1' AS partitions, 'parquet' AS format FROM orders
    UNION ALL SELECT 'raw, again', count(*), true, 'batch=b1', 'parquet' FROM orders
    UNION ALL SELECT 'curated', count(*), true, 'l_returnflag', 'parquet' FROM lineitem
    UNION ALL SELECT 'local curated', count(*), true, 'o_orderstatus', 'json' FROM orders
    UNION ALL SELECT 'lines', count(*), true, '', 'json' FROM nation
    UNION ALL SELECT 'empty', 0, false, 'refused', 'parquet'
""")
def write_receipts(t: Tables) -> DataFrame:
    base = scratch_dir(t.spark, "receipts")
    receipts = {
        "raw": write_raw(t.orders, base, "orders", {"batch": "b1"}),
        "raw, again": write_raw(t.orders, base, "orders", {"batch": "b1"}),
        "curated": write_curated(t.lineitem, "sales.lines", ["l_returnflag"], base=base),
        "local curated": write_curated(t.orders, "orders", ["o_orderstatus"], base=f"{base}/local", fmt="json"),
        "lines": write_jsonl(t.nation, base, "nation"),
    }
    try:
        receipts["empty"] = write_raw(t.orders.filter("false"), base, "nothing")
    except EmptyWriteError:
        receipts["empty"] = WriteReceipt("", 0, 0, ["refused"], "parquet")
    rows = [(zone, r.records_written, r.bytes_written > 0, ",".join(r.partitions), r.format) for zone, r in receipts.items()]
    return t.spark.createDataFrame(rows, "zone string, records_written long, has_bytes boolean, partitions string, format string")
