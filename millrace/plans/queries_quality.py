"""Queries over data-quality checks and profiles."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from millrace.operators.profile import SKETCH_ERROR, merged_profile, null_profile, profile_sketches, quality_profile
from millrace.operators.quality import evaluate_checks, gate, parse_checks, sample_failures, violations
from millrace.plans.flow import gate_table
from millrace.plans.registry import Tables, query
from millrace.session import scratch_dir

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)


def _gappy_events(t: Tables) -> DataFrame:
    """Events with a null, a blank and a malformed text among the good ones."""
    kind = F.col("event_type")
    return t.events.select(
        "event_id", "user_id",
        F.when(kind == "error", F.lit(None)).when(kind == "view", F.lit(" \t")).otherwise(kind).alias("kind"),
        F.when(kind == "signup", "n/a").when(kind != "click", F.col("value").cast("string")).alias("reading"),
        F.when(kind == "purchase", "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("at"),
    )


GAPPY = """
    gappy AS (SELECT event_id, user_id,
        CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN ' ' ELSE event_type END AS kind,
        CASE WHEN event_type = 'signup' THEN 'n/a' WHEN event_type <> 'click' THEN CAST(value AS VARCHAR) END AS reading,
        CASE WHEN event_type = 'purchase' THEN NULL ELSE date_trunc('second', ts) END AS happened
    FROM events)
"""


@query("dq_not_null", f"""
    WITH {GAPPY}, n AS (
        SELECT 'kind' AS "column", count(*) FILTER (kind IS NULL OR trim(kind) = '') AS failed_count FROM gappy
        UNION ALL SELECT 'reading', count(*) FILTER (reading IS NULL) FROM gappy
        UNION ALL SELECT 'event_id', count(*) FILTER (event_id IS NULL) FROM gappy)
    SELECT 'not_null' AS check_type, "column", 'critical' AS severity, failed_count, failed_count > 0 AS violated FROM n
""")
def dq_not_null(t: Tables) -> DataFrame:
    checks = [{"type": "non_null", "fields": ["kind", "reading", "event_id"]}]
    return evaluate_checks(_gappy_events(t), checks).drop("check_id", "message")


@query("dq_valid_range", f"""
    WITH {GAPPY}, n AS (
        SELECT 'reading' AS "column", 'warning' AS severity, count(*) FILTER (reading IS NOT NULL AND (
            try_cast(reading AS DOUBLE) IS NULL OR try_cast(reading AS DOUBLE) < 5 OR try_cast(reading AS DOUBLE) > 400
        )) AS failed_count FROM gappy
        UNION ALL SELECT 'user_id', 'critical', count(*) FILTER (user_id < 0) FROM gappy)
    SELECT 'valid_range' AS check_type, "column", severity, failed_count, failed_count > 0 AS violated FROM n
""")
def dq_valid_range(t: Tables) -> DataFrame:
    checks = [{"type": "valid_range", "field": "reading", "min": 5, "max": 400},
              {"type": "valid_range", "column": "user_id", "min": 0, "severity": "critical"}]
    return evaluate_checks(_gappy_events(t), checks).drop("check_id", "message")


@query("dq_unique_key", """
    WITH k AS (
        SELECT 'conv_id,turn' AS "column", count(*) - count(DISTINCT (conv_id, turn)) AS failed_count FROM conversations
        UNION ALL
        SELECT 'conv_id,role', count(*) - count(DISTINCT (conv_id, role)) FROM conversations WHERE role <> 'user')
    SELECT 'unique_key' AS check_type, "column", 'critical' AS severity, failed_count, failed_count > 0 AS violated FROM k
""")
def dq_unique_key(t: Tables) -> DataFrame:
    gaps = t.conversations.withColumn("role", F.nullif(F.col("role"), F.lit("user")))
    both = evaluate_checks(t.conversations, [{"type": "unique_key", "columns": ["conv_id", "turn"]}])
    with_nulls = evaluate_checks(gaps, [{"type": "unique_key", "columns": ["conv_id", "role"]}])
    return both.unionByName(with_nulls).drop("check_id", "message")


@query("dq_row_count", """
    SELECT 'row_count' AS check_type, CAST(NULL AS VARCHAR) AS "column", 'critical' AS severity,
           CAST(CASE WHEN n BETWEEN 1 AND 1000000000000 THEN 0 ELSE 1 END AS BIGINT) AS failed_count,
           n NOT BETWEEN 1 AND 1000000000000 AS violated FROM (SELECT count(*) AS n FROM lineitem)
    UNION ALL
    SELECT 'row_count', NULL, 'warning', CASE WHEN n <= 10 THEN 0 ELSE 1 END, n > 10 FROM (SELECT count(*) AS n FROM lineitem)
""")
def dq_row_count(t: Tables) -> DataFrame:
    checks = [{"type": "row_count", "min_rows": 1, "max_rows": 1_000_000_000_000},
              {"type": "row_count", "max_rows": 10, "severity": "warning"}]
    return evaluate_checks(t.lineitem, checks).drop("check_id", "message")


@query("dq_regex", """
    WITH n AS (
        SELECT 'url' AS "column", 'warning' AS severity,
               count(*) FILTER (NOT regexp_matches(url, '^https://[a-z.]+/')) AS failed_count,
               count(*) FILTER (NOT regexp_matches(url, '^https://[a-z.]+/')) > 0 AS violated FROM pages
        UNION ALL SELECT 'page_id', 'warning', count(*) FILTER (NOT regexp_matches(CAST(page_id AS VARCHAR), '^[0-9]+$')),
               count(*) FILTER (NOT regexp_matches(CAST(page_id AS VARCHAR), '^[0-9]+$')) > 0 FROM pages
        UNION ALL SELECT 'html', 'critical', 0, TRUE)
    SELECT 'regex_match' AS check_type, "column", severity, failed_count, violated FROM n
""")
def dq_regex(t: Tables) -> DataFrame:
    checks = [{"type": "regex_match", "column": "url", "pattern": "^https://[a-z.]+/"},
              {"type": "regex_match", "column": "page_id", "regex": "^[0-9]+$"},
              {"type": "regex_match", "column": "html", "pattern": "(unclosed"}]
    return evaluate_checks(t.pages, checks).drop("check_id", "message")


@query("dq_freshness", f"""
    WITH {GAPPY}, n AS (
        SELECT 'ts' AS "column", count(*) FILTER (ts < TIMESTAMP '2024-01-31' - INTERVAL 10 DAY) AS failed_count FROM events
        UNION ALL
        SELECT 'at', count(*) FILTER (happened IS NULL OR happened < TIMESTAMP '2024-01-31' - INTERVAL 12 HOUR - INTERVAL 30 MINUTE) FROM gappy)
    SELECT 'freshness' AS check_type, "column", 'warning' AS severity, failed_count, failed_count > 0 AS violated FROM n
""")
def dq_freshness(t: Tables) -> DataFrame:
    clock = evaluate_checks(t.events, [{"type": "freshness", "column": "ts", "max_age_hours": 240}], as_of=AS_OF)
    texts = evaluate_checks(_gappy_events(t), [{"type": "freshness", "column": "at", "max_age_hours": 12.5}], as_of=AS_OF)
    return clock.unionByName(texts).drop("check_id", "message")


@query("dq_referential", """
    WITH n AS (
        SELECT 'l_orderkey' AS "column", count(*) AS failed_count FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 20000)
        UNION ALL
        SELECT 'l_partkey', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT l_suppkey FROM lineitem))
    SELECT 'referential' AS check_type, "column", 'critical' AS severity, failed_count, failed_count > 0 AS violated FROM n
""")
def dq_referential(t: Tables) -> DataFrame:
    checks = [
        {"type": "referential", "child_column": "l_orderkey", "parent": "orders", "parent_column": "o_orderkey"},
        {"type": "referential", "fk_column": "l_partkey", "pk_column": "l_suppkey"},
    ]
    parents = {"orders": t.orders.filter("o_totalprice > 20000")}
    return evaluate_checks(t.lineitem, checks, parents=parents).drop("check_id", "message")


@query("dq_custom_sql", """
    SELECT 'custom_sql' AS check_type, CAST(NULL AS VARCHAR) AS "column", 'critical' AS severity,
           count(*) AS failed_count, count(*) > 0 AS violated
    FROM (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING sum(o_totalprice) > 3500000)
    UNION ALL SELECT 'custom_sql', NULL, 'warning', count(*), count(*) > 0 FROM orders WHERE o_totalprice < 0
""")
def dq_custom_sql(t: Tables) -> DataFrame:
    checks = [
        {"type": "custom_sql", "sql": "SELECT o_custkey FROM {data} GROUP BY o_custkey HAVING sum(o_totalprice) > 3500000"},
        {"type": "custom_sql", "sql": "SELECT * FROM {data} WHERE o_totalprice < 0", "severity": "warning"},
    ]
    return evaluate_checks(t.orders, checks).drop("check_id", "message")


ORDER_CHECKS = [
    {"type": "not_null", "columns": ["o_orderkey", "o_custkey"]},
    {"type": "valid_range", "column": "o_totalprice", "min": 2000, "max": 490000},
    {"type": "unique_key", "columns": ["o_orderkey"]},
    {"type": "row_count", "min_rows": 1},
    {"type": "regex_match", "column": "o_orderpriority", "pattern": "^[1-5]-"},
    {"type": "freshness", "column": "o_orderdate", "max_age_hours": 24 * 365 * 40},
    {"type": "no_such_check"},
]


@query("dq_gate", """
    WITH o AS (SELECT
        count(*) FILTER (o_orderkey IS NULL OR o_custkey IS NULL) > 0 AS not_null,
        count(*) FILTER (o_totalprice < 2000 OR o_totalprice > 490000) > 0 AS valid_range,
        count(*) > count(DISTINCT o_orderkey) AS unique_key, count(*) < 1 AS row_count,
        count(*) FILTER (NOT regexp_matches(o_orderpriority, '^[1-5]-')) > 0 AS regex_match,
        count(*) FILTER (o_orderdate < TIMESTAMP '2024-01-31' - INTERVAL 14600 DAY) > 0 AS freshness FROM orders),
    n AS (SELECT CAST(not_null AS BIGINT) + CAST(valid_range AS BIGINT) + CAST(unique_key AS BIGINT)
        + CAST(row_count AS BIGINT) + CAST(regex_match AS BIGINT) + CAST(freshness AS BIGINT) AS failed,
        not_null OR unique_key OR row_count AS critical FROM o)
    SELECT 'orders' AS source_id, CAST(6 AS BIGINT) AS checks_run, 6 - failed AS checks_passed, failed AS checks_failed,
           round((6 - failed) / 6.0, 6) AS pass_rate, NOT critical AND (6 - failed) / 6.0 >= 0.95 AS passed_gate
    FROM n
""")
def dq_gate(t: Tables) -> DataFrame:
    checks = parse_checks(ORDER_CHECKS)
    return gate(evaluate_checks(t.orders, checks, as_of=AS_OF), len(checks), "orders")


@query("dq_violations", """
    SELECT 'valid_range' AS check_type, 'o_totalprice' AS "column", 'warning' AS severity, n AS failed_count,
           'o_totalprice has values out of range' AS message
    FROM (SELECT count(*) FILTER (o_totalprice < 2000 OR o_totalprice > 490000) AS n FROM orders) WHERE n > 0
""")
def dq_violations(t: Tables) -> DataFrame:
    return violations(evaluate_checks(t.orders, ORDER_CHECKS, as_of=AS_OF)).drop("check_id")


@query("sample_failures", """
    WITH f AS (
        SELECT 'valid_range' AS check_type, 'o_totalprice' AS "column", CAST(o_totalprice AS VARCHAR) AS value
        FROM orders WHERE o_totalprice > 490000
        UNION ALL SELECT 'regex_match', 'o_orderpriority', o_orderpriority FROM orders
        WHERE NOT regexp_matches(o_orderpriority, '^[1-3]-')),
    r AS (SELECT *, row_number() OVER (PARTITION BY check_type ORDER BY value) AS rank FROM f)
    SELECT check_type, "column", value, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5
""")
def sampled_failures(t: Tables) -> DataFrame:
    checks = [{"type": "valid_range", "column": "o_totalprice", "max": 490000},
              {"type": "regex_match", "column": "o_orderpriority", "pattern": "^[1-3]-"}]
    return sample_failures(t.orders, checks).drop("check_id")


@query("flow_gate", f"""
    WITH {GAPPY}
    SELECT '0:not_null' AS measure, count(*) FILTER (kind IS NULL OR reading IS NULL) AS failed FROM gappy
    UNION ALL SELECT '0:not_null:kind', count(*) FILTER (kind IS NULL) FROM gappy
    UNION ALL SELECT '0:not_null:reading', count(*) FILTER (reading IS NULL) FROM gappy
    UNION ALL SELECT '1:valid_range', count(*) FILTER (user_id < 10 OR user_id > 100) FROM gappy
    UNION ALL SELECT '2:unique_key', count(*) FROM (SELECT 1 FROM gappy WHERE kind IS NOT NULL
        GROUP BY user_id, kind HAVING count(*) > 1)
    UNION ALL SELECT '3:row_count', CASE WHEN count(*) > 100 THEN 1 ELSE 0 END FROM gappy
""")
def flow_gate(t: Tables) -> DataFrame:
    df = _gappy_events(t).withColumn("kind", F.when(F.trim(F.regexp_replace("kind", r"\s", "")) == "", " ")
                                     .otherwise(F.col("kind")))
    return gate_table(df, [
        {"type": "not_null", "columns": ["kind", "reading"]},
        {"type": "valid_range", "column": "user_id", "min": 10, "max": 100},
        {"type": "unique_key", "columns": ["user_id", "kind"]},
        {"type": "row_count", "min": 0, "max": 100},
    ])


@query("profile_nulls", """
    WITH e AS (SELECT event_id, nullif(event_type, 'error') AS kind, CASE WHEN value > 10 THEN value END AS value FROM events)
    SELECT 'event_id' AS "column", count(*) AS row_count, CAST(3 AS BIGINT) AS column_count, count(*) - count(event_id) AS null_count FROM e
    UNION ALL SELECT 'kind', count(*), 3, count(*) - count(kind) FROM e
    UNION ALL SELECT 'value', count(*), 3, count(*) - count(value) FROM e
""")
def profile_nulls(t: Tables) -> DataFrame:
    return null_profile(t.events.select(
        "event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("kind"),
        F.when(F.col("value") > 10, F.col("value")).alias("value")))


@query("profile_facet", """
    SELECT 'lang' AS "column", count(*) AS row_count, count(*) - count(lang) AS null_count, count(DISTINCT lang) AS unique_count FROM documents
    UNION ALL SELECT 'source', count(*), count(*) - count(source), count(DISTINCT source) FROM documents
    UNION ALL SELECT 'doc_id', count(*), count(*) - count(doc_id), count(DISTINCT doc_id) FROM documents
    UNION ALL SELECT 'n_chars', count(*), count(*) - count(n_chars), count(DISTINCT n_chars) FROM documents
    UNION ALL SELECT 'text', count(*), count(*) - count(text), count(DISTINCT text) FROM documents
""")
def profile_facet(t: Tables) -> DataFrame:
    return quality_profile(t.documents, ["doc_id", "text", "lang", "source", "n_chars"])


@query("profile_facet_merged", """
    SELECT 'o_orderkey' AS "column", count(*) AS row_count, count(*) - count(o_orderkey) AS null_count, true AS close FROM orders
    UNION ALL SELECT 'o_custkey', count(*), count(*) - count(o_custkey), true FROM orders
    UNION ALL SELECT 'o_orderstatus', count(*), count(*) - count(o_orderstatus), true FROM orders
    UNION ALL SELECT 'o_totalprice', count(*), count(*) - count(o_totalprice), true FROM orders
    UNION ALL SELECT 'o_orderdate', count(*), count(*) - count(o_orderdate), true FROM orders
    UNION ALL SELECT 'o_orderpriority', count(*), count(*) - count(o_orderpriority), true FROM orders
""")
def profile_facet_merged(t: Tables) -> DataFrame:
    """Sketches kept per partition of a table, merged; distinct counts must lie within their stated error of the exact ones."""
    columns = t.orders.columns
    path = scratch_dir(t.spark, "sketches")
    profile_sketches(t.orders, columns, ["o_orderpriority"]).drop("o_orderpriority").write.parquet(path)
    merged = merged_profile(t.spark.read.parquet(path), columns)
    exact = quality_profile(t.orders, columns).select("column", F.col("unique_count").alias("exact"))
    close = F.abs(F.col("unique_count") - F.col("exact")) <= F.ceil(F.col("exact") * SKETCH_ERROR)
    return merged.join(exact, "column").select("column", "row_count", "null_count", close.alias("close"))


@query("dq_check_that_fails", """
    SELECT 'valid_range' AS check_type, 'nothing' AS "column", 'warning' AS severity, count(*) AS failed_count, true AS violated FROM orders
    UNION ALL SELECT 'unique_key', 'nothing', 'critical', count(*), true FROM orders
""")
def dq_check_that_fails(t: Tables) -> DataFrame:
    checks = [{"type": "valid_range", "column": "nothing", "min": 1, "severity": "warning"}, {"type": "unique_key", "columns": ["nothing"]}]
    return evaluate_checks(t.orders, checks, as_of=AS_OF).select("check_type", "column", "severity", "failed_count", "violated")
