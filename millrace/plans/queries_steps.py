"""Queries over the row-shaping steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import floor_div, floor_mod, luhn_valid, power, iso_epoch
from millrace.operators import steps as S
from millrace.operators.ordering import priority_order
from millrace.plans.registry import Tables, query


SHIFT = 50  # moves the keys of all orders, so that both sides of a join have rows without a match


def _orders_of_customers(t: Tables) -> DataFrame:
    """Customers with the orders of a customer some numbers before, and nulls where there are none."""
    large = t.orders.select(
        (F.col("o_custkey") + SHIFT).alias("c_custkey"), "o_orderkey", "o_orderstatus", "o_totalprice")
    return S.join_tables(t.customer.select("c_custkey", "c_acctbal"), large, ["c_custkey"], "left")


LARGE = f"""
    FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey + {SHIFT}
"""


@query("filter_basic", """
    SELECT l_orderkey, l_partkey, l_quantity, l_discount FROM lineitem
    WHERE l_quantity >= 45 AND l_discount < 0.02 AND l_returnflag <> 'N'
""")
def filter_basic(t: Tables) -> DataFrame:
    kept = S.filter_rows(t.lineitem, "l_quantity >= 45 AND l_discount < 0.02D AND l_returnflag <> 'N'")
    return kept.select("l_orderkey", "l_partkey", "l_quantity", "l_discount")


@query("filter_null_safe", f"""
    SELECT c.c_custkey, o.o_orderkey, o.o_orderstatus {LARGE} WHERE o.o_orderstatus IS DISTINCT FROM 'F'
""")
def filter_null_safe(t: Tables) -> DataFrame:
    tests = [{"column": "o_orderstatus", "op": "!=", "value": "F"}]
    return S.filter_rows(_orders_of_customers(t), tests, null_safe=True).select(
        "c_custkey", "o_orderkey", "o_orderstatus")


@query("filter_nulls", f"""
    SELECT c.c_custkey, c.c_acctbal {LARGE} WHERE o.o_orderkey IS NULL AND c.c_acctbal IS NOT NULL
""")
def filter_nulls(t: Tables) -> DataFrame:
    return S.filter_rows(_orders_of_customers(t), "`o_orderkey` IS NULL AND c_acctbal IS NOT NULL").select(
        "c_custkey", "c_acctbal")


@query("filter_boolean", """
    SELECT p_partkey, p_name, p_size FROM part
    WHERE (p_size < 10 OR p_type = 'ECONOMY') AND NOT (p_brand IN ('Brand#2', 'Brand#17'))
      AND p_name LIKE '%ring%' AND p_retailprice BETWEEN 900 AND 2000.5
""")
def filter_boolean(t: Tables) -> DataFrame:
    condition = (
        "(p_size < 10 OR p_type = 'ECONOMY') AND NOT (p_brand IN ('Brand#2', 'Brand#17')) "
        "AND p_name LIKE '%ring%' AND p_retailprice BETWEEN 900 AND 2000.5"
    )
    return S.filter_rows(t.part, condition).select("p_partkey", "p_name", "p_size")


@query("filter_mixed_types", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS reading
    FROM events WHERE event_type <> 'error' AND value > 250.5
""")
def filter_mixed_types(t: Tables) -> DataFrame:
    mixed = t.events.select("event_id", F.when(F.col("event_type") == "error", "n/a")
                            .otherwise(F.col("value").cast("string")).alias("reading"))
    return S.filter_rows(mixed, [{"column": "reading", "op": ">", "value": 250.5, "numeric": True}])


@query("rename_cols", """
    SELECT c_nationkey AS c_custkey, c_custkey AS c_nationkey, c_name AS label, c_acctbal, c_mktsegment FROM customer
""")
def rename_cols(t: Tables) -> DataFrame:
    return S.rename_columns(t.customer, {
        "c_custkey": "c_nationkey", "c_nationkey": "c_custkey", "c_name": "label", "absent": "other"})


@query("cast_types", """
    SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
           CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
           o_orderpriority
    FROM orders
""")
def cast_types(t: Tables) -> DataFrame:
    return S.cast_columns(t.orders, {
        "o_orderkey": "float", "o_custkey": "varchar", "o_totalprice": "int", "o_orderdate": "date", "absent": "int"})


@query("cast_bool_lenient", """
    SELECT event_id, CASE event_type WHEN 'click' THEN TRUE WHEN 'view' THEN TRUE WHEN 'error' THEN NULL
                     ELSE FALSE END AS flag,
           CASE WHEN event_type = 'signup' THEN NULL ELSE event_id END AS number
    FROM events
""")
def cast_bool_lenient(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    texts = t.events.select(
        "event_id",
        F.when(kind == "click", "YES").when(kind == "view", "1").when(kind == "purchase", "maybe")
        .when(kind == "signup", "f").alias("flag"),
        F.when(kind == "signup", "12x").otherwise(F.col("event_id").cast("string")).alias("number"),
    )
    return S.cast_columns(texts, {"flag": "bool", "number": "int"}, lenient=True)


@query("derive_arith", """
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
           -l_quantity AS returned, l_extendedprice / l_quantity AS unit_price
    FROM lineitem
""")
def derive_arith(t: Tables) -> DataFrame:
    df = S.derive_column(t.lineitem, "charge", "l_extendedprice * (1 - l_discount) * (1 + l_tax)")
    df = S.derive_column(df, "returned", "-l_quantity")
    df = S.derive_column(df, "unit_price", "l_extendedprice / l_quantity")
    return df.select("l_orderkey", "l_linenumber", "charge", "returned", "unit_price")


@query("derive_floor_mod", """
    WITH c AS (SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer)
    SELECT c_custkey, CAST(floor(cents / 7) AS BIGINT) AS whole, cents - 7 * CAST(floor(cents / 7) AS BIGINT) AS rest,
           CAST(floor(cents / -7) AS BIGINT) AS whole_neg,
           cents + 7 * CAST(floor(cents / -7) AS BIGINT) AS rest_neg,
           floor(cents / 2.5) AS whole_real
    FROM c
""")
def derive_floor_mod(t: Tables) -> DataFrame:
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    seven, minus = F.lit(7).cast("bigint"), F.lit(-7).cast("bigint")
    df = S.derive_column(t.customer, "cents", cents)
    c = F.col("cents")
    for name, column in {
        "whole": floor_div(c, seven, integral=True), "rest": floor_mod(c, seven),
        "whole_neg": floor_div(c, minus, integral=True), "rest_neg": floor_mod(c, minus),
        "whole_real": floor_div(c, F.lit(2.5)),
    }.items():
        df = S.derive_column(df, name, column)
    return df.select("c_custkey", "whole", "rest", "whole_neg", "rest_neg", "whole_real")


@query("derive_power", """
    SELECT event_id, round(power(value, 2), 4) AS squared, round(power(value, 0.5), 6) AS root FROM events
""")
def derive_power(t: Tables) -> DataFrame:
    df = S.derive_column(t.events, "squared", "round(power(value, 2), 4)")
    df = S.derive_column(df, "root", F.round(power(F.col("value"), F.lit(0.5)), 6))
    return df.select("event_id", "squared", "root")


@query("derive_case_bracket", """
    SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'large' WHEN c_acctbal > 1000 THEN 'medium'
                           WHEN c_acctbal > 0 THEN 'small' END AS bracket
    FROM customer
""")
def derive_case_bracket(t: Tables) -> DataFrame:
    return S.derive_column(
        t.customer, "bracket",
        "CASE WHEN c_acctbal > 5000 THEN 'large' WHEN c_acctbal > 1000 THEN 'medium' "
        "WHEN c_acctbal > 0 THEN 'small' END",
    ).select("c_custkey", "bracket")


def line_measures(t: Tables) -> DataFrame:
    """Line items with their measures nested as an array of structs, built inside each row."""
    def measure(name: str, column: str, unit: str):
        return F.struct(F.lit(name).alias("nutrient_name"), F.col(column).alias("nutrient_value"),
                        F.lit(unit).alias("unit"))
    nested = F.array(measure("quantity", "l_quantity", "ea"), measure("discount", "l_discount", "share"),
                     measure("tax", "l_tax", "share"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity",
                             F.when(F.col("l_linestatus") == "F", nested).alias("nutrients"))


@query("flatten_structs", """
    SELECT l_orderkey, l_linenumber, 'quantity' AS nutrient_name, l_quantity AS nutrient_value, CAST(NULL AS VARCHAR) AS absent
    FROM lineitem WHERE l_linestatus = 'F'
    UNION ALL SELECT l_orderkey, l_linenumber, 'discount', l_discount, NULL FROM lineitem WHERE l_linestatus = 'F'
    UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_tax, NULL FROM lineitem WHERE l_linestatus = 'F'
""")
def flatten_structs(t: Tables) -> DataFrame:
    rows = S.flatten_array(line_measures(t), "nutrients", ["nutrient_name", "nutrient_value", "absent"])
    return rows.select("l_orderkey", "l_linenumber", "nutrient_name", "nutrient_value",
                       F.col("absent").cast("string").alias("absent"))


@query("flatten_positional", """
    SELECT o_orderkey, 'status' AS label, o_orderstatus AS text FROM orders
    UNION ALL SELECT o_orderkey, o_orderpriority, NULL FROM orders
""")
def flatten_positional(t: Tables) -> DataFrame:
    nested = F.array(F.array(F.lit("status"), "o_orderstatus"), F.array("o_orderpriority"))
    return S.flatten_array(t.orders.select("o_orderkey", nested.alias("pairs")), "pairs", ["label", "text"])


@query("flatten_scalars", """
    SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings
""")
def flatten_scalars(t: Tables) -> DataFrame:
    rows = S.flatten_array(t.embeddings, "embedding", ["x"])
    return rows.select("vec_id", "label", F.col("x").cast("double").alias("x"))


@query("flatten_outer", """
    WITH w AS (SELECT p_partkey, [x FOR x IN string_split(p_name, ' ') IF length(x) > 4] AS words FROM part)
    SELECT p_partkey, unnest(words) AS word FROM w
    UNION ALL SELECT p_partkey, NULL FROM w WHERE len(words) = 0
""")
def flatten_outer(t: Tables) -> DataFrame:
    words = F.transform(F.filter(F.split("p_name", " "), lambda w: F.length(w) > 4),
                        lambda w: F.struct(w.alias("word")))
    rows = S.flatten_array(t.part.select("p_partkey", words.alias("words")), "words", ["word"], outer=True)
    return rows.select("p_partkey", "word")


# ---------------------------------------------------------------- aggregates


@query("agg_sum", """
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price
    FROM lineitem GROUP BY 1, 2
""")
def agg_sum(t: Tables) -> DataFrame:
    df = S.aggregate_rows(t.lineitem, ["l_returnflag", "l_linestatus"], [
        {"column": "l_quantity", "function": "sum", "alias": "sum_qty"},
        {"column": "l_extendedprice", "function": "sum", "alias": "sum_price"}])
    return df.withColumn("sum_price", F.round("sum_price", 2))


@query("agg_avg_mean", """
    SELECT l_suppkey, avg(l_quantity) AS avg_qty, avg(l_quantity) AS mean_qty FROM lineitem GROUP BY 1
""")
def agg_avg_mean(t: Tables) -> DataFrame:
    return S.aggregate_rows(t.lineitem, ["l_suppkey"], [
        {"column": "l_quantity", "function": "avg", "alias": "avg_qty"},
        {"column": "l_quantity", "function": "MEAN", "alias": "mean_qty"}])


@query("agg_min_max", """
    SELECT o_custkey, min(o_totalprice) AS low, max(o_totalprice) AS high, max(o_orderpriority) AS last_priority
    FROM orders GROUP BY 1
""")
def agg_min_max(t: Tables) -> DataFrame:
    return S.aggregate_rows(t.orders, ["o_custkey"], [
        {"column": "o_totalprice", "function": "min", "alias": "low"},
        {"column": "o_totalprice", "function": "max", "alias": "high"},
        {"column": "o_orderpriority", "function": "max", "alias": "last_priority"}])


@query("agg_count", f"""
    SELECT o.o_orderstatus, count(o.o_orderkey) AS orders, count(*) AS all_rows {LARGE} GROUP BY 1
""")
def agg_count(t: Tables) -> DataFrame:
    return S.aggregate_rows(_orders_of_customers(t), ["o_orderstatus"], [
        {"column": "o_orderkey", "function": "count", "alias": "orders"},
        {"column": "*", "function": "count", "alias": "all_rows"}])


@query("agg_global", """
    SELECT sum(l_quantity) AS sum_qty, count(*) AS all_rows, min(l_tax) AS low_tax FROM lineitem WHERE l_quantity > 10
""")
def agg_global(t: Tables) -> DataFrame:
    return S.aggregate_rows(t.lineitem.filter("l_quantity > 10"), [], [
        {"column": "l_quantity", "function": "sum", "alias": "sum_qty"},
        {"column": "", "function": "count", "alias": "all_rows"},
        {"column": "l_tax", "function": "min", "alias": "low_tax"}])


# ---------------------------------------------------------------- joins


def _customers(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount"))


def _orders(t: Tables) -> DataFrame:
    return t.orders.select(
        (F.col("o_custkey") + SHIFT).alias("custkey"), "o_orderkey", F.col("o_totalprice").alias("amount"))


CUSTOMERS = "(SELECT c_custkey AS custkey, c_name AS name, c_acctbal AS amount FROM customer) l"
ORDERS = f"(SELECT o_custkey + {SHIFT} AS custkey, o_orderkey, o_totalprice AS amount FROM orders) r"


@query("join_inner", """
    SELECT l_orderkey, l_linenumber, l_quantity, o_custkey, o_totalprice
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def join_inner(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity")
    orders = t.orders.select(
        F.col("o_orderkey").alias("orderkey"), "o_custkey", "o_totalprice")
    return S.join_tables(lines, orders, ["orderkey"]).withColumnRenamed("orderkey", "l_orderkey")


@query("join_left", f"SELECT l.custkey, l.name, r.o_orderkey FROM {CUSTOMERS} LEFT JOIN {ORDERS} ON l.custkey = r.custkey")
def join_left(t: Tables) -> DataFrame:
    return S.join_tables(_customers(t), _orders(t), ["custkey"], "left outer").select("custkey", "name", "o_orderkey")


@query("join_right", f"SELECT r.custkey, l.name, r.o_orderkey FROM {CUSTOMERS} RIGHT JOIN {ORDERS} ON l.custkey = r.custkey")
def join_right(t: Tables) -> DataFrame:
    return S.join_tables(_customers(t), _orders(t), ["custkey"], "right").select("custkey", "name", "o_orderkey")


@query("join_full", f"""
    SELECT coalesce(l.custkey, r.custkey) AS custkey, l.name, r.o_orderkey
    FROM {CUSTOMERS} FULL JOIN {ORDERS} ON l.custkey = r.custkey
""")
def join_full(t: Tables) -> DataFrame:
    return S.join_tables(_customers(t), _orders(t), ["custkey"], "full_outer").select("custkey", "name", "o_orderkey")


@query("join_collision", f"""
    SELECT coalesce(l.custkey, r.custkey) AS custkey, l.name, r.o_orderkey,
           CASE WHEN r.custkey IS NOT NULL THEN r.amount ELSE l.amount END AS amount
    FROM {CUSTOMERS} FULL JOIN {ORDERS} ON l.custkey = r.custkey
""")
def join_collision(t: Tables) -> DataFrame:
    return S.join_tables(_customers(t), _orders(t), ["custkey"], "outer").select("custkey", "name", "o_orderkey", "amount")


@query("join_semi", f"SELECT l.custkey, l.name FROM {CUSTOMERS} WHERE l.custkey IN (SELECT custkey FROM {ORDERS})")
def join_semi(t: Tables) -> DataFrame:
    return S.join_tables(_customers(t), _orders(t), ["custkey"], "left_semi").select("custkey", "name")


@query("join_anti", f"SELECT l.custkey, l.name FROM {CUSTOMERS} WHERE l.custkey NOT IN (SELECT custkey FROM {ORDERS})")
def join_anti(t: Tables) -> DataFrame:
    return S.join_tables(_customers(t), _orders(t), ["custkey"], "left_anti").select("custkey", "name")


@query("join_null_safe", """
    WITH l AS (SELECT event_id, nullif(event_type, 'error') AS kind FROM events),
         r AS (SELECT nullif(event_type, 'error') AS kind, count(*) AS n FROM events GROUP BY 1)
    SELECT l.event_id, l.kind, r.n FROM l JOIN r ON l.kind IS NOT DISTINCT FROM r.kind
""")
def join_null_safe(t: Tables) -> DataFrame:
    left = t.events.select("event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("kind"))
    right = S.aggregate_rows(left, ["kind"], [{"column": "*", "function": "count", "alias": "n"}])
    return S.join_tables(left, right, ["kind"], null_safe=True).select("event_id", "kind", "n")


# ---------------------------------------------------------------- order and scalar functions


@query("priority_order", """
    SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority FROM orders
    ORDER BY priority, o_orderkey
""")
def order_by_priority(t: Tables) -> DataFrame:
    commands = t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"))
    return priority_order(commands, "priority", "o_orderkey")


@query("luhn_check", """
    WITH d AS (SELECT o_orderkey, '4' || lpad(CAST(o_orderkey * 7919 AS VARCHAR), 15, '0') AS card FROM orders),
    s AS (SELECT o_orderkey, card, list_sum([
        CASE WHEN i % 2 = 0 THEN
            CASE WHEN 2 * CAST(substr(reverse(card), i, 1) AS INTEGER) > 9
                 THEN 2 * CAST(substr(reverse(card), i, 1) AS INTEGER) - 9
                 ELSE 2 * CAST(substr(reverse(card), i, 1) AS INTEGER) END
        ELSE CAST(substr(reverse(card), i, 1) AS INTEGER) END FOR i IN range(1, 17)]) AS total FROM d)
    SELECT o_orderkey, total % 10 = 0 AS valid, FALSE AS too_short FROM s
""")
def luhn_check(t: Tables) -> DataFrame:
    card = F.concat(F.lit("4"), F.lpad((F.col("o_orderkey") * 7919).cast("string"), 15, "0"))
    spaced = F.regexp_replace(card, r"(\d{4})", "$1 ")
    return t.orders.select("o_orderkey", luhn_valid(spaced).alias("valid"),
                           luhn_valid(F.substring(card, 1, 12)).alias("too_short"))


@query("parse_event_time", """
    SELECT event_id, CASE event_type WHEN 'error' THEN NULL
        WHEN 'click' THEN floor(epoch_us(ts) / 1000000.0) - 7200
        WHEN 'view' THEN floor(epoch_us(ts) / 86400000000.0) * 86400
        ELSE epoch_us(ts) / 1000000.0 END AS seconds
    FROM events
""")
def parse_event_time(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "error", F.lit("not a time"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )
    return t.events.select("event_id", iso_epoch(text).alias("seconds"))
