"""The shipped flows on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.steps import aggregate_rows, join_tables
from millrace.plans.flow import plan_flow, validate_spec
from millrace.plans.registry import Tables, query
from millrace.plans.queries_steps import line_measures
from millrace.plans.shipped import BRACKETS, ENRICHMENT


def bracket_input(t: Tables) -> DataFrame:
    """Customers shaped like census rows: every value is text."""
    people = F.round(F.col("c_acctbal") * 2000).cast("bigint")
    return t.customer.select(
        F.col("c_name").alias("NAME"),
        people.cast("string").alias("P1_001N"),
        F.col("c_nationkey").cast("string").alias("P1_002N"),
        F.col("c_custkey").cast("string").alias("B19013_001E"),
    )


@query("flow_brackets", """
    WITH c AS (SELECT c_name, CAST(round(c_acctbal * 2000) AS BIGINT) AS population FROM customer)
    SELECT CASE WHEN population > 10000000 THEN 'large' WHEN population > 1000000 THEN 'medium' ELSE 'small' END
               AS population_bracket,
           CAST(sum(population) AS BIGINT) AS total_pop, count(c_name) AS state_count
    FROM c GROUP BY 1
""")
def flow_brackets(t: Tables) -> DataFrame:
    return plan_flow(bracket_input(t), BRACKETS["steps"]).df


@query("flow_enrichment", """
    WITH f AS (SELECT l_returnflag AS food_category, l_quantity AS serving_size,
                      unnest([l_quantity, l_discount, l_tax]) AS v
               FROM lineitem WHERE l_linestatus = 'F')
    SELECT food_category, round(avg(v), 6) AS avg_nutrient, max(v) AS max_nutrient,
           round(avg(serving_size), 6) AS serving_size, round(avg(v) / avg(serving_size), 6) AS nutrient_density
    FROM f GROUP BY 1
""")
def flow_enrichment(t: Tables) -> DataFrame:
    payloads = line_measures(t).withColumnsRenamed(
        {"l_returnflag": "food_category", "l_quantity": "serving_size"})
    df = plan_flow(payloads, ENRICHMENT["steps"]).df
    rounded = {c: F.round(c, 6) for c in ("avg_nutrient", "serving_size", "nutrient_density")}
    return df.withColumns(rounded)


@query("flow_join", """
    SELECT c_mktsegment, count(o_orderkey) AS orders, count(*) AS all_rows, max(o_totalprice) AS top
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey WHERE c_acctbal > 0 GROUP BY 1
""")
def flow_join(t: Tables) -> DataFrame:
    steps = [
        {"type": "filter", "condition": "c_acctbal > 0"},
        {"type": "rename", "mappings": {"c_custkey": "o_custkey"}},
        {"type": "join", "right_source": f"{t.folder}/orders.parquet", "on": ["o_custkey"], "how": "left_outer"},
        {"type": "aggregate", "group_by": ["c_mktsegment"], "measures": [
            {"column": "o_orderkey", "function": "count", "alias": "orders"},
            {"column": "*", "function": "count", "alias": "all_rows"},
            {"column": "o_totalprice", "function": "max", "alias": "top"}]},
    ]
    return plan_flow(t.customer, steps).df


@query("flow_report", """
    SELECT count(*) AS rows_in, count(*) FILTER (o_totalprice > 100000) AS rows_out,
           '0:valid_range:' || count(*) FILTER (o_totalprice > 400000) || ',1:unique_key:' || (
               SELECT count(*) FROM (SELECT o_custkey FROM orders WHERE o_totalprice > 100000 GROUP BY 1 HAVING count(*) > 1)) AS failed
    FROM orders
""")
def flow_report(t: Tables) -> DataFrame:
    flow = plan_flow(t.orders, [
        {"type": "filter", "where": "o_totalprice > 100000"},
        {"type": "quality_gate", "checks": [{"type": "valid_range", "column": "o_totalprice", "max": 400000},
                                            {"type": "unique_key", "columns": ["o_custkey"]}, {"type": "row_count", "min": 1}]}])
    flow.df.write.format("noop").mode("overwrite").save()
    report = flow.report()
    failed = ",".join(f"{v['check']}:{v['rule']}:{v['failed']}" for v in report["quality_violations"])
    return t.spark.createDataFrame([(report["rows_in"], report["rows_out"], failed)], "rows_in long, rows_out long, failed string")


@query("refused_steps", """
    SELECT v.*, n FROM (VALUES
        ('join without keys', 'join needs at least one key column'), ('unknown aggregate', 'refused'), ('unknown join', 'refused'),
        ('specification', 'specification: the setting transform_id is missing'), ('specification', 'output: the setting format is missing'),
        ('specification', 'step 1 (fold): there is no such step'), ('specification', 'step 2 (aggregate), measures 1: there is no such aggregate'),
        ('specification', 'step 3 (join): on is empty'), ('specification', 'step 4 (quality_gate), checks 1: a not_null check names its columns')
    ) v(what, outcome), (SELECT count(*) AS n FROM orders)
""")
def refused_steps(t: Tables) -> DataFrame:
    """Steps and specifications that cannot run are refused before any row is read."""
    tries = {
        "join without keys": lambda: join_tables(t.orders, t.customer, []),
        "unknown aggregate": lambda: aggregate_rows(t.orders, ["o_orderstatus"], [{"column": "o_totalprice", "function": "median of means", "alias": "m"}]),
        "unknown join": lambda: join_tables(t.orders, t.customer.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"], "sideways"),
    }
    told = []
    for what, attempt in tries.items():
        try:
            attempt()
            told.append((what, "accepted"))
        except ValueError as exc:
            told.append((what, str(exc) if "keys" in what else "refused"))
    spec = {"source": "orders", "output": {"table": "t"}, "steps": [
        {"type": "fold"}, {"type": "aggregate", "group_by": [], "measures": [{"column": "o_totalprice", "function": "mode"}]},
        {"type": "join", "right_source": "customer", "on": []}, {"type": "quality_gate", "checks": [{"type": "not_null"}]}]}
    told += [("specification", problem) for problem in validate_spec(spec)]
    rows = F.array(*[F.struct(F.lit(w).alias("what"), F.lit(o).alias("outcome")) for w, o in told])
    return t.orders.agg(F.count(F.lit(1)).alias("n")).select(F.explode(rows).alias("r"), "n").select("r.*", "n")
