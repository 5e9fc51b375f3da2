import json

import pytest
from helpers import values

from millrace.plans.flow import FlowError, gate_table, load_spec, plan_flow, validate_spec, validate_steps
from millrace.plans.job import run_job
from millrace.plans.shipped import BRACKETS, ENRICHMENT


def test_steps_in_order(products):
    flow = plan_flow(products, [
        {"type": "filter", "where": "price > 0.6"},
        {"type": "rename", "mappings": {"qty": "quantity"}},
        {"type": "cast", "columns": {"quantity": "double"}},
        {"type": "derive", "new_column": "total", "expression": "price * quantity"},
        {"type": "aggregate", "group_by": ["category"], "measures": [{"column": "total", "function": "sum", "alias": "s"}]},
        {"type": "quality_gate", "checks": [{"type": "not_null", "columns": ["s"]}, {"type": "row_count", "min": 1}]},
    ])
    assert values(flow.df) == [("dairy", 240.0), ("fruit", 150.0), ("meat", 300.0), ("veg", 120.0)]
    report = flow.report()
    assert (report["rows_in"], report["rows_out"], report["quality_violations"]) == (5, 4, [])


def test_gate_reports_without_dropping(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 0.0), ("a", 1.0), (" ", 99.0)], "name string, price double")
    flow = plan_flow(df, [{"type": "quality_gate", "checks": [
        {"type": "not_null", "columns": ["name", "price"]}, {"type": "valid_range", "column": "price", "min": 0.5, "max": 50},
        {"type": "unique_key", "columns": ["name", "price"]}, {"type": "row_count", "min": 5, "max": 3}]}])
    assert flow.df.count() == 4
    found = flow.violations()
    assert found == [
        {"check": 0, "rule": "not_null", "column": None, "failed": 1}, {"check": 0, "rule": "not_null", "column": "name", "failed": 1},
        {"check": 1, "rule": "valid_range", "column": None, "failed": 2}, {"check": 2, "rule": "unique_key", "column": None, "failed": 1},
        {"check": 3, "rule": "row_count", "column": None, "failed": 1}]


def test_gate_table_matches(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 1)], "k string, v int")
    checks = [{"type": "unique_key", "columns": ["k"], "count_nulls": True}, {"type": "row_count", "min": 1}]
    assert values(gate_table(df, checks)) == [("0:unique_key", 2), ("1:row_count", 0)]


def test_join_step_by_table_and_path(spark, products, tmp_path):
    tax = spark.createDataFrame([("fruit", 0.1)], "category string, tax double")
    step = {"type": "join", "right_source": "tax", "on": ["category"], "how": "left"}
    assert plan_flow(products, [step], tables={"tax": tax}).df.filter("tax IS NOT NULL").count() == 2
    (tmp_path / "tax.csv").write_text("category,tax\nfruit,0.1\nveg,0.2\n")
    step = {"type": "join", "right_source": str(tmp_path / "tax.csv"), "on": ["category"]}
    assert plan_flow(products, [step]).df.count() == 3


def test_validation_messages():
    messages = validate_steps([
        {"type": "join", "right_source": "x", "on": [], "how": "sideways"},
        {"type": "aggregate", "group_by": [], "measures": [{"column": "x", "function": "median", "alias": "m"}]},
        {"type": "flatten", "column": "x", "into": []},
        {"type": "quality_gate", "checks": [{"type": "odd"}, {"type": "not_null"}, {"type": "valid_range"}, {"type": "unique_key"}]},
        {"type": "pivot"}, {"type": "filter"},
    ])
    assert len(messages) == 10 and "step 1 (join): on is empty" in messages
    assert validate_steps(BRACKETS["steps"]) == validate_steps(ENRICHMENT["steps"]) == []


def test_spec_messages():
    assert validate_spec(BRACKETS) == validate_spec(ENRICHMENT) == []
    assert validate_spec({"steps": [{"type": "filter"}], "output": {"table": "t"}}) == [
        "specification: the setting transform_id is missing", "specification: the setting source is missing",
        "output: the setting format is missing", "step 1 (filter): the setting condition is missing"]


def test_filters_reach_the_scan(products, tmp_path):
    products.write.parquet(f"{tmp_path}/p")
    df = products.sparkSession.read.parquet(f"{tmp_path}/p")
    flow = plan_flow(df, [{"type": "filter", "where": "price > 0.6"},
                          {"type": "join", "right_source": "d", "on": ["category"]}], tables={"d": df.selectExpr("category", "qty AS n").distinct()})
    plan = flow.df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(price,0.6)" in plan
    assert flow.df.count() and flow.report()["rows_in"] == 5


def test_unknown_step_is_an_error(products):
    with pytest.raises(FlowError):
        plan_flow(products, [{"type": "pivot"}])


def test_shipped_brackets(spark):
    rows = [("A", "20000000", "1", "5"), ("B", "2000000", "1", "5"), ("C", "3000000", "1", "5"), ("D", "10", "1", "5")]
    df = spark.createDataFrame(rows, "NAME string, P1_001N string, P1_002N string, B19013_001E string")
    assert values(plan_flow(df, BRACKETS["steps"]).df) == [("large", 20000000, 1), ("medium", 5000000, 2), ("small", 10, 1)]


def test_shipped_enrichment(spark):
    df = spark.createDataFrame(
        [("x", 2.0, [("fat", 4.0, "g"), ("salt", 8.0, "g")]), ("y", 1.0, None)],
        "food_category string, serving_size double, nutrients array<struct<nutrient_name:string,nutrient_value:double,unit:string>>")
    assert values(plan_flow(df, ENRICHMENT["steps"]).df) == [("x", 6.0, 8.0, 2.0, 3.0)]


@pytest.mark.parametrize("suffix", ["json", "yaml"])
def test_job_from_spec_file(spark, products, tmp_path, suffix):
    spec = {"transform_id": "t", "steps": [{"type": "filter", "where": "qty >= 100"}, {"type": "quality_gate", "checks": [
        {"type": "valid_range", "column": "price", "max": 1.0}]}], "output": {"partition_by": ["category"]}}
    if suffix == "yaml":
        pytest.importorskip("yaml")
    path = tmp_path / f"spec.{suffix}"
    path.write_text(json.dumps(spec))  # JSON is also YAML
    products.write.mode("overwrite").json(f"{tmp_path}/in")
    report = run_job(spark, load_spec(str(path)), f"{tmp_path}/in", f"{tmp_path}/out", input_format="jsonl")
    assert (report["rows_in"], report["rows_out"]) == (5, 3)
    assert report["quality_violations"] == [{"check": 0, "rule": "valid_range", "column": None, "failed": 1}]
    assert values(spark.read.parquet(f"{tmp_path}/out"), "name") == [("Apple",), ("Banana",), ("Carrot",)]
