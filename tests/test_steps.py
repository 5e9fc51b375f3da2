import pytest
from helpers import values
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators import steps as S


def test_filter_by_sql_text(products):
    assert S.filter_rows(products, "price > 1.0 AND (category = 'fruit' OR qty < 50)").count() == 2
    assert S.filter_rows(products, "  ").count() == 5


@pytest.mark.parametrize("op, value, expected", [
    ("=", None, [2]), ("!=", None, [1, 3]), ("=", 5, [1]), ("<>", 5, [2, 3]), (">", 4, [1, 3]), ("<=", 5, [1]),
])
def test_null_safe_comparison(spark, op, value, expected):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "id int, x int")
    kept = S.filter_rows(df, [{"column": "x", "op": op, "value": value}], null_safe=True)
    assert [r.id for r in kept.orderBy("id").collect()] == expected


def test_null_tests_and_column_comparison(spark):
    df = spark.createDataFrame([(1, 5, 5), (2, None, None), (3, 9, 4)], "id int, `a b` int, y int")
    assert S.filter_rows(df, [{"column": "a b", "op": "IS  NULL"}]).first().id == 2
    same = S.filter_rows(df, [{"column": "a b", "op": "=", "other": "y"}], null_safe=True)
    assert values(same, "id") == [(1,), (2,)]
    with pytest.raises(ValueError):
        S.filter_rows(df, [{"column": "y", "op": "~", "value": 1}])


def test_mixed_values_compare_false(spark):
    df = spark.createDataFrame([("7",), ("abc",), (None,), (" 12 ",), ("1d",)], "x string")
    assert values(S.filter_rows(df, [{"column": "x", "op": ">", "value": 5, "numeric": True}])) == [(" 12 ",), ("7",)]


def test_rename_swap_collision_and_missing(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert S.rename_columns(df, {"a": "b", "b": "a", "zz": "y"}).first().asDict() == {"b": 1, "a": 2, "c": 3}
    assert S.rename_columns(df, {"a": "c"}).first().asDict() == {"c": 1, "b": 2}


def test_casts(spark):
    df = spark.createDataFrame([("42", "3.14", "yes"), ("7", "2.0", "off")], "count string, amount string, active string")
    out = S.cast_columns(df, {"count": "int", "amount": "float", "active": "bool", "none": "int"}, lenient=True)
    assert out.dtypes == [("count", "bigint"), ("amount", "double"), ("active", "boolean")]
    assert values(out) == [(42, 3.14, True), (7, 2.0, False)]
    assert S.cast_columns(df, {"amount": "decimal(10,1)"}).dtypes[1] == ("amount", "decimal(10,1)")
    bad = spark.createDataFrame([("x",)], "count string")
    assert S.cast_columns(bad, {"count": "int"}, lenient=True).first()[0] is None
    with pytest.raises(PySparkException):
        S.cast_columns(bad, {"count": "int"}).collect()


def test_derive(products):
    assert S.derive_column(products, "total", "price * qty").filter("name = 'Apple'").first().total == 150.0
    assert S.derive_column(products, "url", "concat('http://', name)").filter("name = 'Milk'").first().url == "http://Milk"
    for text in ("price ** 2", "qty // 3"):
        with pytest.raises(ValueError):
            S.derive_column(products, "x", text)


def test_flatten_structs_drops_empty(spark):
    df = spark.createDataFrame(
        [(1, [("a", 1.0), ("b", None)]), (2, []), (3, None)], "id int, xs array<struct<n:string,v:double>>")
    assert values(S.flatten_array(df, "xs", ["n", "v", "gone"])) == [(1, "a", 1.0, None), (1, "b", None, None)]
    kept = S.flatten_array(df, "xs", ["n"], outer=True)
    assert kept.columns == ["id", "xs", "n"] and kept.count() == 4


def test_flatten_other_elements(spark):
    nested = spark.createDataFrame([(1, [["a", "b"], ["c"]])], "id int, xs array<array<string>>")
    assert values(S.flatten_array(nested, "xs", ["p", "q"])) == [(1, "a", "b"), (1, "c", None)]
    maps = spark.createDataFrame([(1, [{"k": 1}, {}])], "id int, xs array<map<string,int>>")
    assert values(S.flatten_array(maps, "xs", ["k"])) == [(1, 1), (1, None)]
    scalars = spark.createDataFrame([(9, [1, 2])], "x int, xs array<int>")
    assert values(S.flatten_array(scalars, "xs", ["x"])) == [(1,), (2,)]
    with pytest.raises(ValueError):
        S.flatten_array(scalars, "xs", ["a", "b"])
    with pytest.raises(ValueError):
        S.flatten_array(scalars, "xs", [])
    with pytest.raises(ValueError):
        S.flatten_array(scalars, "x", ["a"])


def test_aggregate(spark, products):
    out = S.aggregate_rows(products, ["category"], [
        {"column": "price", "function": "sum", "alias": "s"}, {"column": "price", "function": "Mean", "alias": "m"},
        {"column": "*", "function": "count", "alias": "n"}])
    assert (out.filter("category = 'fruit'").first()[1:]) == (2.0, 1.0, 2)
    nulls = spark.createDataFrame([(None, None), (None, 2), ("a", None)], "k string, v int")
    out = S.aggregate_rows(nulls, ["k"], [
        {"column": "v", "function": "sum", "alias": "s"}, {"column": "v", "function": "count", "alias": "c"}])
    assert values(out) == [("a", None, 0), (None, 2, 1)]
    empty = S.aggregate_rows(nulls.filter("false"), [], [{"column": "", "function": "count", "alias": "n"}])
    assert empty.first().n == 0
    with pytest.raises(ValueError):
        S.aggregate_rows(products, [], [{"column": "price", "function": "median", "alias": "m"}])


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame([(1, "l1", "x"), (2, "l2", "y"), (None, "l3", "z")], "k int, v string, a string")
    right = spark.createDataFrame([(1, "r1", 10), (1, None, 11), (3, "r3", 12), (None, "r4", 13)], "k int, v string, b int")
    return left, right


@pytest.mark.parametrize("how, null_safe, expected", [
    ("inner", False, [(1, "r1", "x", 10), (1, None, "x", 11)]),
    ("inner", True, [(1, "r1", "x", 10), (1, None, "x", 11), (None, "r4", "z", 13)]),
    ("left_outer", False, [(1, "r1", "x", 10), (1, None, "x", 11), (2, "l2", "y", None), (None, "l3", "z", None)]),
    ("right", False, [(1, "r1", "x", 10), (1, None, "x", 11), (3, "r3", None, 12), (None, "r4", None, 13)]),
    ("full outer", False, [(1, "r1", "x", 10), (1, None, "x", 11), (2, "l2", "y", None), (None, "l3", "z", None),
                           (3, "r3", None, 12), (None, "r4", None, 13)]),
    ("full", True, [(1, "r1", "x", 10), (1, None, "x", 11), (2, "l2", "y", None), (3, "r3", None, 12),
                    (None, "r4", "z", 13)]),
])
def test_joins_right_value_wins(sides, how, null_safe, expected):
    out = S.join_tables(*sides, ["k"], how, null_safe=null_safe)
    assert values(out, "k", "v", "a", "b") == sorted(expected, key=repr)


def test_semi_anti_and_errors(sides):
    left, right = sides
    assert values(S.join_tables(left, right, ["k"], "semi")) == [(1, "l1", "x")]
    assert values(S.join_tables(left, right, ["k"], "anti")) == [(2, "l2", "y"), (None, "l3", "z")]
    with pytest.raises(ValueError):
        S.join_tables(left, right, [])
    with pytest.raises(ValueError):
        S.join_tables(left, right, ["k"], "sideways")


def test_filter_and_columns_reach_the_scan(spark, tmp_path):
    spark.range(100).select("id", (F.col("id") * 2).alias("twice"), F.lit("x").alias("unused")).write.parquet(f"{tmp_path}/t")
    df = S.aggregate_rows(S.filter_rows(spark.read.parquet(f"{tmp_path}/t"), "id > 90"), [], [
        {"column": "twice", "function": "sum", "alias": "s"}])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,90)" in plan and "unused" not in plan
