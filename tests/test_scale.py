"""What the plans must look like to hold at scale, and what they do with a hot key."""

import pytest
from helpers import values
from pyspark.sql import Window, functions as F

from millrace.operators import steps as S
from millrace.operators.running import earlier_max, place_rows, slice_number
from millrace.plans.registry import all_queries
from millrace.sinks import write_curated

FOLDER = "/root/testdata/sf0.001"


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_targets(spark):
    """Sizes at which the test data counts as large."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_python_and_no_cross_products(spark, name):
    plan = all_queries()[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for node in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


@pytest.mark.parametrize("how", ["inner", "left", "outer"])
def test_hot_join_key_is_split(spark, small_targets, how):
    rows = spark.range(0, 60_000, 1, 8)
    left = rows.select(F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("x"))
    right = spark.range(0, 5_000).select(F.col("id").alias("k"), F.lit("r").alias("y"))
    joined = S.join_tables(left, right, ["k"], how)
    grouped = joined.groupBy("k").agg(F.count("x").alias("n"), F.count("y").alias("m"))
    joined.write.format("noop").mode("overwrite").save()
    assert "skew=true" in final_plan(joined)
    assert grouped.filter("k = 7").first()[1] == 40_000


def test_hot_keys_lie_in_many_slices(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id") % 97).alias("k"), F.col("id").alias("seq"))
    placed = place_rows(df, ["k"], ["seq"], 32)
    per_key = placed.df.groupBy("k").agg(F.count_distinct("__slice").alias("n"))
    assert per_key.filter("k IS NULL").first().n >= 14
    assert placed.df.groupBy("__slice").count().agg(F.max("count")).first()[0] < 1000
    # Rows of keys in one slice carry nothing; those in several all do.
    several = placed.df.groupBy("k").agg(F.count_distinct("__slice").alias("n"), F.bool_and("__shared").alias("s"))
    assert several.filter("n > 1 AND NOT s").count() == 0 and several.filter("NOT s").count() > 0


@pytest.mark.parametrize("first", ["CAST(NULL AS BIGINT)", "7L", "date'2024-01-01'", "'text'", "double('nan')"])
def test_a_tied_first_column_spreads_over_all_tasks(spark, first):
    df = spark.range(0, 100_000, 1, 8).selectExpr(f"{first} AS a", "CAST(id AS STRING) AS b", "pmod(hash(id), 1000) AS v")
    placed = place_rows(df, [], ["a", "b"], 16)
    counts = [r["count"] for r in placed.df.groupBy("__slice").count().collect()]
    assert len(counts) == 16 and max(counts) < 15_000
    marked = earlier_max(placed, F.col("v"), "before").df
    window = Window.orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("want", F.max("v").over(window)).select("b", "want")
    assert marked.join(want, "b").filter("NOT (before <=> want)").count() == 0


def test_rows_move_once_for_two_running_maxima(spark, small_targets, tmp_path):
    spark.range(1000).selectExpr("id AS seq", "id % 5 AS k", "id * 7 % 11 AS v", "'wide' AS payload").write.parquet(f"{tmp_path}/t")
    placed = place_rows(spark.read.parquet(f"{tmp_path}/t"), [], ["seq"], 4)
    twice = earlier_max(earlier_max(placed, F.col("v"), "a"), F.col("a"), "b").df.select("seq", "payload", "a", "b")
    plan = twice._jdf.queryExecution().executedPlan().toString()
    scans_with_payload = [line for line in plan.splitlines() if "FileScan" in line and "payload:string" in line]
    assert len(scans_with_payload) == 1


@pytest.mark.parametrize("bounds", [[], [5], [1, 2, 3], [0, 10, 20, 30, 40, 50, 60]])
def test_slice_number_counts_lower_bounds(spark, bounds):
    df = spark.createDataFrame([(x,) for x in (None, -1, 0, 1, 5, 6, 30, 31, 99)], "x bigint")
    cuts = F.array(*[F.struct(F.lit(b).cast("bigint").alias("x")) for b in bounds])
    for r in df.select("x", slice_number(F.struct("x"), cuts, len(bounds)).alias("s")).collect():
        assert r.s == (0 if r.x is None else sum(b <= r.x for b in bounds))


def test_large_partition_value_is_written_by_several_tasks(spark, small_targets, tmp_path):
    df = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("p"), F.md5(F.col("id").cast("string")).alias("x"))
    write_curated(df, "t", ["p"], base=str(tmp_path))
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "curated" / "t").glob("p=*")}
    assert files["p=hot"] > 1 and spark.read.parquet(f"{tmp_path}/curated/t").count() == 40_000
