import json

import pytest
from helpers import values
from pyspark.sql import functions as F

from millrace.functions import whole_json
from millrace.sinks import EmptyWriteError, overwrite_table, staged, write_curated, write_jsonl, write_raw
from millrace.sources import files, payloads as P, sse, stats


def test_formats_by_suffix():
    assert [files.format_of(p) for p in ("a.CSV", "b.json", "c.jsonl", "d.ndjson", "e.pq", "f")] == [
        "csv", "json", "jsonl", "jsonl", "parquet", "parquet"]


def test_csv_is_text_with_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,x\n2,\"y,z\"\n")
    df = files.read_table(spark, str(tmp_path / "x.csv"))
    assert df.dtypes == [("a", "string"), ("b", "string")] and values(df) == [("1", "x"), ("2", "y,z")]
    assert files.read_table(spark, str(tmp_path / "x.csv"), header=False).columns == ["_c0", "_c1"]
    with pytest.raises(ValueError):
        files.read_table(spark, "x", "xml")


def test_json_lines_skip_blanks(spark, tmp_path):
    (tmp_path / "x.ndjson").write_text('{"a":1}\n\n{"a":2,"b":"y"}\n')
    assert values(files.read_table(spark, str(tmp_path / "x.ndjson"), schema="a bigint, b string")) == [(1, None), (2, "y")]


@pytest.mark.parametrize("document, count", [
    ([{"a": 1}, 5, {"a": 2}], 2), ({"items": [{"a": 1}]}, 1), ({"a": 1, "foods": [{"a": 2}, {"a": 3}]}, 1), ({"data": []}, 0),
])
def test_json_documents(spark, tmp_path, document, count):
    (tmp_path / "d.json").write_text(json.dumps(document, indent=1))
    assert files.read_json_document(spark, str(tmp_path / "d.json")).count() == count


def test_json_document_with_schema(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=1))
    assert values(files.read_json_document(spark, str(tmp_path / "d.json"), schema="a bigint")) == [(1,), (2,)]


def test_broken_documents_are_told(spark, tmp_path):
    for name, text in {"good": '{"items":[{"a":1}]}', "cut": '{"items":[{"a"', "two": '{"a":1}{"a":2}', "bare": '"text"'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    told = {r.path.rsplit("/", 1)[1]: r.problem for r in files.json_documents(spark, str(tmp_path)).collect()}
    assert told == {"good.json": None, "cut.json": "not one JSON document", "two.json": "not one JSON document",
                    "bare.json": "neither an array nor an object"}
    with pytest.raises(Exception, match="not one JSON document"):
        files.read_json_document(spark, str(tmp_path / "two.json")).collect()


def bodies(spark, *documents):
    return spark.createDataFrame([(json.dumps(d),) for d in documents], "t string").select(F.parse_json("t").alias("body"))


def unwrapped(spark, document, **kw):
    df = P.unwrap_envelope(bodies(spark, document), "body", **kw)
    return sorted(r[0] for r in df.select(F.to_json("record")).collect())


def test_envelopes(spark):
    assert unwrapped(spark, {"results": 3, "rows": [{"a": 1}, "x"]}) == ['{"a":1}']
    assert unwrapped(spark, {"data": [], "items": [{"a": 1}]}) == []
    assert unwrapped(spark, {"data": [], "n": 1}, empty_is_body=True) == ['{"data":[],"n":1}']
    assert unwrapped(spark, {"x": 1}) == ['{"x":1}'] and unwrapped(spark, {"x": 1}, keep_body=False) == []
    assert unwrapped(spark, [[1], {"a": 2}]) == ['{"a":2}'] and unwrapped(spark, "text") == [] and unwrapped(spark, None) == []
    assert unwrapped(spark, {"features": [{"id": 1}]}, keys=P.FEATURE_KEYS) == ['{"id":1}']


def test_header_rows(spark):
    df = spark.createDataFrame([('[["a","b"],["1","2"],["3"],["4",null]]',), ('[["a"]]',), ('[5,"x"]',)], "body string")
    assert values(P.header_rows(df.limit(1), "body")) == [({"a": "1", "b": "2"},), ({"a": "4", "b": None},)]
    assert P.header_rows(df.filter("body = '[[\"a\"]]'"), "body").count() == 0
    loose = P.header_rows(df.limit(1), "body", strict=False)
    assert [r.record for r in loose.collect()] == [{"a": "1", "b": "2"}, {"a": "3"}, {"a": "4", "b": None}]
    plain = P.header_rows(df.filter("body LIKE '[5%'"), "body", strict=False)
    assert [r.record for r in plain.collect()] == [{"row": "0", "value": "5"}, {"row": "1", "value": "x"}]


def test_last_of_repeated_names_counts(spark):
    df = spark.createDataFrame([('[["a","b","a"],["1","2","3"],["4"],["5","6"]]',), ('[["a"],["1"]] [["b"],["2"]]',)], "body string")
    assert values(P.header_rows(df, "body")) == [({"b": "2", "a": "3"},)]
    assert [r.record for r in P.header_rows(df, "body", strict=False).collect()] == [{"b": "2", "a": "3"}, {"a": "4"}, {"a": "5", "b": "6"}]


def test_pages_stop_where_a_fetch_would(spark):
    rows = [("short", 1, [1, 2], 9), ("short", 2, [3], 9), ("short", 3, [4, 5], 9), ("empty", 1, [1, 2], 9), ("empty", 2, [], 9),
            ("empty", 3, [5, 6], 9), ("total", 1, [1, 2], 2), ("total", 2, [3, 4], 2), ("total", 3, [5, 6], 2), (None, 1, [7, 8], None)]
    df = spark.createDataFrame(rows, "ep string, page int, recs array<int>, total int")
    got = P.assemble_pages(df, "recs", endpoint=["ep"], page="page", page_size=2, total_pages="total")
    assert values(got.groupBy("ep").agg(F.count("*"))) == [("empty", 2), ("short", 3), ("total", 4), (None, 2)]
    loose = P.assemble_pages(df.filter("ep = 'short'"), "recs", endpoint=["ep"], page="page", provenance={"_ingest_query": F.lit("q")})
    assert loose.count() == 5 and {"_ingest_page", "_ingest_query"} <= set(loose.columns)


def test_merge_and_rows(spark):
    a = files.rows_to_table(spark, [{"x": 1}, {"x": 2, "y": "b"}], "x int, y string")
    assert values(a) == [(1, None), (2, "b")]
    assert files.rows_to_table(spark, [], "x int").count() == 0
    merged = files.merge_datasets([a, spark.createDataFrame([(9,)], "z int")])
    assert merged.columns == ["x", "y", "z"] and merged.count() == 3
    with pytest.raises(ValueError):
        files.merge_datasets([])


def test_read_datasets(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "b.jsonl").write_text('{"y":"2"}\n')
    df = files.read_datasets(spark, str(tmp_path), [{"path": "/a.csv"}, {"path": "b.jsonl", "format": "ndjson"}])
    assert values(df) == [("1", None), (None, "2")]


def test_sse_blocks(spark, tmp_path):
    text = ("id: 7\ndata: {\"a\":1}\n\ndata: [DONE]\n\nretry: 5\n\nid:  8 \r\ndata: [1,\r\ndata:   2]\r\n\n"
            "data: oops\n\nid: 1\nid: 2\ndata: {\"_sse_id\":\"own\"}\n\n")
    (tmp_path / "s.txt").write_text(text, newline="")
    rows = sse.parse_sse(sse.read_sse(spark, str(tmp_path / "s.txt"))).select(
        F.to_json("record").alias("record"), F.to_json("value").alias("value"), "raw", "_sse_id")
    assert values(rows) == sorted([('{"a":1}', None, None, "7"), (None, "[1,2]", None, "8"), (None, None, "oops", None),
                                   ('{"_sse_id":"own"}', None, None, "own")], key=repr)


def test_sse_files_with_other_line_ends(spark, tmp_path):
    text = 'id: 1\r\ndata: {"a":1}\r\n\r\nid: 2\r\ndata: {"a":2}\r\n\r\ndata: {"a":3} more\r\n\r\n'
    (tmp_path / "s.txt").write_text(text, newline="")
    for newline in ("\n", "\r\n"):
        rows = sse.parse_sse(sse.read_sse(spark, str(tmp_path / "s.txt"), newline=newline))
        assert values(rows.select(F.to_json("record").alias("record"), "raw", "_sse_id")) == [
            ('{"a":1}', None, "1"), ('{"a":2}', None, "2"), (None, '{"a":3} more', None)]


def test_source_statistics(spark):
    source = stats.observe_source(spark.createDataFrame([("ab",), ("ü",), (None,)], "t string"), "s", payload=F.col("t"))
    source.df.collect()
    result = source.result()
    assert (result["records_fetched"], result["bytes_fetched"], result["errors"]) == (3, 4, [])
    assert result["completed_at"] >= result["started_at"]
    texts = spark.createDataFrame([("{}",), ("{} {}",), ("oops",)], "t string")
    told = stats.observe_source(texts, "s", bad=whole_json("t").isNull())
    told.df.collect()
    assert told.result()["errors"] == ["2 records could not be read"]


def test_raw_writes_append_with_receipt(spark, products, tmp_path):
    first = write_raw(products, str(tmp_path), "shop", {"day": "d1", "area": "x"})
    assert first.destination.endswith("raw/shop/area=x/day=d1") and first.partitions == ["area=x", "day=d1"]
    assert first.records_written == 5 and first.bytes_written > 0
    write_raw(products, str(tmp_path), "shop", {"day": "d1", "area": "x"})
    back = spark.read.parquet(f"{tmp_path}/raw/shop")
    assert back.count() == 10 and {"area", "day"} <= set(back.columns)
    with pytest.raises(EmptyWriteError):
        write_raw(products.filter("false"), str(tmp_path), "none")
    assert not (tmp_path / "raw" / "none").exists()
    assert write_jsonl(products, str(tmp_path), "lines").format == "json"


def test_curated_folder_and_table(spark, products, tmp_path):
    receipt = write_curated(products, "shop.products", ["category"], base=str(tmp_path))
    assert (tmp_path / "curated" / "shop_products" / "category=fruit").is_dir() and receipt.records_written == 5
    spark.sql("DROP TABLE IF EXISTS curated_products")
    for total in (5, 10):
        receipt = write_curated(products, "curated_products", ["category"])
        assert receipt.records_written == 5 and receipt.bytes_written > 0
        assert spark.table("curated_products").count() == total
    spark.sql("DROP TABLE curated_products")


def test_overwrite_whole_or_by_partition(spark, products, tmp_path):
    path = f"{tmp_path}/t"
    overwrite_table(products, path, ["category"])
    overwrite_table(products.filter("name = 'Apple'"), path, ["category"], dynamic=True)
    assert values(spark.read.parquet(path), "name") == [("Apple",), ("Carrot",), ("Milk",), ("Steak",)]
    overwrite_table(products.filter("name = 'Apple'"), path, ["category"])
    assert spark.read.parquet(path).count() == 1


def test_a_failed_overwrite_changes_nothing(spark, products, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(products, path, ["category"])
    before = values(spark.read.parquet(path))
    broken = products.withColumn("price", F.when(F.col("name") == "Milk", F.raise_error(F.lit("late")).cast("double")).otherwise(F.col("price")))
    for dynamic in (False, True):
        with pytest.raises(Exception, match="late"):
            overwrite_table(broken.repartition(3), path, ["category"], dynamic=dynamic)
        with pytest.raises(EmptyWriteError):
            overwrite_table(products.filter("false"), path, ["category"], dynamic=dynamic)
        assert values(spark.read.parquet(path)) == before
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith(("_stage", "_aside"))]


def test_a_failed_swap_is_undone(spark, products, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    overwrite_table(products, path, ["category"])
    before = values(spark.read.parquet(path))
    move, seen = staged.Folder.move, []

    def failing(self, source, target):
        seen.append(source)
        if len(seen) == 6:
            raise OSError("no")
        move(self, source, target)

    monkeypatch.setattr(staged.Folder, "move", failing)
    with pytest.raises(OSError, match="no"):
        overwrite_table(products.withColumn("price", F.lit(0.0)), path, ["category"])
    assert values(spark.read.parquet(path)) == before


def test_a_write_is_one_job_and_tells_its_bytes(spark, products, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-write", "")
    receipt = write_raw(products.repartition(3), str(tmp_path), "shop")
    jobs = tracker.getJobIdsForGroup("one-write")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in jobs for s in tracker.getJobInfo(j).stageIds]
    assert len(jobs) <= 2 and len(stages) <= 3  # adaptive execution runs the shuffle of the repartition as a job of its own
    assert receipt.bytes_written == sum(p.stat().st_size for p in (tmp_path / "raw" / "shop").glob("*.parquet"))
    again = write_raw(products, str(tmp_path), "shop")
    assert again.bytes_written + receipt.bytes_written == sum(p.stat().st_size for p in (tmp_path / "raw" / "shop").glob("*.parquet"))
