"""Records that lie across the ranges a file is cut into."""

import json
import random
import re

import pytest
from helpers import values
from pyspark.sql import functions as F

from millrace.sources import files, sse

SIZE = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def cut(spark):
    before = {k: spark.conf.get(k, None) for k in (SIZE, "spark.sql.files.openCostInBytes")}

    def to(size):
        spark.conf.set(SIZE, str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield to
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def events(n, ends, rng):
    text = ""
    for i in range(n):
        end = rng.choice(ends)
        text += f"id: {i}{end}" + "".join(f"data: {i}-{j} é{end}" for j in range(rng.randint(0, 3))) + rng.choice([end, end * 2, ""] if i % 5 == 0 else [end])
    return text


@pytest.mark.parametrize("ends", [["\n"], ["\r\n"], ["\r"], ["\n", "\r\n"]])
def test_event_blocks_do_not_depend_on_the_cut(spark, cut, tmp_path, ends):
    rng = random.Random(1)
    want = []
    for name in ("a", "b"):
        text = events(60, ends, rng) + "data: last"
        (tmp_path / name).write_bytes(text.encode())
        # A line feed behind a carriage return belongs to it.
        lines = re.split(r"\r\n|\n|\r", text)
        block = []
        for line in [*lines, ""]:
            if line:
                block.append(line)
            elif block:
                want.append("\n".join(block))
                block = []
    for size in (1_000_000, 37):
        cut(size)
        read = sse.read_sse(spark, str(tmp_path))
        assert sorted(r.value for r in read.collect()) == sorted(want)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20


def test_a_file_with_carriage_returns_is_read_by_several_tasks(spark, cut, tmp_path):
    (tmp_path / "x").write_bytes(b"".join(b"id: %d\r\ndata: {\"v\":%d}\r\n\r\n" % (i, i) for i in range(3000)))
    cut(5_000)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
    parsed = sse.parse_sse(sse.read_sse(spark, str(tmp_path)))
    assert values(parsed.select(F.variant_get("record", "$.v", "int").alias("v"), "_sse_id"))[:1] == [(0, "0")] and parsed.count() == 3000


ARRAYS = [
    [], [1, 2], [{"a": 1}], [{"a": 1}, {"a": {"b": [{"c": "}{"}, "x"]}}, 5, "te}xt", {"q": "\"}, {\\\"", "e": "é😀"}], [[{"n": 1}], {"a": []}, None, {"z": {}}],
    [{"i": i, "t": "}],[{" * (i % 4), "d": {"e": [i, {"f": "\\"}]}} for i in range(200)],
]


@pytest.mark.parametrize("indent", [None, 2])
def test_array_elements_do_not_depend_on_the_cut(spark, cut, tmp_path, indent):
    for i, document in enumerate(ARRAYS):
        (tmp_path / f"{i}.json").write_text(json.dumps(document, indent=indent, ensure_ascii=i % 2 == 0) + "\n" * (i % 2))
    want = sorted(json.dumps(x, sort_keys=True) for d in ARRAYS for x in d if isinstance(x, dict))
    for size in (1_000_000, 31):
        cut(size)
        rows = files.json_elements(spark, str(tmp_path)).select(F.to_json("record").alias("r"), "corrupt").collect()
        assert [r.corrupt for r in rows if r.corrupt is not None] == []
        assert sorted(json.dumps(json.loads(r.r), sort_keys=True) for r in rows) == want


BROKEN = ['[{"a":1}', '[{"a":1},', '[{"a":1} {"b":2}]', '[{"a":1},,{"b":2}]', '[{"a":1},]', '{"a":1}', '[{"a":1}] x', '[{"a":"1}]', '"text"', "[1,]", '[{"a":}]',
          '[{"a":1}]]']


def test_broken_arrays_are_named(spark, cut, tmp_path):
    (tmp_path / "good.json").write_text('[{"g":1}, {"g":2}]')
    for i, text in enumerate(BROKEN):
        (tmp_path / f"bad{i}.json").write_text(text)
    for size in (1_000_000, 5):
        cut(size)
        rows = files.json_elements(spark, str(tmp_path)).collect()
        assert {r.path.rsplit("/", 1)[1] for r in rows if r.corrupt is not None} == {f"bad{i}.json" for i in range(len(BROKEN))}
        assert sum(r.record is not None and r.path.endswith("good.json") for r in rows) == 2


def test_pieces_of_arrays_are_numbered_once(spark, cut, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"i": i} for i in range(300)]))
    cut(500)
    read = files.json_elements(spark, str(tmp_path))
    # What is left when the query runs works on whole runs: no text is read, and no piece is sorted in its block again.
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and "seq#" not in plan
    assert sorted(r.i for r in read.select(F.variant_get("record", "$.i", "int").alias("i")).collect()) == list(range(300))
