import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from millrace import functions as fn


def one(spark, column, value, ddl):
    return spark.createDataFrame([(value,)], f"x {ddl}").select(column(F.col("x"))).first()[0]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(-999, 999).filter(bool)), min_size=1, max_size=30))
def test_floor_arithmetic_on_integers(spark, pairs):
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    a, b = F.col("a"), F.col("b")
    for r in df.select("a", "b", fn.floor_div(a, b, integral=True).alias("q"), fn.floor_mod(a, b).alias("m")).collect():
        assert (r.q, r.m) == (r.a // r.b, r.a % r.b)


def test_floor_arithmetic_on_doubles(spark):
    pairs = [(1.0, 0.1), (-7.5, 2.0), (7.5, -2.0), (-7.0, -2.0), (6.0, 3.0), (0.0, 5.0), (1e15, 7.0)]
    df = spark.createDataFrame(pairs, "a double, b double")
    for r in df.select("a", "b", fn.floor_div(F.col("a"), F.col("b")).alias("q"), fn.floor_mod(F.col("a"), F.col("b")).alias("m")).collect():
        assert r.q == r.a // r.b and math.isclose(r.m, r.a % r.b)


@pytest.mark.parametrize("text, number", [
    ("12", 12.0), (" -1.5e3 ", -1500.0), (".5", 0.5), ("inf", math.inf), ("1d", None), ("1f", None), ("0x10", None),
    ("", None), ("abc", None), (None, None),
])
def test_number_text(spark, text, number):
    assert one(spark, fn.number_text, text, "string") == number


@pytest.mark.parametrize("text, epoch", [
    ("2024-01-01T00:00:00Z", 1704067200.0), ("2024-01-01T02:00:00+02:00", 1704067200.0),
    ("2024-01-01 00:00:00.5", 1704067200.5), ("2024-01-01", 1704067200.0), (" 2024-01-01T00:00Z ", 1704067200.0),
    ("2024", None), ("2024-13-01", None), ("yesterday", None), ("", None),
])
def test_iso_epoch(spark, text, epoch):
    assert one(spark, fn.iso_epoch, text, "string") == epoch


def test_event_epoch_by_type(spark):
    assert one(spark, lambda c: fn.event_epoch(c, T.LongType()), 5, "bigint") == 5.0
    assert one(spark, lambda c: fn.event_epoch(c.cast("timestamp_ntz"), T.TimestampNTZType()), "1970-01-02", "string") == 86400.0
    assert one(spark, lambda c: fn.event_epoch(c, T.BooleanType()), True, "boolean") is None


@pytest.mark.parametrize("card, valid", [
    ("4111 1111-1111 1111", True), ("4111111111111112", False), ("378282246310005", True), ("0" * 12, False),
    ("0" * 20, False), ("no digits", False),
])
def test_luhn(spark, card, valid):
    assert one(spark, fn.luhn_valid, card, "string") is valid


@pytest.mark.parametrize("message, category", [
    ("Read TIMEOUT over http", "timeout"), ("HTTP 401", "http"), ("bad status", "http"), ("Unauthorized", "auth"),
    ("code 403", "auth"), ("config missing", "configuration"), ("disk full", "generic"), (" \t", "unknown"), (None, "unknown"),
])
def test_error_category(spark, message, category):
    assert one(spark, fn.error_category, message, "string") == category


@pytest.mark.parametrize("zone, name", [(" RAW\n", "raw"), ("Governed", "governed"), ("", "unknown"), (None, "unknown"), ("x", "x")])
def test_zone_name(spark, zone, name):
    assert one(spark, fn.zone_name, zone, "string") == name


@pytest.mark.parametrize("text, kind", [
    ("null", "null"), ("true", "boolean"), ("42", "integer"), ("12345678901234567890", "integer"), ("3.14", "number"),
    ("3.0", "number"), ("1e5", "number"), ('"hello"', "string"), ("[1,2]", "array"), ('{"a":1}', "object"),
])
def test_variant_kind(spark, text, kind):
    assert one(spark, lambda c: fn.variant_kind(F.parse_json(c)), text, "string") == kind


def test_json_lookup(spark):
    body = '{"a":{"b":[1,2],"c d":"x"}}'
    assert one(spark, lambda c: fn.json_lookup(c, "a.c d"), body, "string") == "x"
    assert one(spark, lambda c: fn.json_lookup(c, "a.b.c"), body, "string") is None
    assert one(spark, lambda c: fn.variant_lookup(F.parse_json(c), "a.c d", "string"), body, "string") == "x"


def test_counts_and_measures(spark):
    assert [one(spark, fn.parse_count, t, "string") for t in ("12", "-12", "", "1.5", None)] == [12, None, None, None, None]
    assert [one(spark, fn.parse_measure, t, "string") for t in ("1.5", "-", "", None)] == [1.5, None, None, None]
    assert one(spark, lambda c: fn.divide(c, F.lit(0), zero_as_null=True), 1.0, "double") is None
    assert [one(spark, fn.text_truth, t, "string") for t in ("Yes", "1", "0", None)] == [True, True, False, None]


@pytest.mark.parametrize(("text", "kept"), [
    ('{"a":1}', True), (" 12 ", True), ('"x"', True), ("[1,2]", True), ("null", True), ('{"a":1,"a":2}', True),
    ('{"a":1} junk', False), ("12 monkeys", False), ("404 not found", False), ('{"a":1}{"b":2}', False), ("1],[2", False),
    ('1},{"b":2', False), ('1,"v":2', False), ("1,2", False), ("", False), ("{oops", False), (None, False)])
def test_whole_json(spark, text, kept):
    assert one(spark, lambda c: fn.whole_json(c).isNotNull(), text, "string") is kept


def test_last_of_repeated_keys_counts(spark):
    assert one(spark, lambda c: F.try_variant_get(fn.whole_json(c), "$.a", "int"), '{"a":1,"a":2}', "string") == 2


def test_long_fractions_are_times(spark):
    assert one(spark, lambda c: fn.iso_epoch(c), "2024-01-01T00:00:00.123456789Z", "string") == 1704067200.123456
