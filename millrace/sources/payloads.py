"""Landed response bodies to records: envelopes, header-row tables, pages, nested observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import first_text, variant_lookup, whole_json
from millrace.operators.once import with_once

# Keys that may hold the record list, in order of precedence.
ENVELOPE_KEYS = ("data", "results", "items", "foods", "records", "rows")
BATCH_ENVELOPE_KEYS = ("data", "results", "items", "records")
FEATURE_KEYS = ("features",)
MS_TO_KMH = 3.6
FETCH_ERROR = "fetch_error"


def _is_object(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("OBJECT")


def envelope_records(
    body: Column,
    keys: Sequence[str] = ENVELOPE_KEYS,
    *,
    empty_is_body: bool = False,
    keep_body: bool = True,
) -> Column:
    """The records inside a variant body, as an array of variants.

    An array is its own list. In an object the first key that holds a list wins, even an empty one;
    without such a key the object is the single record. Elements that are not objects are dropped.
    ``empty_is_body`` makes an object whose list yields nothing its own record; ``keep_body=False``
    gives nothing for an object without a list.
    """
    nothing = F.array().cast("array<variant>")
    only_body = F.array(body) if keep_body else nothing
    listed = F.coalesce(*[variant_lookup(body, k, "array<variant>") for k in keys], only_body)
    elements = (
        F.when(body.isNull(), nothing)
        .when(_is_object(body), listed)
        .otherwise(F.coalesce(F.try_variant_get(body, "$", "array<variant>"), nothing))
    )
    records = F.filter(elements, _is_object)
    if empty_is_body:
        records = F.when(_is_object(body) & (F.size(records) == 0), F.array(body)).otherwise(records)
    return records


def unwrap_envelope(
    df: DataFrame,
    body: str,
    *,
    keys: Sequence[str] = ENVELOPE_KEYS,
    empty_is_body: bool = False,
    keep_body: bool = True,
    into: str = "record",
) -> DataFrame:
    """One row per record of each body; the other columns are repeated."""
    rest = [c for c in df.columns if c != body]
    held = with_once(df.withColumnRenamed(body, "__text"), "__body", F.col("__text"))
    records = envelope_records(F.col("__body"), keys, empty_is_body=empty_is_body, keep_body=keep_body)
    return held.select(*rest, F.explode(records).alias(into))


def header_rows(df: DataFrame, body: str, *, strict: bool = True, into: str = "record") -> DataFrame:
    """JSON text ``[[names..],[values..]..]`` to one map per data row.

    Strict: a row whose length differs from the header is dropped. Otherwise names and values are
    zipped up to the shorter of both, and a body without a header row of texts gives
    ``{row, value}`` maps of all its elements instead.
    """
    rest = [c for c in df.columns if c != body]
    held = with_once(df, "__json", whole_json(body))
    held = with_once(held, "__table", F.try_variant_get("__json", "$", "array<array<string>>"))
    data = F.slice("__table", 2, F.greatest(F.size("__table") - 1, F.lit(0)))
    header = F.element_at("__table", 1)
    rows = _with_header(held.filter(F.size("__table") >= 2), header, rest).select(*rest, "__header", "__names", "__places", F.explode(data).alias("__row"))
    if strict:
        return rows.filter(F.size("__row") == F.size("__header")).select(*rest, _by_places().alias(into))
    texts = F.forall(F.try_variant_get("__json", "$[0]", "array<variant>"), lambda n: F.schema_of_variant(n) == "STRING")
    has_header = F.coalesce(texts, F.lit(False)) & (F.size("__elements") >= 2)
    both = with_once(held, "__elements", F.try_variant_get("__json", "$", "array<variant>"))
    both = with_once(both, "__has_header", has_header)
    shorter = F.least(F.size("__header"), F.size("__row"))
    listed = _with_header(both.filter("__has_header"), header, rest).select(*rest, "__header", "__names", "__places", F.explode(data).alias("__row"))
    # Only a row shorter than the header needs places of its own.
    shorter = F.size("__row")
    record = F.when(shorter >= F.size("__header"), _by_places()).otherwise(named_values(F.slice("__header", 1, shorter), F.col("__row")))
    zipped = listed.select(*rest, record.alias(into))
    numbered = both.filter("NOT __has_header").select(*rest, F.posexplode("__elements").alias("__at", "__element")).select(
        *rest, F.create_map(F.lit("row"), F.col("__at").cast("string"), F.lit("value"), F.col("__element").try_cast("string")).alias(into))
    return zipped.unionByName(numbered)


def _with_header(bodies: DataFrame, header: Column, rest: Sequence[str]) -> DataFrame:
    """Bodies with ``__header``, and the names and places that it gives to rows of its length, found once per body."""
    held = with_once(bodies, "__header", header)
    placed = with_once(held, "__places", _places(F.col("__header")))
    return with_once(placed, "__names", F.transform("__places", lambda i: F.get(F.col("__header"), i))).select(
        *rest, "__table", "__header", "__places", "__names")


def _by_places() -> Column:
    return F.map_from_arrays("__names", F.transform("__places", lambda i: F.get(F.col("__row"), i)))


def _places(names: Column) -> Column:
    """Places of the names that count: the last of a repeated one, no null ones."""
    last = F.filter(F.sequence(F.lit(0), F.size(names) - 1), lambda i: F.get(names, i).isNotNull() & ~F.coalesce(
        F.array_contains(F.slice(names, i + 2, F.size(names)), F.get(names, i)), F.lit(False)))
    return F.when(F.size(names) > 0, last).otherwise(F.array().cast("array<int>"))


def named_values(names: Column, values: Column) -> Column:
    """Map of names to values of the same place; of a repeated name the last counts, a null name is left out."""
    kept = _places(names)
    return F.map_from_arrays(F.transform(kept, lambda i: F.get(names, i)), F.transform(kept, lambda i: F.get(values, i)))


def assemble_pages(
    pages: DataFrame,
    records: str,
    *,
    endpoint: Sequence[str],
    page: str,
    page_size: int | None = None,
    total_pages: str | None = None,
    provenance: dict[str, Column] | None = None,
    into: str = "record",
) -> DataFrame:
    """Records of landed pages up to where a sequential fetch would have stopped.

    ``records`` is an array column. A fetch stops at the first empty page, after the first page
    shorter than ``page_size``, and after the page number in ``total_pages``. The stop of each
    endpoint is a minimum, so a partial aggregate over page sizes finds it and no pages are ordered.
    The stops have one row per endpoint; when they are few they are broadcast and no page body moves.
    """
    count = F.coalesce(F.greatest(F.size(records), F.lit(0)), F.lit(0))
    stops = F.col(page).isNotNull() & (count < F.lit(page_size if page_size is not None else 1))
    if total_pages:
        stops = stops | F.coalesce(F.col(page) >= F.col(total_pages), F.lit(False))
    last = pages.groupBy(*endpoint).agg(F.min(F.when(stops, F.col(page))).alias("__last"))
    keyed = last.select(*[F.col(e).alias(f"__e_{e}") for e in endpoint], "__last")
    same = None
    for e in endpoint:
        test = F.col(e).eqNullSafe(F.col(f"__e_{e}"))
        same = test if same is None else same & test
    fetched = pages.join(keyed, same).filter(F.col("__last").isNull() | (F.col(page) <= F.col("__last")))
    rest = [c for c in pages.columns if c != records]
    rows = fetched.select(*rest, F.explode(records).alias(into))
    return rows.withColumns({"_ingest_page": F.col(page), **(provenance or {})})


def normalize_observation(body: Column, station: Column, fetched_at: Column) -> dict[str, Column]:
    """Flat columns of a nested station observation held in a variant.

    Values that are missing or not numeric become null, wind goes from m/s to km/h, the description
    is the first non-empty candidate, and a missing time is the time of the fetch. A null body is a
    failed poll.
    """
    def measure(name: str) -> Column:
        return variant_lookup(body, f"properties.{name}.value", "double")

    stamp = variant_lookup(body, "properties.timestamp", "variant")
    stamp_text = F.when(F.schema_of_variant(stamp) == "STRING", stamp.try_cast("string"))
    described = first_text(
        variant_lookup(body, "properties.textDescription", "string"),
        variant_lookup(body, "properties.shortForecast", "string"),
    )
    return {
        "station_id": F.coalesce(variant_lookup(body, "station_id", "string"), station),
        "timestamp": F.coalesce(stamp_text, fetched_at),
        "temperature_c": measure("temperature"),
        "humidity": measure("relativeHumidity"),
        "wind_speed_kmh": F.round(measure("windSpeed") * F.lit(MS_TO_KMH), 2),
        "description": F.when(body.isNull(), FETCH_ERROR).otherwise(described),
    }
