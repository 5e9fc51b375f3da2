"""Lineage events as a table: run states, neighbours of a source, and facets."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions import whole_json

DEFAULT_NAMESPACE = "millrace"
PRODUCER = "millrace"
# Facet schema addresses of the public lineage specification.
SCHEMA_FACET_URL = "https://openlineage.io/spec/facets/1-0-0/SchemaDatasetFacet.json"
QUALITY_FACET_URL = "https://openlineage.io/spec/facets/1-0-0/DataQualityMetricsInputDatasetFacet.json"
STEPS_FACET_URL = "https://openlineage.io/spec/facets/1-0-0/DocumentationJobFacet.json"

DATASET = T.StructType([
    T.StructField("namespace", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("facets", T.StringType()),
])
EVENT_SCHEMA = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("job_name", T.StringType()),
    T.StructField("job_namespace", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("inputs", T.ArrayType(DATASET)),
    T.StructField("outputs", T.ArrayType(DATASET)),
    T.StructField("facets", T.StringType()),
])


def dataset_ref(namespace: Column, name: Column, facets: Column | None = None) -> Column:
    facets = facets if facets is not None else F.lit("{}")
    return F.struct(namespace.alias("namespace"), name.alias("name"), facets.alias("facets"))


def dataset_key(ref: Column) -> Column:
    return F.concat(ref.getField("namespace"), F.lit(":"), ref.getField("name"))


def start_events(runs: DataFrame) -> DataFrame:
    """START events from a table with run_id, job_name, started_at, inputs, outputs.

    ``job_namespace`` and ``facets`` are optional columns.
    """
    def optional(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if name in runs.columns else F.lit(default)

    return runs.select(
        F.lit("START").alias("event_type"), "run_id", "job_name",
        optional("job_namespace", DEFAULT_NAMESPACE).alias("job_namespace"),
        F.col("started_at").alias("event_time"), "inputs", "outputs",
        optional("facets", "{}").alias("facets"),
    )


def end_events(starts: DataFrame, ends: DataFrame) -> DataFrame:
    """COMPLETE and FAIL events; job and inputs are those the run started with.

    ``ends`` has run_id, event_type, event_time, outputs, facets and error_message. A failed run has
    no outputs, and its facets are the error message. A run that never started is called
    ``unknown`` and has no inputs.
    """
    # A retried run, or a log that delivers twice, has several starts; the latest says what the run reads.
    begun = F.struct("job_name", "job_namespace", "inputs")
    known = starts.filter("event_type = 'START'").groupBy(F.col("run_id").alias("__run")).agg(
        F.max_by(begun, F.struct("event_time", begun)).alias("begun")).select("__run", "begun.*")
    none = F.array().cast("array<struct<namespace:string,name:string,facets:string>>")
    failed = F.col("event_type") == "FAIL"
    joined = ends.join(known, F.col("run_id") == F.col("__run"), "left")
    return joined.select(
        "event_type", "run_id",
        F.coalesce("job_name", F.lit("unknown")).alias("job_name"),
        F.coalesce("job_namespace", F.lit(DEFAULT_NAMESPACE)).alias("job_namespace"),
        "event_time",
        F.coalesce("inputs", none).alias("inputs"),
        F.when(failed, none).otherwise(F.coalesce("outputs", none)).alias("outputs"),
        F.when(failed, F.to_json(F.struct(F.col("error_message").alias("errorMessage"))))
        .otherwise(F.coalesce("facets", F.lit("{}"))).alias("facets"),
    )


def _source_datasets(events: DataFrame, source_id: str) -> DataFrame:
    """Keys of the datasets that belong to a source."""
    every = events.select(F.explode(F.concat("inputs", "outputs")).alias("d"))
    named = F.try_variant_get(whole_json("d.facets"), "$.source.source_id", "string") == source_id
    own = F.col("d.name").contains(source_id) | F.col("d.namespace").contains(source_id) | F.coalesce(
        F.when(F.col("d.facets") != "{}", named), F.lit(False))
    return every.filter(own).select(dataset_key(F.col("d")).alias("dataset")).distinct()


def neighbors(events: DataFrame, source_id: str) -> DataFrame:
    """Datasets one step up- and downstream of a source: rows (direction, dataset), sorted.

    The source is every dataset whose name or namespace contains the id, or that names it in a
    ``source`` facet in any event. Finished events that touch the source contribute their other
    inputs (upstream) and outputs (downstream). Inputs and outputs are never paired.

    Mentions of the source are found by a join on dataset keys, whatever their number; what goes on
    is the distinct neighbours.
    """
    own = _source_datasets(events, source_id)
    finished = events.filter("event_type <> 'START'").select(
        F.transform("inputs", dataset_key).alias("reads"), F.transform("outputs", dataset_key).alias("writes"))
    sides = F.array(
        F.struct(F.lit("downstream").alias("direction"), F.col("reads").alias("touches"), F.col("writes").alias("others")),
        F.struct(F.lit("upstream").alias("direction"), F.col("writes").alias("touches"), F.col("reads").alias("others")))
    each = finished.select(F.explode(sides).alias("s")).select("s.direction", "s.others", F.explode("s.touches").alias("dataset"))
    beside = each.join(own, "dataset", "left_semi").select("direction", F.explode("others").alias("dataset")).distinct()
    return beside.join(own, "dataset", "left_anti").select("direction", "dataset").orderBy("direction", "dataset")


# ---------------------------------------------------------------- facets and JSON


def schema_facet(schema: T.StructType) -> dict:
    """Schema facet from table metadata."""
    return {
        "_schemaURL": SCHEMA_FACET_URL,
        "fields": [{"name": f.name, "type": f.dataType.simpleString()} for f in schema.fields],
    }


def steps_facet(steps: Sequence[str]) -> dict:
    return {"_schemaURL": STEPS_FACET_URL, "steps": list(steps), "engine": PRODUCER}


def quality_facet(profile: DataFrame) -> DataFrame:
    """One row with the quality facet as JSON text, from a per-column profile.

    The profile has one row per column of a table, so the collected maps are as small as its schema.
    """
    counts = profile.agg(
        F.max("row_count").alias("rowCount"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "null_count")))).alias("nullCounts"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "unique_count")))).alias("uniqueCounts"),
    )
    return counts.select(
        F.to_json(F.struct(F.lit(QUALITY_FACET_URL).alias("_schemaURL"), "rowCount", "nullCounts", "uniqueCounts"))
        .alias("facet")
    )


def dataset_with_facets(
    df: DataFrame,
    namespace: str,
    name: str,
    *,
    profile: DataFrame | None = None,
    steps: Sequence[str] = (),
    source_id: str | None = None,
) -> DataFrame:
    """One dataset reference (namespace, name, facets) whose facets hold schema, quality, steps, source."""
    fixed: dict = {"schema": schema_facet(df.schema)}
    if steps:
        fixed["transform"] = steps_facet(steps)
    if source_id is not None:
        fixed["source"] = {"source_id": source_id}
    parts = [F.lit(f"{json.dumps(k)}:{json.dumps(v)}") for k, v in fixed.items()]
    if profile is None:
        base = df.sparkSession.range(1)
    else:
        base = quality_facet(profile)
        parts.insert(1, F.concat(F.lit('"dataQuality":'), F.col("facet")))
    return base.select(
        F.lit(namespace).alias("namespace"), F.lit(name).alias("name"),
        F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("facets"),
    )


def lineage_json(events: DataFrame) -> DataFrame:
    """Add ``json``: the event in the public run-event shape, facets embedded as JSON."""
    def refs(column: str) -> Column:
        return F.transform(F.col(column), lambda d: F.struct(
            d.getField("namespace").alias("namespace"), d.getField("name").alias("name"),
            whole_json(d.getField("facets")).alias("facets"),
        ))
    zulu = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return events.withColumn("json", F.to_json(F.struct(
        F.col("event_type").alias("eventType"), zulu.alias("eventTime"),
        F.struct(F.col("run_id").alias("runId")).alias("run"),
        F.struct(F.col("job_namespace").alias("namespace"), F.col("job_name").alias("name"),
                 whole_json("facets").alias("facets")).alias("job"),
        refs("inputs").alias("inputs"), refs("outputs").alias("outputs"),
        F.lit(PRODUCER).alias("producer"),
    )))
