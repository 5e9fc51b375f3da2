"""Command messages: parsing, validation and quarantine, for tables and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import strip_text, whole_json
from millrace.operators.once import with_once

# Allowed actions, priority bounds and the priority of a message that names none.
ACTIONS = ("ingest", "transform", "backfill")
LOWEST, HIGHEST, DEFAULT_PRIORITY = 1, 5, 3


def check_messages(df: DataFrame, message: str) -> DataFrame:
    """Replace the JSON text column by the command fields and ``reasons``, the list of broken rules.

    The source id must hold at least one character before trimming, and is trimmed afterwards. A
    missing priority is 3 and a missing payload an empty object.
    """
    rest = [c for c in df.columns if c != message]
    fields = F.struct(*[
        F.try_variant_get("__body", f"$.{name}", "variant").alias(name)
        for name in ("source_id", "action", "priority", "payload")
    ])
    parsed = with_once(df, "__body", whole_json(message))
    parsed = with_once(parsed, "__f", fields)
    shapes = F.struct(*[
        F.schema_of_variant(f"__f.{name}").alias(name) for name in ("source_id", "priority", "payload")
    ], F.schema_of_variant("__body").alias("body"))
    parsed = with_once(parsed, "__shape", shapes)
    source, action = F.col("__f.source_id").try_cast("string"), F.col("__f.action").try_cast("string")
    # Any scalar that stands for a whole number will do: 3, 3.0, "3" or true.
    number = F.when(~F.col("__shape.priority").rlike("^(OBJECT|ARRAY|VOID)"), F.col("__f.priority").try_cast("double"))
    priority = F.when(F.col("__f.priority").isNull(), DEFAULT_PRIORITY).otherwise(
        F.when(number.between(LOWEST, HIGHEST) & (number == F.floor(number)), number.cast("int")))
    is_object = F.coalesce(F.col("__shape.body").startswith("OBJECT"), F.lit(False))
    rules = {
        "message is not a JSON object": ~is_object,
        "source_id missing": is_object & (
            source.isNull() | (F.length(source) < 1) | (F.col("__shape.source_id") != "STRING")),
        "action not allowed": is_object & ~F.coalesce(action.isin(*ACTIONS), F.lit(False)),
        "priority not within 1..5": is_object & priority.isNull(),
        "payload is not an object": is_object & F.col("__f.payload").isNotNull()
        & ~F.col("__shape.payload").startswith("OBJECT"),
    }
    reasons = F.filter(
        F.array(*[F.when(F.coalesce(broken, F.lit(True)), name) for name, broken in rules.items()]),
        lambda r: r.isNotNull(),
    )
    return with_once(parsed, "reasons", reasons).select(
        *rest,
        strip_text(source).alias("source_id"),
        action.alias("action"),
        priority.alias("priority"),
        F.coalesce(F.to_json("__f.payload"), F.lit("{}")).alias("payload"),
        F.col(message),
        "reasons",
    )


def valid_messages(df: DataFrame, message: str) -> DataFrame:
    return check_messages(df, message).filter(F.size("reasons") == 0).drop(message, "reasons")


def quarantined_messages(df: DataFrame, message: str) -> DataFrame:
    """Rejected messages with their text and the rules they broke."""
    return (
        check_messages(df, message).filter(F.size("reasons") > 0)
        .drop("source_id", "action", "priority", "payload")
    )
