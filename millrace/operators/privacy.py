"""Personal-data detection by column name and by value, and the resulting classification."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions import blank, digits_only, luhn_valid
from millrace.operators.once import with_once

# Name hints in order of precedence. A column matches when its normalised name
# contains the hint.
NAME_HINTS = (
    ("email", "email"), ("e_mail", "email"), ("mail", "email"),
    ("phone", "phone"), ("mobile", "phone"), ("tel", "phone"), ("telephone", "phone"),
    ("ssn", "ssn"), ("social_security", "ssn"), ("socialsecurity", "ssn"),
    ("name", "name"), ("first_name", "name"), ("last_name", "name"),
    ("fullname", "name"), ("full_name", "name"),
    ("address", "address"), ("street", "address"), ("zip", "address"), ("postal", "address"),
    ("dob", "dob"), ("date_of_birth", "dob"), ("birthdate", "dob"), ("birth_date", "dob"),
    ("credit_card", "credit_card"), ("cc_number", "credit_card"), ("card_number", "credit_card"),
    ("ip", "ip_address"), ("ip_address", "ip_address"), ("client_ip", "ip_address"),
)
# Value patterns. Only the existence of a match counts, so an e-mail address is found
# from the one character before its @, and the optional country code and bracket in front of a phone
# number are left out. Both keep the search linear in the length of the text.
EMAIL = r"[a-zA-Z0-9._%+-]@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE = r"[0-9]{3}\)?[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}\b"
SSN = r"\b(?!000|666|9\d{2})\d{3}[-\s]?(?!00)\d{2}[-\s]?(?!0000)\d{4}\b"
IP_ADDRESS = (
    r"\b(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}"
    r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\b"
)
# Digits a text must hold before the pattern of a type can match.
FEWEST_DIGITS = {"phone": 10, "ssn": 9, "ip_address": 4}
LEVELS = ("public", "internal", "confidential", "restricted")
VALUE_TYPES = ("email", "phone", "ssn", "ip_address", "credit_card")


def name_hint(column: str, *, match: str = "substring") -> str | None:
    """Personal-data type suggested by a column name.

    ``match="token"`` compares whole words between underscores, which avoids finding ``ip`` in
    ``description``.
    """
    key = column.lower().replace(" ", "_").replace("-", "_")
    for hint, kind in NAME_HINTS:
        if match == "substring" and hint in key:
            return kind
        if match == "token" and f"_{hint}_" in f"_{key}_":
            return kind
    return None


def value_flags(c: Column, digits: Column) -> dict[str, Column]:
    """One boolean per value type for a text column.

    ``digits`` is the text reduced to its digits. It is computed once and decides which patterns are
    worth trying; most texts hold too few digits for any of them.
    """
    count = F.length(digits)
    flags = {
        "email": c.contains("@") & c.rlike(EMAIL),
        "phone": (count >= FEWEST_DIGITS["phone"]) & c.rlike(PHONE),
        "ssn": (count >= FEWEST_DIGITS["ssn"]) & c.rlike(SSN),
        "ip_address": (count >= FEWEST_DIGITS["ip_address"]) & c.contains(".") & c.rlike(IP_ADDRESS),
        "credit_card": luhn_valid(c, digits),
    }
    return {kind: flags[kind] for kind in VALUE_TYPES}


def value_type(c: Column, digits: Column) -> Column:
    """The first value type that matches, in the order of :data:`VALUE_TYPES`; null when none does."""
    rule = F.when(F.lit(False), F.lit(None).cast("string"))
    for kind, flag in value_flags(c, digits).items():
        rule = rule.when(flag, kind)
    return rule


def flag_rows(df: DataFrame, column: str, prefix: str = "has_") -> DataFrame:
    """Add one boolean column per value type."""
    held = with_once(df, "__digits", digits_only(F.col(column)))
    flags = value_flags(F.col(column), F.col("__digits"))
    return held.select("*", *[f.alias(f"{prefix}{k}") for k, f in flags.items()]).drop("__digits")


def _value_types(df: DataFrame, columns: dict[str, str], *keep: str) -> DataFrame:
    """Type found in each named column (output name by column name), row by row."""
    for column, out in columns.items():
        df = with_once(df, f"{out}_digits", digits_only(F.col(column).cast("string")))
    found = [value_type(F.col(c).cast("string"), F.col(f"{out}_digits")).alias(out) for c, out in columns.items()]
    return df.select(*keep, *found)


def scan_columns(
    df: DataFrame,
    order: str,
    *,
    columns: Iterable[str] | None = None,
    match: str = "substring",
) -> DataFrame:
    """One row per column: type found by name, type found by value, the deciding type, rows scanned.

    The value found first along ``order`` decides. All columns are searched in one pass; each task
    keeps a single candidate per column. Columns decided by name are not searched by value.
    """
    columns = sorted(columns or df.columns)
    hints = {c: name_hint(c, match=match) for c in columns}
    searchable = [
        c for c in columns
        if hints[c] is None
        and not isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
    ]
    names = {c: f"v{i}" for i, c in enumerate(searchable)}

    def first_hit(name: str) -> Column:
        hit = F.when(F.col(name).isNotNull(), F.struct(F.col("__at"), F.col(name).alias("kind")))
        return F.min(hit).getField("kind").alias(name)

    total = F.count(F.lit(1)).alias("__rows")
    found = _value_types(df.withColumn("__at", F.col(order)), names, "__at")
    folded = found.agg(total, *map(first_hit, names.values()))
    values = {c: F.col(name) for c, name in names.items()}
    null = F.lit(None).cast("string")
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(hints[c]).cast("string").alias("by_name"),
            values.get(c, null).alias("by_value"),
            F.coalesce(F.lit(hints[c]).cast("string"), values.get(c, null)).alias("pii_type"),
            F.col("__rows").alias("scanned_rows"),
        )
        for c in columns
    ]
    return folded.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def configured_level(governance: Mapping[str, str] | None) -> str:
    """Configured classification, ``internal`` when missing or unknown."""
    level = str((governance or {}).get("classification", "internal")).lower().strip()
    return level if level in LEVELS else "internal"


def classify(
    df: DataFrame,
    source_id: str,
    order: str,
    governance: Mapping[str, str] | None = None,
    *,
    match: str = "substring",
) -> DataFrame:
    """One row: classification, personal-data columns, columns and rows scanned.

    A public source holding personal data becomes confidential. An empty table keeps its configured
    level and reports nothing scanned.
    """
    level = configured_level(governance)
    scan = scan_columns(df, order, match=match)
    found = F.col("pii_type").isNotNull() & (F.col("scanned_rows") > 0)
    # One row per column of the table, so the collected map is as small as the schema.
    folded = scan.agg(
        F.array_sort(F.collect_list(F.when(found, F.struct("column", "pii_type")))).alias("entries"),
        F.count(F.lit(1)).alias("columns"),
        F.max("scanned_rows").alias("rows"),
    )
    has_pii = F.size("entries") > 0
    return folded.select(
        F.lit(source_id).alias("source_id"),
        F.when(has_pii & F.lit(level == "public"), "confidential").otherwise(level).alias("classification"),
        F.map_from_entries("entries").alias("pii_fields"),
        F.when(F.col("rows") > 0, F.col("columns")).otherwise(0).alias("scanned_columns"),
        F.col("rows").alias("scanned_rows"),
    )
