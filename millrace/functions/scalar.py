"""Column functions. Every one is a composition of built-ins, so it stays inside the JVM."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, functions as F, types as T

# The texts read as true, and the text forms of a number and of an ISO-8601 time.
TRUE_TEXTS = ("1", "true", "yes", "y")
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?|nan))\s*$"
ISO_DATE = r"\d{4}-\d{2}-\d{2}"
ISO_CLOCK = r"\d{2}:\d{2}(:\d{2}([.,]\d+)?)?"
ISO_OFFSET = r"(Z|[+-]\d{2}:?\d{2})"
ISO_PATTERN = rf"^{ISO_DATE}([T ]{ISO_CLOCK}{ISO_OFFSET}?)?$"
ISO_ZONED = rf"^{ISO_DATE}[T ]{ISO_CLOCK}{ISO_OFFSET}$"

# The white-space characters of Unicode.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Digits of a payment card number.
SHORTEST_CARD, LONGEST_CARD = 13, 19

# Error categories with the substrings that select them; the first hit decides.
ERROR_CATEGORIES = (
    ("timeout", ("timeout",)),
    ("http", ("http", "status")),
    ("auth", ("auth", "403", "401")),
    ("configuration", ("config",)),
)


def _col(value: Any) -> Column:
    return value if isinstance(value, Column) else F.col(value)


# ---------------------------------------------------------------- predicates

_OPERATORS = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<>": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def null_compare(left: Column, op: str, right: Column) -> Column:
    """Two-valued comparison: null equals null, differs from any value, and orders with nothing."""
    if op == "=":
        return left.eqNullSafe(right)
    if op in ("!=", "<>"):
        return ~left.eqNullSafe(right)
    return F.coalesce(_OPERATORS[op](left, right), F.lit(False))


def predicate(
    column: str | Column,
    op: str,
    value: Any = None,
    *,
    null_safe: bool = False,
    numeric: bool = False,
) -> Column:
    """One comparison or null test.

    ``numeric=True`` is for text columns holding mixed values: what does not parse as a number
    compares false instead of failing the job.
    """
    left = _col(column)
    key = " ".join(op.lower().split())
    if key == "is null":
        return left.isNull()
    if key == "is not null":
        return left.isNotNull()
    if key not in _OPERATORS:
        raise ValueError(f"unknown comparison {op!r}")
    right = value if isinstance(value, Column) else F.lit(value)
    if numeric:
        return F.coalesce(_OPERATORS[key](number_text(left), right.cast("double")), F.lit(False))
    return null_compare(left, key, right) if null_safe else _OPERATORS[key](left, right)


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(True)


# ---------------------------------------------------------------- arithmetic


def divide(a: Column, b: Column, *, zero_as_null: bool = False) -> Column:
    """True division; a zero divisor fails the job unless ``zero_as_null``."""
    return F.try_divide(a.cast("double"), b.cast("double")) if zero_as_null else a / b


def floor_mod(a: Column, b: Column) -> Column:
    """Remainder with the sign of the divisor, exact for integers and doubles."""
    rest = a % b
    return F.when((rest != 0) & ((rest < 0) != (b < 0)), rest + b).otherwise(rest)


def floor_div(a: Column, b: Column, *, integral: bool = False) -> Column:
    """Quotient rounded towards minus infinity.

    ``integral=True`` keeps 64-bit exactness for integer columns; otherwise the result is a double
    computed from the exact remainder, so ``1 // 0.1`` is 9 and not 10.
    """
    if integral:
        quotient = F.call_function("div", a, b)
        rest = a % b
        return F.when((rest != 0) & ((rest < 0) != (b < 0)), quotient - 1).otherwise(quotient)
    x, y = a.cast("double"), b.cast("double")
    return F.round((x - floor_mod(x, y)) / y)


def power(a: Column, b: Column) -> Column:
    return F.pow(a, b)


# ---------------------------------------------------------------- text and numbers


def strip_text(c: Column, side: str = "both") -> Column:
    """Drop white space of any kind, not only blanks, from both ends or from one of them."""
    trim = {"both": F.trim, "left": F.ltrim, "right": F.rtrim}[side]
    return trim(c, F.lit(WHITE_SPACE))


def blank(c: Column) -> Column:
    """Text without a single visible character."""
    return ~c.rlike(r"(?U)\S")


def text_truth(c: Column) -> Column:
    """Boolean from text: the listed texts are true, any other text is false, null stays null."""
    return F.lower(c).isin(*TRUE_TEXTS)


def number_text(c: Column) -> Column:
    """Double from text; null where the text is not a number."""
    text = c.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def to_number(c: Column, data_type: T.DataType) -> Column:
    """Double from a column of any type; null where no number can be read."""
    if isinstance(data_type, T.StringType):
        return number_text(c)
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    return F.lit(None).cast("double")


def parse_count(c: Column) -> Column:
    """Bigint from a text of digits only; null for anything else."""
    return F.when(c.rlike(r"^[0-9]+$"), c.try_cast("bigint"))


def parse_measure(c: Column, placeholders: tuple[str, ...] = ("", "-")) -> Column:
    """Double from text in which placeholders stand for a missing value."""
    return F.when(~c.isin(*placeholders), c).cast("double")


def first_text(*candidates: Column) -> Column:
    """The first candidate that is neither null nor empty, else the empty text."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit(""))


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]+", "")


def luhn_valid(c: Column, digits: Column | None = None) -> Column:
    """True when the 13 to 19 digits found in the text pass the mod-10 card test.

    ``digits`` is the text reduced to its digits, for callers that have it already.
    """
    digits = digits_only(c) if digits is None else digits

    fits = F.length(digits).between(SHORTEST_CARD, LONGEST_CARD)
    return F.when(fits, F.call_function("luhn_check", digits)).otherwise(F.lit(False))


# ---------------------------------------------------------------- time


def iso_is_zoneless(c: Column) -> Column:
    """An ISO-8601 time that names no offset."""
    text = strip_text(c)
    return text.rlike(ISO_PATTERN) & ~text.rlike(ISO_ZONED)


def iso_epoch(c: Column) -> Column:
    """Seconds since 1970 of an ISO-8601 text, null when malformed. Zone-less text is UTC."""
    text = F.replace(strip_text(c), F.lit(","), F.lit("."))
    # The cast wants seconds between the minutes and an offset.
    full = F.concat(F.substring(text, 1, 16), F.lit(":00"), F.substring(text, 17, 6))
    text = F.when(F.substring(text, 17, 1).isin("Z", "+", "-"), full).otherwise(text)
    # Digits beyond microseconds are dropped.
    exact = F.regexp_replace(text, r"(\.\d{6})\d+", "$1")
    stamp = F.when(text.rlike(ISO_PATTERN), exact.try_cast("timestamp"))
    return F.unix_micros(stamp) / F.lit(1e6)


def event_epoch(c: Column, data_type: T.DataType) -> Column:
    """Seconds since 1970 from ISO text, epoch numbers, dates or timestamps (session zone UTC)."""
    if isinstance(data_type, T.StringType):
        return iso_epoch(c)
    if isinstance(data_type, T.NumericType):
        return c.cast("double")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(c.cast("timestamp")) / F.lit(1e6)
    return F.lit(None).cast("double")


# ---------------------------------------------------------------- JSON


def _json_path(path: str | None, quote: str) -> str:
    if not path:
        return "$"
    return "$" + "".join(f"[{quote}{part}{quote}]" for part in path.split("."))


def whole_json(text: Any) -> Column:
    """Variant of a text that is one JSON value and nothing else; null otherwise. Of repeated keys the last counts.

    The parser stops after the first value, so the text is parsed as the first of two elements. The second is a hash of the
    text, which the text cannot hold itself: it is only found in its place if nothing in the text closed the brackets.
    """
    text = _col(text)
    mark = F.xxhash64(text)
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]"))), "$", "array<variant>")
    # Named once, so that the text is not parsed for each use.
    return F.element_at(F.transform(F.array(listed), lambda a: F.when(
        (F.size(a) == 2) & (F.try_variant_get(F.get(a, 1), "$", "bigint") == mark), F.get(a, 0))), 1)


def json_lookup(c: Column, path: str | None) -> Column:
    """Text at a dotted path of JSON text; null when any hop is missing or not an object, or the text is not JSON."""
    found = F.try_variant_get(whole_json(c), _json_path(path, '"'), "variant")
    nested = F.schema_of_variant(found).rlike("^(OBJECT|ARRAY)")
    return F.when(nested, F.to_json(found)).otherwise(found.try_cast("string"))


def variant_lookup(c: Column, path: str | None, as_type: str) -> Column:
    """Typed value at a dotted path of a variant; null when missing or not convertible."""
    return F.try_variant_get(c, _json_path(path, '"'), as_type)


def variant_kind(c: Column, shape: Column | None = None) -> Column:
    """JSON kind of a variant: null, boolean, integer, number, string, array or object.

    ``shape`` is its schema text, for callers that have it already.
    """
    shape = F.schema_of_variant(c) if shape is None else shape
    # A whole number too long for 64 bits arrives as a decimal of 19 digits or more without a scale;
    # 3.0 arrives as DECIMAL(1,0). The pattern is only tried on decimals.
    long_integer = shape.rlike(r"^DECIMAL\((19|[2-9]\d),0\)$")
    return (
        F.when(shape.isNull() | (shape == "VOID"), "null")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape == "BIGINT", "integer")
        .when(shape.startswith("DECIMAL"), F.when(long_integer, "integer").otherwise("number"))
        .when(shape.isin("DOUBLE", "FLOAT"), "number")
        .when(shape.startswith("ARRAY"), "array")
        .when(shape.startswith("OBJECT"), "object")
        .otherwise("string")
    )


# ---------------------------------------------------------------- run logs


def error_category(message: Column) -> Column:
    """Category of an error text; blank text is ``unknown``, unmatched text is ``generic``."""
    text = F.lower(message)
    rule = F.when(message.isNull() | blank(message), "unknown")
    for category, needles in ERROR_CATEGORIES:
        rule = rule.when(any_of(*[text.contains(n) for n in needles]), category)
    return rule.otherwise("generic")


def zone_name(zone: Column) -> Column:
    """Lower-case trimmed storage zone; blank becomes ``unknown``."""
    return F.coalesce(F.nullif(strip_text(F.lower(zone)), F.lit("")), F.lit("unknown"))
