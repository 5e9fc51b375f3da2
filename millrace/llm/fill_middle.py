r"""Fill-in-middle examples by a counted regular expression.

``regexp_count`` tells how many units (tokens with the white space before them) a text has. Two cut points a <= b
make a pattern of the row's own, with possessive groups of exactly ``a`` and ``b - a`` units and the rest; one
match of it writes prefix, middle and suffix in their new order. Possessive groups are walked in a loop, so texts
of any length neither recurse nor come back. All of it is column functions on one row, and nothing is shuffled.

Draws are the first four 8-digit groups of the SHA-256 of seed and key, so a row is always cut alike.

Defined results: a null or empty text stays as it is (form ``plain``, no units for an empty one); a null key draws like
an empty one; texts that hold a marker are left plain, because they could not be read back; rows that
repeat are cut alike; extra columns pass through and give way to result columns of the same name. An empty table
gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import whole
from millrace.operators.once import with_once

WHITE = r"[\x20\x09-\x0D]"
DARK = r"[^\x20\x09-\x0D]"
UNIT = rf"(?:{WHITE}*+{DARK}++|{WHITE}++)"
RESULTS = ("fim_units", "fim_form", "fim_text", "fim_prefix_chars", "fim_middle_chars")


@dataclass(frozen=True)
class Markers:
    """Control strings before prefix, suffix and middle. None may end with what another one begins with."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers that depend on seed and key alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def cut_pattern(first: Column, second: Column) -> Column:
    """Three groups over a whole text: ``first`` units, the next ``second`` units, and the rest."""
    return F.concat(
        F.lit(rf"(?s)\A({UNIT}{{"), first.cast("string"), F.lit(rf"}}+)({UNIT}{{"), second.cast("string"), F.lit(r"}+)(.*+)\z"))


def _literal(text: str) -> str:
    """The text as it stands in a replacement."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def _parts(text: Column, markers: Markers) -> Column:
    """What stands between the markers, in written order."""
    pattern = "|".join("\\Q" + m + "\\E" for m in markers.all())
    return F.split(text, pattern, -1)


def fill_in_middle(df: DataFrame, text: str = "text", key: str = "doc_id", *, seed: int = 42, percent: int = 50,
                   spm_percent: int = 80, markers: Markers | None = None) -> DataFrame:
    """Add the fill-in-middle form of every whole text.

    New columns: ``fim_units``, ``fim_form`` (plain, psm or spm), ``fim_text``, and ``fim_prefix_chars`` and
    ``fim_middle_chars``, which are null for plain texts. ``percent`` of the texts are cut, ``spm_percent`` of those get
    the suffix first.
    """
    markers = markers or Markers()
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in RESULTS]
    h1, h2, h3, h4 = draws(F.col(f"`{key}`"), seed)
    body = F.col("_f_text")
    units = F.regexp_count(body, F.lit(UNIT)).cast("long")
    read = df.select(*rest, whole(F.col(f"`{text}`")).alias("_f_text"), *[h.alias(f"_f_h{i}") for i, h in enumerate((h1, h2, h3, h4))])
    held = with_once(read, "_f_units", units)
    marked = F.contains(body, F.lit(markers.prefix)) | F.contains(body, F.lit(markers.suffix)) | F.contains(body, F.lit(markers.middle))
    plain = (body == "") | marked | (F.col("_f_h2") % 100 >= percent)
    form = F.when(plain, "plain").when(F.col("_f_h3") % 100 < spm_percent, "spm").otherwise("psm")
    one, other = F.col("_f_h0") % (F.col("_f_units") + 1), F.col("_f_h1") % (F.col("_f_units") + 1)
    drawn = held.select(*rest, "_f_text", "_f_units", form.alias("_f_form"), F.least(one, other).alias("_f_a"), F.greatest(one, other).alias("_f_b"))
    p, s, m = map(_literal, markers.all())
    order = F.when(F.col("_f_form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    written = F.when(F.col("_f_form") == "plain", body).otherwise(
        F.regexp_replace(body, cut_pattern(F.col("_f_a"), F.col("_f_b") - F.col("_f_a")), order))
    # Held once, so that the lengths do not repeat the match.
    told = with_once(drawn, "_f_out", written)
    parts = _parts(F.col("_f_out"), markers)
    prefix = F.when(F.col("_f_form") == "psm", F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(2)))
    lengths = with_once(told, "_f_lengths", F.when(F.col("_f_form") != "plain", F.struct(
        F.length(prefix).cast("long").alias("prefix"), F.length(F.get(parts, F.lit(3))).cast("long").alias("middle"))))
    return lengths.select(
        *rest, F.col("_f_units").alias("fim_units"), F.col("_f_form").alias("fim_form"), F.col("_f_out").alias("fim_text"),
        F.col("_f_lengths.prefix").alias("fim_prefix_chars"), F.col("_f_lengths.middle").alias("fim_middle_chars"))


def restore(form: Column, text: Column, markers: Markers | None = None) -> Column:
    """The source text, from a written text and its form alone."""
    parts = _parts(text, markers or Markers())
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(text)
