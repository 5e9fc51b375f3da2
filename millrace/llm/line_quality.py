"""Line-first cleaning: judge every line, remove the failures, reject documents that lose too much.

All of it is column expressions on one row, so a document never moves. Defined results: a null or empty
text has no words and fails the base rule; blank lines are neither judged nor counted; repeated rows are
judged each by themselves; extra columns pass through, and result columns replace columns of their name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import count_of, parts, whole
from millrace.operators.once import with_once

SYMBOLS = "#*$%&|<>"
SEPARATORS = ("|", "||", "»", "«", "›", "‹", ">", ">>", "•", "·", "/")


@dataclass(frozen=True)
class LineRules:
    """Limits of the line and document rules; percentages are whole numbers so that ties are exact."""

    fewest_words: int = 50
    most_repeat_percent: int = 50
    most_symbol_percent: int = 10
    most_separator_percent: int = 25
    fragment_words: int = 4
    boilerplate_words: int = 12
    most_lost_percent: int = 30
    closers: str = ".!?:;\"'”’»)]…。！？"
    boilerplate: tuple[str, ...] = field(default=(
        "accept cookies", "all cookies", "click here", "cookie policy", "cookie settings", "create an account",
        "enable javascript", "follow us", "forgot password", "forgot your password", "items in cart", "javascript is disabled",
        "leave a comment", "log in", "newsletter", "powered by", "privacy policy", "read more", "related articles",
        "share on", "share this", "sign in", "sign up", "skip to content", "subscribe", "terms of service", "terms of use",
        "use of cookies", "uses cookies",
    ))


def repeated_window_words(words: Column, hashes: Column) -> Column:
    """Words that lie in a three-word window which the text holds twice or more.

    ``hashes`` has one number for each window. Equal windows have equal numbers, so a text whose numbers
    all differ repeats nothing and is done. In the others the windows themselves are sorted with their
    places, so that equal ones are neighbours: one sort instead of a count per window.
    """
    windows = F.size(words) - 2

    def column_from(start: int) -> Column:
        return F.slice(words, F.lit(start), windows)

    ordered = F.sort_array(F.arrays_zip(
        hashes.alias("h"), column_from(1).alias("a"), column_from(2).alias("b"), column_from(3).alias("c"),
        F.sequence(F.lit(0), windows - 1).alias("at")))

    def same(x: Column, y: Column) -> Column:
        return (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    twins = F.zip_with(
        F.slice(ordered, F.lit(1), windows - 1), F.slice(ordered, F.lit(2), windows - 1),
        lambda x, y: F.when(same(x, y), F.array(x["at"], y["at"])))
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda pair: pair.isNotNull()))))
    covered = F.aggregate(
        places, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("sum")),
        lambda s, p: F.struct(p.alias("last"), (s["sum"] + F.least(F.lit(3), p - s["last"])).alias("sum")),
        lambda s: s["sum"])
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered).otherwise(F.lit(0).cast("long"))


def window_hashes(words: Column) -> Column:
    """One number for each three-word window."""
    return F.when(F.size(words) < 3, F.array().cast("array<long>")).otherwise(F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2))))


def measured_lines(text: Column) -> Column:
    """Every line with its words and its text without outer white space."""
    return F.transform(F.split(text, "\n"), lambda line: F.struct(
        line.alias("line"), parts(line).alias("words"), F.btrim(line, F.lit(" \t\x0b\x0c\r")).alias("bare")))


def line_fault(line: Column, rules: LineRules) -> Column:
    """Name of the first rule that a line of :func:`measured_lines` breaks, or null."""
    bare, n_words = line["bare"], F.size(line["words"])
    separators = F.when(bare.rlike("[|»«›‹>•·/]"), F.size(F.filter(line["words"], lambda w: w.isin(*SEPARATORS)))).otherwise(0)
    phrases = "|".join(rules.boilerplate)
    return (
        F.when(bare == "", None)
        .when(separators >= F.greatest(F.lit(2), F.ceil(n_words * rules.most_separator_percent / 100)), "navigation")
        .when(count_of(bare, "#*$%&<>") * 100 > F.length(bare) * rules.most_symbol_percent, "punctuation")
        .when(~bare.rlike(r"[\p{L}\p{N}]"), "punctuation")
        .when((n_words < rules.fragment_words) & ~F.lit(rules.closers).contains(F.right(bare, F.lit(1))), "punctuation")
        .when((n_words < rules.boilerplate_words) & bare.endswith("..."), "punctuation")
        .when((n_words <= rules.boilerplate_words) & F.lower(bare).rlike(rf"(?<![a-z])(?:{phrases})(?![a-z])"), "boilerplate")
    )


def clean_lines(df: DataFrame, text: str = "text", rules: LineRules | None = None) -> DataFrame:
    """Add the counts, the cleaned text and the verdict to every document.

    New columns: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, cleaned_text,
    n_lines_removed, chars_removed, kept``.
    """
    rules = rules or LineRules()
    body = whole(F.col(f"`{text}`"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "cleaned_text",
             "n_lines_removed", "chars_removed", "kept"]
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    judged = df.select(
        *rest, body.alias("_q_text"), parts(body).alias("_q_words"), measured_lines(body).alias("_q_lines"),
    ).select(
        *rest, "_q_text", "_q_words", window_hashes(F.col("_q_words")).alias("_q_hashes"),
        F.transform("_q_lines", lambda x: F.struct(
            x["line"].alias("line"), line_fault(x, rules).alias("fault"), (x["bare"] != "").alias("worded"),
        )).alias("_q_lines"),
    )
    worded = F.transform(F.filter("_q_lines", lambda x: x["worded"]), lambda x: x["line"])
    counted = judged.select(
        *rest, "_q_text", "_q_lines", worded.alias("_q_worded"),
        F.size("_q_words").cast("long").alias("n_words"),
        F.length(F.array_join("_q_words", "")).cast("long").alias("word_chars"),
        count_of(F.col("_q_text"), SYMBOLS).cast("long").alias("n_symbols"),
        repeated_window_words(F.col("_q_words"), F.col("_q_hashes")).alias("n_repeat_words"),
        F.filter("_q_lines", lambda x: x["fault"].isNotNull()).alias("_q_failing"),
    )
    # Held once, so that a filter on a result does not repeat all of this below itself.
    summed = with_once(counted, "_q_held", F.struct(
        "n_words", "word_chars", "n_symbols",
        (F.size("_q_worded") - F.size(F.array_distinct("_q_worded"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", F.length("_q_text").alias("_q_length"),
        ((F.col("n_words") < rules.fewest_words)
         | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.most_repeat_percent)).alias("base_failed"),
        F.array_join(F.transform(F.filter("_q_lines", lambda x: x["fault"].isNull()), lambda x: x["line"]), "\n")
        .alias("cleaned_text"),
        F.size("_q_failing").cast("long").alias("n_lines_removed"),
        F.aggregate("_q_failing", F.lit(0).cast("long"), lambda s, x: s + F.length(x["line"])).alias("chars_removed"),
    )).select(*rest, "_q_held.*")
    lost_little = F.col("chars_removed") * 100 <= F.col("_q_length") * rules.most_lost_percent
    return summed.withColumn("kept", ~F.col("base_failed") & lost_little).drop("_q_length")
