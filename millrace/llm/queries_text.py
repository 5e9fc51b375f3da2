"""Queries over single texts: quality, licenses, secrets, personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.common import table
from millrace.llm.license_scan import BASE_PHRASES, BASE_SCORE, build_rules, scan_licenses, spaced
from millrace.llm.line_quality import SEPARATORS, LineRules, clean_lines
from millrace.llm.pii_transduce import KINDS, find_personal_data
from millrace.llm.registry import query
from millrace.llm.secret_links import link_secrets


RULES = LineRules()


def _quality_sql() -> str:
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    separators = ", ".join(quoted(s) for s in SEPARATORS)
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
    windows AS (
        SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
    twins AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
    repeats AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twins, (SELECT unnest([0, 1, 2]) AS o) GROUP BY doc_id),
    lines AS (
        SELECT doc_id, line, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS bare,
               list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS lw
        FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
    judged AS (
        SELECT doc_id, line, bare, CASE
            WHEN bare = '' THEN false
            WHEN len(list_filter(lw, lambda x: x IN ({separators}))) >= greatest(2, ceil(len(lw) * {RULES.most_separator_percent} / 100.0)) THEN true
            WHEN (length(bare) - length(translate(bare, '#*$%&<>', ''))) * 100 > length(bare) * {RULES.most_symbol_percent} THEN true
            WHEN NOT regexp_matches(bare, '[\p{{L}}\p{{N}}]') THEN true
            WHEN len(lw) < {RULES.fragment_words} AND NOT contains({quoted(RULES.closers)}, right(bare, 1)) THEN true
            WHEN len(lw) < {RULES.boilerplate_words} AND ends_with(bare, '...') THEN true
            ELSE len(lw) <= {RULES.boilerplate_words}
                AND regexp_matches(lower(bare), '(^|[^a-z])(?:{"|".join(RULES.boilerplate)})($|[^a-z])') END AS fails
        FROM lines),
    by_line AS (
        SELECT doc_id, count(*) FILTER (bare <> '') - count(DISTINCT line) FILTER (bare <> '') AS n_dup_lines,
               count(*) FILTER (fails) AS n_lines_removed, coalesce(sum(length(line)) FILTER (fails), 0) AS chars_removed
        FROM judged GROUP BY doc_id),
    counted AS (
        SELECT w.doc_id, t, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
               length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, n_dup_lines, coalesce(n, 0) AS n_repeat_words,
               n_lines_removed, chars_removed
        FROM w JOIN by_line USING (doc_id) LEFT JOIN repeats USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < {RULES.fewest_words} OR 100 * n_repeat_words > {RULES.most_repeat_percent} * n_words AS base_failed,
           NOT base_failed AND chars_removed * 100 <= length(t) * {RULES.most_lost_percent} AS kept,
           n_lines_removed, CAST(chars_removed AS BIGINT) AS chars_removed
    FROM counted"""


@query("op8_line_quality", _quality_sql())
def op8_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    return clean_lines(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines_removed", "chars_removed")


def _license_sql() -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    rules = ",\n".join(
        f"({r['number']}, {r['priority']}, {text(r['label'])}, {text(r['keyword'])}, [{', '.join(map(text, r['partners']))}]::VARCHAR[], "
        f"{text(spaced(r['pattern']))}, {r['weight']}::DOUBLE)" for r in build_rules())
    phrases = ", ".join(f"({text(label)}, {text(spaced(phrase))})" for phrase, label in BASE_PHRASES.items())
    count = "CAST((length({0}) - length(replace({0}, ' ', ''))) / 2 AS BIGINT)"
    places = f"""
        SELECT * EXCLUDE (gaps, found, k), list_sum(list_transform(gaps[1:k], lambda g: {count.format('g')}))
               + coalesce(list_sum(list_transform(found[1:k - 1], lambda f: {count.format('f')})), 0) AS first,
               first + {count.format('found[k]')} AS past
        FROM (SELECT *, unnest(range(1, len(found) + 1)) AS k FROM (
            SELECT *, string_split_regex(line, pattern) AS gaps, regexp_extract_all(line, pattern) AS found FROM {{0}}))"""
    return rf"""
    WITH rules(number, priority, label, keyword, partners, pattern, weight) AS (VALUES {rules}),
    phrases(label, pattern) AS (VALUES {phrases}),
    w AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
        FROM documents),
    l AS (SELECT doc_id, words, len(words) AS n_words, ' ' || array_to_string(words, '  ') || ' ' AS line FROM w),
    opened AS (
        SELECT doc_id, line, number, priority, label, pattern, weight FROM l JOIN rules ON list_contains(words, keyword)
        WHERE (len(partners) = 0 OR list_has_any(words, partners)) AND regexp_matches(line, pattern)),
    based AS (SELECT doc_id, line, label, pattern FROM l, phrases WHERE contains(line, pattern)),
    hits AS ({places.format('opened')}),
    base AS ({places.format('based')}),
    kept AS (
        SELECT * FROM hits h WHERE NOT EXISTS (
            SELECT 1 FROM hits g WHERE g.doc_id = h.doc_id AND g.first <= h.first AND g.past >= h.past AND g.priority <= h.priority
            AND (g.first, -g.past, g.priority, g.number) < (h.first, -h.past, h.priority, h.number))),
    based_on AS (
        SELECT doc_id, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
    named AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
              FROM (SELECT doc_id, label FROM kept UNION ALL SELECT doc_id, label FROM base) GROUP BY doc_id),
    best AS (SELECT doc_id, max(weight) AS weight FROM kept GROUP BY doc_id)
    SELECT doc_id, n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
           greatest(coalesce(weight, 0), CASE WHEN n_base > 0 THEN {BASE_SCORE} ELSE 0 END)::DOUBLE AS score
    FROM l LEFT JOIN based_on USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN best USING (doc_id)"""


@query("op10_license_scan", _license_sql())
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


@query("op3_secret_links")
def op3_secret_links(spark: SparkSession, folder: str) -> DataFrame:
    found = link_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("secret_spans", lambda x: x["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id",
        *[F.size(F.filter("secret_spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
          for kind in ("assign", "access", "hex")],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("secret_spans")).alias("spans"),
        F.size("credentials").cast("long").alias("n_credentials"))


@query("op2_pii_transduce")
def op2_pii_transduce(spark: SparkSession, folder: str) -> DataFrame:
    found = find_personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("pii_spans", lambda x: x["disguised"] == "no")
    return found.select(
        "doc_id",
        *[F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("pii_spans")).alias("spans"))
