"""Data-quality checks and the pass/fail gate.

All checks that look at one row at a time are folded into a single aggregate over the table. A
uniqueness, referential or SQL check adds one aggregate of its own. The outcome is a small table
with one row per check and column, from which the gate is computed.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.functions import blank, event_epoch, iso_epoch, iso_is_zoneless, to_number

log = logging.getLogger(__name__)

CHECK_TYPES = (
    "not_null", "valid_range", "unique_key", "row_count", "regex_match", "referential",
    "freshness", "custom_sql",
)
CHECK_ALIASES = {"non_null": "not_null"}
# Severity of a check that does not name one.
DEFAULT_SEVERITY = {
    "not_null": "critical", "valid_range": "warning", "unique_key": "critical",
    "row_count": "critical", "regex_match": "warning", "referential": "critical",
    "freshness": "warning", "custom_sql": "critical",
}
SAMPLE_SIZE = 5

OUTCOME_SCHEMA = T.StructType([
    T.StructField("check_id", T.IntegerType()),
    T.StructField("check_type", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("failed_count", T.LongType()),
    T.StructField("violated", T.BooleanType()),
    T.StructField("message", T.StringType()),
])


@dataclass
class Check:
    """One check as configured, with its columns and the remaining settings."""

    check_id: int
    check_type: str
    columns: list[str] = field(default_factory=list)
    params: dict[str, Any] = field(default_factory=dict)

    @property
    def column(self) -> str | None:
        return self.columns[0] if self.columns else None

    @property
    def severity(self) -> str:
        default = DEFAULT_SEVERITY[self.check_type]
        if self.check_type == "not_null":
            return default
        given = str(self.params.get("severity", default))
        return given if given in ("critical", "warning") else default

    @property
    def error_severity(self) -> str:
        """Severity used when the check itself fails to run."""
        given = str(self.params.get("severity", "critical")).lower()
        return "critical" if given == "critical" else "warning"


# The names that a setting may have. The first one that is filled counts.
SETTING_NAMES = {"kind": ("type", "check_type"), "on": ("columns", "fields", "column", "field")}
SETTING_OF = {name: (setting, rank) for setting, names in SETTING_NAMES.items() for rank, name in enumerate(names)}


def _settings(entry: Mapping[str, Any]) -> tuple[dict[str, Any], dict[str, Any]]:
    """The named settings of a configuration entry, and what else it holds."""
    ranked: dict[str, tuple[int, Any]] = {}
    rest: dict[str, Any] = {}
    for name, value in entry.items():
        setting, rank = SETTING_OF.get(name, (None, 0))
        if setting is None:
            rest[name] = value
        elif value and rank <= ranked.get(setting, (rank, None))[0]:
            ranked[setting] = (rank, value)
    return {setting: value for setting, (_, value) in ranked.items()}, rest


def parse_checks(configs: Iterable[Mapping[str, Any]]) -> list[Check]:
    """Checks from configuration entries; entries of an unknown type are skipped."""
    known = []
    for entry in configs:
        settings, rest = _settings(entry)
        kind = str(settings.get("kind", "")).lower()
        kind = CHECK_ALIASES.get(kind, kind)
        if kind in CHECK_TYPES:
            on = settings.get("on", ())
            known.append((kind, [on] if isinstance(on, str) else list(map(str, on)), rest))
        else:
            log.warning("there is no check of this type: %s", entry)
    return [Check(i, *check) for i, check in enumerate(known)]


def _as_checks(checks: Iterable[Check | Mapping[str, Any]]) -> list[Check]:
    checks = list(checks)
    return checks if all(isinstance(c, Check) for c in checks) else parse_checks(checks)


def _name(column: str) -> Column:
    """A column or, with dots, a field inside a struct column."""
    return F.col(column)


# ---------------------------------------------------------------- row rules


@dataclass
class _RowRule:
    """A measure over single rows: one aggregate column, and the test a failing value meets."""

    check: Check
    column: str | None
    failed: Column
    message: Any
    fails: Column | None = None
    violated: Column | None = None


def _row_rules(df: DataFrame, check: Check, as_of: datetime, zoneless: str) -> list[_RowRule]:
    def type_of(column: str) -> T.DataType:
        return df.select(_name(column)).schema[0].dataType

    if check.check_type == "not_null":
        rules = []
        for column in check.columns:
            c = _name(column)
            bad = c.isNull()
            if isinstance(type_of(column), T.StringType):
                bad = bad | blank(c)
            rules.append(_RowRule(check, column, F.count_if(bad), f"{column} has empty values", bad))
        return rules

    if check.check_type == "valid_range" and check.column:
        c = _name(check.column)
        number = to_number(c, type_of(check.column))
        # NaN compares false with everything here, but is the greatest double for Spark.
        real = ~F.isnan(number)
        tests = [c.isNotNull() & number.isNull()]
        if check.params.get("min") is not None:
            tests.append(real & (number < float(check.params["min"])))
        if check.params.get("max") is not None:
            tests.append(real & (number > float(check.params["max"])))
        failed = reduce(lambda a, b: a + b, [F.count_if(t) for t in tests])
        fails = F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))
        return [_RowRule(check, check.column, failed, f"{check.column} has values out of range", fails)]

    if check.check_type == "row_count":
        low = int(check.params.get("min_rows", 0))
        high = check.params.get("max_rows")
        n = F.count(F.lit(1))
        outside = n < low
        bounds = f" rows, expected {low} or more"
        if high is not None:
            outside = outside | (n > int(high))
            bounds = f" rows, expected {low} to {high}"
        message = F.concat(n.cast("string"), F.lit(bounds))
        return [_RowRule(check, None, outside.cast("bigint"), message)]

    if check.check_type == "regex_match" and check.column:
        pattern = check.params.get("pattern") or check.params.get("regex")
        if not pattern:
            return []
        error = _pattern_error(df, pattern)
        if error:
            rule = _RowRule(check, check.column, F.lit(0).cast("bigint"), f"the pattern cannot be used: {error}")
            rule.violated = F.lit(True)
            return [rule]
        fails = ~_name(check.column).cast("string").rlike(pattern)
        return [
            _RowRule(check, check.column, F.count_if(fails), f"{check.column} has values unlike the pattern",
                     F.coalesce(fails, F.lit(False)))
        ]

    if check.check_type == "freshness" and check.column and check.params.get("max_age_hours") is not None:
        hours = float(check.params["max_age_hours"])
        c, data_type = _name(check.column), type_of(check.column)
        if isinstance(data_type, T.DateType):
            data_type = T.NullType()
        epoch = event_epoch(c, data_type)
        oldest = as_of.timestamp() - hours * 3600
        fails = c.isNotNull() & (epoch.isNull() | (epoch < oldest))
        failed = F.count_if(fails)
        message: Any = f"{check.column} has values more than {hours} hours old"
        rule = _RowRule(check, check.column, failed, message, fails)
        if zoneless == "error" and isinstance(data_type, T.StringType):
            # A time without an offset cannot be compared with one that has it: the check errors.
            mixed = F.count_if(iso_is_zoneless(c) & iso_epoch(c).isNotNull()) > 0
            rule.failed = F.when(mixed, F.count(F.lit(1))).otherwise(failed)
            rule.message = F.when(mixed, "the check failed: a time has no offset").otherwise(message)
        return [rule]

    return []


def _pattern_error(df: DataFrame, pattern: str) -> str | None:
    """Reason the Java regex engine rejects a pattern, found by folding it on a constant row."""
    try:
        df.sparkSession.range(1).select(F.lit("").rlike(pattern)).first()
        return None
    except Exception as exc:  # the error class differs between folded and executed patterns
        return str(exc).splitlines()[0]


def _outcome(rule: _RowRule, failed: Column, message: Column) -> Column:
    violated = rule.violated if rule.violated is not None else failed > 0
    return F.struct(
        F.lit(rule.check.check_id).alias("check_id"),
        F.lit(rule.check.check_type).alias("check_type"),
        F.lit(rule.column).cast("string").alias("column"),
        F.lit(rule.check.severity if rule.violated is None else "critical").alias("severity"),
        F.coalesce(failed, F.lit(0)).cast("bigint").alias("failed_count"),
        F.coalesce(violated, F.lit(False)).alias("violated"),
        message.cast("string").alias("message"),
    )


def _row_outcomes(df: DataFrame, rules: Sequence[_RowRule]) -> DataFrame:
    """One pass over the table for all row rules, then one output row per rule."""
    measures = []
    for i, rule in enumerate(rules):
        message = rule.message if isinstance(rule.message, Column) else F.lit(rule.message)
        measures += [rule.failed.alias(f"f{i}"), message.alias(f"m{i}")]
    # A literal message is not an aggregate, so it is attached after the fold.
    folded = df.agg(*[m for m, r in zip(measures[0::2], rules)],
                    *[m for m, r in zip(measures[1::2], rules) if isinstance(r.message, Column)])
    outcomes = [
        _outcome(r, F.col(f"f{i}"), F.col(f"m{i}") if isinstance(r.message, Column) else F.lit(r.message))
        for i, r in enumerate(rules)
    ]
    return folded.select(F.explode(F.array(*outcomes)).alias("o")).select("o.*")


# ---------------------------------------------------------------- table rules


def duplicate_counts(df: DataFrame, columns: Sequence[str], *, count_nulls: bool = False) -> DataFrame:
    """One row: surplus rows (count minus one per key) and number of duplicated keys.

    Keys holding a null are left out unless ``count_nulls``.
    """
    keyed = df.select(*[_name(c).alias(f"k{i}") for i, c in enumerate(columns)])
    if not count_nulls:
        keyed = keyed.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keyed.columns]))
    per_key = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_groups"),
    )


def orphan_values(child: DataFrame, child_column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values that no parent row holds, with their row counts; null children are skipped.

    Child and parent values meet in one aggregate rather than a join. Each task first folds its
    repeated values, so a value that fills a third of the table costs one row per task.
    """
    used = child.select(_name(child_column).alias("value"), F.lit(1).alias("uses"), F.lit(False).alias("known"))
    known = parent.select(_name(parent_column).alias("value"), F.lit(0).alias("uses"), F.lit(True).alias("known"))
    per_value = (
        used.unionByName(known)
        .filter(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.sum("uses").alias("uses"), F.bool_or("known").alias("known"))
    )
    return per_value.filter(~F.col("known") & (F.col("uses") > 0)).select("value", "uses")


def _table_outcome(df: DataFrame, check: Check, parents: Mapping[str, DataFrame], view: str) -> DataFrame | None:
    """A one-row DataFrame for a check that needs its own aggregate, or None when it is not set up."""
    if check.check_type == "unique_key" and check.columns:
        counts = duplicate_counts(df, check.columns, count_nulls=bool(check.params.get("count_nulls")))
        failed, column = F.col("surplus_rows"), ",".join(check.columns)
        message = f"repeated keys in {column}"
    elif check.check_type == "referential":
        child = check.params.get("child_column") or check.params.get("fk_column")
        parent = check.params.get("parent_column") or check.params.get("pk_column")
        if not child or not parent:
            return None
        parent_df = parents[check.params["parent"]] if check.params.get("parent") else df
        counts = orphan_values(df, child, parent_df, parent).agg(F.sum("uses").alias("n"))
        failed, column = F.coalesce(F.col("n"), F.lit(0)), child
        message = f"{child} has values that {parent} lacks"
    elif check.check_type == "custom_sql" and (check.params.get("sql") or check.params.get("query")):
        # Rows the statement returns are failures; it reads the table under the name `view`.
        counts = df.sparkSession.sql(
            check.params.get("sql") or check.params.get("query"), **{view: df}
        ).agg(F.count(F.lit(1)).alias("n"))
        failed, column = F.col("n"), None
        message = "the statement found rows"
    else:
        return None
    rule = _RowRule(check, column, failed, message)
    return counts.select(_outcome(rule, failed, F.lit(message)).alias("o")).select("o.*")


# ---------------------------------------------------------------- entry points


def evaluate_checks(
    df: DataFrame,
    checks: Iterable[Check | Mapping[str, Any]],
    *,
    as_of: datetime | None = None,
    parents: Mapping[str, DataFrame] | None = None,
    zoneless: str = "error",
    view: str = "data",
) -> DataFrame:
    """One row per check and column, passed or not (:data:`OUTCOME_SCHEMA`).

    A check that cannot be planned (a column that does not exist, bad SQL) becomes a violation that
    counts every row. ``parents`` names the tables referential checks may point to. In ``custom_sql``
    text the table is written ``{data}``. ``zoneless`` says what a time without offset means for
    freshness: ``"error"`` fails the whole check, ``"utc"`` reads it as UTC.
    """
    todo = _as_checks(checks)
    as_of = as_of or datetime.now(timezone.utc)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)

    rules: list[_RowRule] = []
    tables: list[DataFrame] = []
    for check in todo:
        try:
            found = _row_rules(df, check, as_of, zoneless)
            table = None if found else _table_outcome(df, check, parents or {}, view)
        except (AnalysisException, ParseException, KeyError) as exc:
            broken = _RowRule(check, check.column, F.count(F.lit(1)),
                              f"the check failed: {str(exc).splitlines()[0]}")
            broken.check = Check(check.check_id, check.check_type, check.columns,
                                 {**check.params, "severity": check.error_severity})
            broken.violated = F.lit(True) if check.error_severity == "critical" else None
            found, table = [broken], None
        rules += found
        if table is not None:
            tables.append(table)
    parts = ([_row_outcomes(df, rules)] if rules else []) + tables
    if not parts:
        return df.sparkSession.createDataFrame([], OUTCOME_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def violations(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter("violated").drop("violated")


def gate(
    outcomes: DataFrame,
    checks_run: int,
    source_id: str = "",
    *,
    fail_on_critical: bool = True,
    warn_threshold: float = 0.95,
) -> DataFrame:
    """One row: checks run, passed and failed, pass rate, and whether the table passes.

    A critical violation fails the gate (unless switched off), and so does a pass rate below the
    threshold. A check that produced no row counts as passed.
    """
    bad = F.col("violated")
    counts = outcomes.agg(
        F.count_distinct(F.when(bad, F.col("check_id"))).alias("failed"),
        F.count_if(bad & (F.col("severity") == "critical")).alias("critical"),
    )
    run = F.lit(checks_run).cast("bigint")
    rate = F.when(run > 0, (run - F.col("failed")) / run).otherwise(F.lit(1.0))
    stopped = (F.col("critical") > 0) & F.lit(fail_on_critical)
    return counts.select(
        F.lit(source_id).alias("source_id"),
        run.alias("checks_run"),
        (run - F.col("failed")).alias("checks_passed"),
        F.col("failed").alias("checks_failed"),
        F.round(rate, 6).alias("pass_rate"),
        (~stopped & (rate >= F.lit(float(warn_threshold)))).alias("passed_gate"),
    )


def sample_failures(
    df: DataFrame,
    checks: Iterable[Check | Mapping[str, Any]],
    *,
    as_of: datetime | None = None,
    n: int = SAMPLE_SIZE,
) -> DataFrame:
    """Up to ``n`` failing values per row check, smallest first, from one pass over the table.

    Each row lists the checks it fails; the rank filter limits every check inside each task.
    Values are rendered as text.
    """
    todo = _as_checks(checks)
    as_of = as_of or datetime.now(timezone.utc)
    rules = [r for c in todo for r in _row_rules(df, c, as_of, "utc") if r.fails is not None]
    if not rules:
        raise ValueError("no check with samples among those given")
    hits = F.array(*[
        F.when(F.coalesce(r.fails, F.lit(False)), F.struct(
            F.lit(r.check.check_id).alias("check_id"),
            F.lit(r.check.check_type).alias("check_type"),
            F.lit(r.column).alias("column"),
            _name(r.column).cast("string").alias("value"),
        ))
        for r in rules
    ])
    failing = df.select(F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("h")).select("h.*")
    ranked = Window.partitionBy("check_id", "check_type", "column").orderBy(F.col("value").asc_nulls_first())
    return failing.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= n)


# ---------------------------------------------------------------- gates inside a flow


def gate_measures(checks: Iterable[Mapping[str, Any]], types: Mapping[str, T.DataType]) -> dict[str, Column]:
    """Aggregate columns of a gate step, fit for ``df.observe`` as well as for ``df.agg``.

    Blank text passes ``not_null`` here. Uniqueness is not a row rule and is left out.
    """
    measures: dict[str, Column] = {"rows": F.count(F.lit(1))}
    for i, check in enumerate(checks):
        kind = CHECK_ALIASES.get(check.get("type"), check.get("type"))
        if kind == "not_null" and check.get("columns"):
            nulls = [_name(c).isNull() for c in check["columns"]]
            measures[f"{i}:not_null"] = F.count_if(reduce(lambda a, b: a | b, nulls))
            for c, test in zip(check["columns"], nulls):
                measures[f"{i}:not_null:{c}"] = F.count_if(test)
        elif kind == "valid_range":
            c = _name(check["column"])
            number = to_number(c, types[check["column"]])
            bad = c.isNotNull() & number.isNull()
            if check.get("min") is not None:
                bad = bad | (~F.isnan(number) & (number < float(check["min"])))
            if check.get("max") is not None:
                bad = bad | (~F.isnan(number) & (number > float(check["max"])))
            measures[f"{i}:valid_range"] = F.count_if(bad)
        elif kind == "row_count":
            n = F.count(F.lit(1))
            outside = n < int(check.get("min", 0))
            if check.get("max") is not None:
                outside = outside | (n > int(check["max"]))
            measures[f"{i}:row_count"] = outside.cast("bigint")
    return measures


def duplicate_groups(df: DataFrame, checks: Sequence[Mapping[str, Any]]) -> DataFrame | None:
    """Repeated keys per uniqueness check, ``check`` and ``groups``, from one aggregate over all keys; None without such checks."""
    keys = []
    for i, check in enumerate(checks):
        if check.get("type") == "unique_key" and check.get("columns"):
            columns = [_name(c) for c in check["columns"]]
            known = F.lit(True) if check.get("count_nulls") else reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
            text = F.to_json(F.struct(*[c.alias(f"k{n}") for n, c in enumerate(columns)]))
            keys.append(F.when(known, F.struct(F.lit(i).alias("check"), text.alias("key"))))
    if not keys:
        return None
    held = df.select(F.explode(F.array_compact(F.array(*keys))).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return held.filter("n > 1").groupBy(F.col("k.check").alias("check")).agg(F.count(F.lit(1)).alias("groups"))


def gate_findings(measured: Mapping[str, int]) -> list[dict[str, Any]]:
    """The failed measures of a gate step: position of the check, its rule, the column of a part, and the count."""
    found = []
    for name in sorted((n for n, failed in measured.items() if n != "rows" and failed), key=lambda n: (int(n.split(":")[0]), n)):
        position, rule, *column = name.split(":", 2)
        found.append({"check": int(position), "rule": rule, "column": column[0] if column else None, "failed": measured[name]})
    return found
