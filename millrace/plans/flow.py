"""Declarative flows: an ordered list of steps folded into one lazy DataFrame."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation, functions as F

from millrace.operators import steps as S
from millrace.operators.quality import CHECK_ALIASES, duplicate_groups, gate_findings, gate_measures
from millrace.sources.files import read_table

GATE_CHECKS = ("not_null", "valid_range", "unique_key", "row_count")
# Alternative spellings of step settings.
SETTING_ALIASES = {
    "filter": {"where": "condition"},
    "flatten": {"column": "source_column", "into": "output_columns"},
    "cast": {"columns": "type_mappings"},
}


class FlowError(ValueError):
    """A flow specification that cannot be run."""


def normalize_step(step: Mapping[str, Any]) -> dict[str, Any]:
    aliases = SETTING_ALIASES.get(step.get("type", ""), {})
    return {aliases.get(k, k): v for k, v in step.items()}


@dataclass(frozen=True)
class Rule:
    """Something a mapping must fulfil, and what to say when it does not."""

    holds: Callable[[Mapping[str, Any]], bool]
    says: str


def given(*names: str) -> tuple[Rule, ...]:
    return tuple(Rule(lambda part, name=name: name in part, f"the setting {name} is missing") for name in names)


def filled(name: str) -> Rule:
    return Rule(lambda part: name not in part or bool(part[name]), f"{name} is empty")


def _is_join(name: Any) -> bool:
    try:
        return bool(S.join_name(name))
    except ValueError:
        return False


def _check_name(check: Mapping[str, Any]) -> Any:
    return CHECK_ALIASES.get(check.get("type"), check.get("type"))


def for_check(kind: str, setting: str) -> Rule:
    return Rule(lambda check: _check_name(check) != kind or bool(check.get(setting)), f"a {kind} check names its {setting}")


# What every kind of step must fulfil, and what each entry of its list must.
STEP_RULES: dict[str, tuple[Rule, ...]] = {
    "filter": given("condition"),
    "flatten": (*given("source_column", "output_columns"), filled("output_columns")),
    "aggregate": given("group_by", "measures"),
    "derive": given("new_column", "expression"),
    "rename": given("mappings"),
    "cast": given("type_mappings"),
    "quality_gate": given("checks"),
    "join": (*given("right_source", "on"), filled("on"),
             Rule(lambda step: _is_join(step.get("how", "inner")), "this kind of join does not exist")),
}
ENTRY_RULES: dict[str, tuple[str, tuple[Rule, ...]]] = {
    "aggregate": ("measures", (
        Rule(lambda m: str(m.get("function", "")).strip().lower() in S.AGGREGATES, "there is no such aggregate"),)),
    "quality_gate": ("checks", (
        Rule(lambda c: _check_name(c) in (*GATE_CHECKS, None), "a gate has no such check"),
        for_check("not_null", "columns"), for_check("valid_range", "column"), for_check("unique_key", "columns"))),
}
SPEC_RULES = given("transform_id", "source", "steps", "output")
OUTPUT_RULES = given("table", "format")


def _broken(place: str, part: Mapping[str, Any], rules: Iterable[Rule]) -> list[str]:
    return [f"{place}: {rule.says}" for rule in rules if not rule.holds(part)]


def validate_steps(steps: Iterable[Mapping[str, Any]]) -> list[str]:
    """What is wrong with the settings of steps, without touching any data."""
    found: list[str] = []
    for number, step in enumerate(map(normalize_step, steps), 1):
        place = f"step {number} ({step.get('type')})"
        rules = STEP_RULES.get(step.get("type"), (Rule(lambda part: False, "there is no such step"),))
        found += _broken(place, step, rules)
        listed, entry_rules = ENTRY_RULES.get(step.get("type"), ("", ()))
        for n, entry in enumerate(step.get(listed) or (), 1):
            found += _broken(f"{place}, {listed} {n}", entry, entry_rules)
    return found


def validate_spec(spec: Mapping[str, Any]) -> list[str]:
    """What is wrong with a whole specification: its parts, then its steps."""
    output = spec.get("output")
    return [*_broken("specification", spec, SPEC_RULES), *(_broken("output", output, OUTPUT_RULES) if output is not None else ()),
            *validate_steps(spec.get("steps", []))]


@dataclass
class _Gate:
    checks: list[Mapping[str, Any]]
    df: DataFrame
    observation: Observation


@dataclass
class Flow:
    """A planned flow: the lazy result, and counters that the first action on it fills."""

    df: DataFrame
    source: DataFrame
    rows_out: Observation
    gates: list[_Gate] = field(default_factory=list)
    started_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    def violations(self) -> list[dict[str, Any]]:
        """Measures of gates that failed. Row rules were counted by the action; all unique keys of a gate take one more job."""
        found: list[dict[str, Any]] = []
        for gate in self.gates:
            repeated = duplicate_groups(gate.df, gate.checks)
            counts = {f"{r['check']}:unique_key": r["groups"] for r in repeated.collect()} if repeated is not None else {}
            found += gate_findings({**gate.observation.get, **counts})
        return found

    def report(self) -> dict[str, Any]:
        """Row counts, times and violations; call it after the action on :attr:`df`.

        The rows that came in are counted apart: a counter below the filters would keep them from the
        scan, and a count of files needs their footers only.
        """
        return {
            "rows_in": self.source.count(),
            "rows_out": self.rows_out.get["rows"],
            "quality_violations": self.violations(),
            "started_at": self.started_at,
            "completed_at": datetime.now(timezone.utc),
        }


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def plan_flow(
    df: DataFrame,
    steps: Iterable[Mapping[str, Any]],
    *,
    tables: Mapping[str, DataFrame] | None = None,
    observed: bool = True,
) -> Flow:
    """Fold the steps over a table. Nothing runs until the result is used.

    ``tables`` names join sides that are already loaded; other join sources are read as paths.
    ``observed=False`` leaves the row counters and gate counters out of the plan.
    """
    steps = [normalize_step(s) for s in steps]
    unknown = [s.get("type") for s in steps if s.get("type") not in STEP_RULES]
    if unknown:
        raise FlowError(f"unknown step types: {unknown}")
    gates: list[_Gate] = []
    before_steps = df
    for step in steps:
        kind = step["type"]
        if kind == "filter":
            df = S.filter_rows(df, step["condition"], null_safe=bool(step.get("null_safe")))
        elif kind == "flatten":
            df = S.flatten_array(df, step["source_column"], step["output_columns"], outer=bool(step.get("outer")))
        elif kind == "aggregate":
            df = S.aggregate_rows(df, step["group_by"], step["measures"])
        elif kind == "derive":
            df = S.derive_column(df, step["new_column"], step["expression"])
        elif kind == "rename":
            df = S.rename_columns(df, step["mappings"])
        elif kind == "cast":
            df = S.cast_columns(df, step["type_mappings"], lenient=bool(step.get("lenient")))
        elif kind == "join":
            source = step["right_source"]
            right = source if isinstance(source, DataFrame) else (tables or {}).get(source)
            if right is None:
                right = read_table(df.sparkSession, source)
            df = S.join_tables(df, right, step["on"], step.get("how", "inner"),
                               null_safe=bool(step.get("null_safe")))
        elif kind == "quality_gate" and observed:
            observation = Observation()
            types = {f.name: f.dataType for f in df.schema.fields}
            before = df
            measures = gate_measures(step["checks"], types)
            df = df.observe(observation, *[c.alias(n) for n, c in measures.items()])
            gates.append(_Gate(list(step["checks"]), before, observation))
    rows_out = Observation()
    if observed:
        df, rows_out = _counted(df)
    return Flow(df, before_steps, rows_out, gates)


def gate_table(df: DataFrame, checks: list[Mapping[str, Any]]) -> DataFrame:
    """Outcome of a gate step as rows (check, measure, failed), without driver code in between.

    Row rules share one pass; every uniqueness check adds one aggregate.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    measures = gate_measures(checks, types)
    folded = df.agg(*[c.alias(n) for n, c in measures.items()])
    rows = [F.struct(F.lit(n).alias("measure"), F.col(f"`{n}`").cast("bigint").alias("failed")) for n in measures if n != "rows"]
    nothing = F.array().cast("array<struct<measure:string,failed:bigint>>")
    result = folded.select(F.explode(F.concat(nothing, F.array(*rows)) if rows else nothing).alias("r")).select("r.*")
    keys = [i for i, check in enumerate(checks) if check.get("type") == "unique_key"]
    if keys:
        groups = duplicate_groups(df, checks)
        asked = df.sparkSession.createDataFrame([(i,) for i in keys], "check int")
        result = result.unionByName(asked.join(groups, "check", "left").select(
            F.concat("check", F.lit(":unique_key")).alias("measure"), F.coalesce("groups", F.lit(0)).alias("failed")))
    return result


def load_spec(path: str) -> dict[str, Any]:
    """A flow specification from a JSON file, or from YAML when PyYAML is installed."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.lower().endswith(".json"):
        spec = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as exc:
            raise FlowError("reading YAML needs PyYAML; use a JSON file instead") from exc
        spec = yaml.safe_load(text)
    if not isinstance(spec, dict):
        raise FlowError(f"the root of {path} must be a mapping")
    return spec
