"""The row-shaping steps: filter, rename, cast, derive, flatten, aggregate and join.

Each step is a function from DataFrame to DataFrame that only adds to the logical plan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions import all_of, predicate, text_truth

# Accepted spellings of cast targets, aggregate functions and join types.
CAST_NAMES = {
    "str": "string", "string": "string", "varchar": "string",
    "int": "bigint", "integer": "bigint", "long": "bigint", "bigint": "bigint",
    "float": "double", "double": "double", "real": "double",
    "bool": "boolean", "boolean": "boolean",
    "date": "date", "timestamp": "timestamp",
}
AGGREGATES = {"sum": F.sum, "avg": F.avg, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count}
JOIN_NAMES = {
    "": "inner", "inner": "inner", "cross": "inner",
    "left": "left", "left_outer": "left",
    "right": "right", "right_outer": "right",
    "outer": "outer", "full": "outer", "full_outer": "outer",
    "semi": "left_semi", "left_semi": "left_semi",
    "anti": "left_anti", "left_anti": "left_anti",
}


def _quoted(name: str) -> Column:
    """A column by its exact name, also when the name holds dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


# ---------------------------------------------------------------- filter, rename, cast, derive


def filter_rows(
    df: DataFrame,
    condition: str | Column | Iterable[Mapping[str, Any]],
    *,
    null_safe: bool = False,
) -> DataFrame:
    """Keep rows that satisfy a SQL condition, a Column, or a list of comparisons joined by AND.

    A comparison is ``{"column": .., "op": .., "value": ..}`` or ``{"column", "op", "other"}`` where
    ``other`` names a second column. ``null_safe`` applies to such lists: null then equals null.
    """
    if isinstance(condition, Column):
        return df.filter(condition)
    if isinstance(condition, str):
        if null_safe:
            raise ValueError("null_safe needs a list of comparisons; in SQL text write <=>")
        return df.filter(F.expr(condition)) if condition.strip() else df
    tests = [
        predicate(
            _quoted(c["column"]),
            c["op"],
            _quoted(c["other"]) if "other" in c else c.get("value"),
            null_safe=null_safe,
            numeric=bool(c.get("numeric")),
        )
        for c in condition
    ]
    return df.filter(all_of(*tests))


def rename_columns(df: DataFrame, mappings: Mapping[str, str]) -> DataFrame:
    """Rename in one projection, so a swap works; unknown names are ignored.

    An untouched column whose name is taken by a renamed one gives way to it.
    """
    active = {old: new for old, new in mappings.items() if old in df.columns}
    taken = set(active.values())
    kept = [c for c in df.columns if c in active or c not in taken]
    return df.select(*[_quoted(c).alias(active.get(c, c)) for c in kept])


def cast_target(name: str) -> str:
    """Spark type of a cast name; integers are 64-bit, floats double, any DDL type passes."""
    key = name.strip().lower()
    return CAST_NAMES.get(key, key)


def cast_columns(df: DataFrame, type_mappings: Mapping[str, str], *, lenient: bool = False) -> DataFrame:
    """Cast columns; unknown columns are ignored.

    Strict casts fail the job on a bad value. Lenient casts give null instead, and read booleans
    from text by the ``1/true/yes/y`` rule.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for name, target in type_mappings.items():
        if name not in types:
            continue
        spark_type = cast_target(target)
        if lenient and spark_type == "boolean" and isinstance(types[name], T.StringType):
            changed[name] = text_truth(_quoted(name))
        elif lenient:
            changed[name] = _quoted(name).try_cast(spark_type)
        else:
            changed[name] = _quoted(name).cast(spark_type)
    return df.withColumns(changed) if changed else df


def derive_column(df: DataFrame, new_column: str, expression: str | Column) -> DataFrame:
    """Add or replace one column computed by a SQL expression or a Column."""
    if isinstance(expression, str):
        outside_quotes = re.sub(r"'[^']*'|\"[^\"]*\"", "", expression)
        for token, instead in (("**", "power(a, b)"), ("//", "floor(a / b)")):
            if token in outside_quotes:
                raise ValueError(f"{token!r} is not Spark SQL; write {instead}")
        expression = F.expr(expression)
    return df.withColumn(new_column, expression)


# ---------------------------------------------------------------- flatten


def flatten_array(
    df: DataFrame,
    source_column: str,
    output_columns: Sequence[str],
    *,
    outer: bool = False,
) -> DataFrame:
    """One row per array element, with the named output columns taken from the element.

    Structs and maps give fields by name (null when absent), inner arrays give values by position
    (short ones are padded with null), scalars fill exactly one column. Rows whose array is null
    or empty disappear; with ``outer`` they stay, and so does the source column, which then holds
    the element.
    """
    if not output_columns:
        raise ValueError("flatten needs at least one output column")
    array_type = df.schema[source_column].dataType
    if not isinstance(array_type, T.ArrayType):
        raise ValueError(f"flatten needs an array column, {source_column!r} is {array_type.simpleString()}")
    element_type = array_type.elementType
    element = _quoted("__element")
    if isinstance(element_type, T.StructType):
        present = set(element_type.names)
        outputs = [
            (element.getField(c) if c in present else F.lit(None)).alias(c) for c in output_columns
        ]
    elif isinstance(element_type, T.MapType):
        outputs = [F.try_element_at(element, F.lit(c)).alias(c) for c in output_columns]
    elif isinstance(element_type, T.ArrayType):
        outputs = [F.get(element, i).alias(c) for i, c in enumerate(output_columns)]
    elif len(output_columns) == 1:
        outputs = [element.alias(output_columns[0])]
    else:
        raise ValueError("flatten of scalar elements needs exactly one output column")
    base = [c for c in df.columns if c != source_column and c not in output_columns]
    explode = F.explode_outer if outer else F.explode
    exploded = df.select(*map(_quoted, base), explode(_quoted(source_column)).alias("__element"))
    kept = [element.alias(source_column)] if outer and source_column not in output_columns else []
    return exploded.select(*map(_quoted, base), *kept, *outputs)


# ---------------------------------------------------------------- aggregate


def measure_column(measure: Mapping[str, str]) -> Column:
    """Aggregate column of one ``{column, function, alias}`` entry."""
    function = measure["function"].strip().lower()
    if function not in AGGREGATES:
        raise ValueError(f"unknown aggregate function {function!r}, expected one of {sorted(AGGREGATES)}")
    column = measure.get("column")
    if function == "count" and column in (None, "", "*"):
        return F.count(F.lit(1)).alias(measure["alias"])
    return AGGREGATES[function](_quoted(column)).alias(measure["alias"])


def aggregate_rows(
    df: DataFrame, group_by: Sequence[str], measures: Iterable[Mapping[str, str]]
) -> DataFrame:
    """Group (null is a group of its own) and aggregate; no group columns give exactly one row.

    Every measure has a partial form, so each task folds its rows before the shuffle and a hot
    group sends one row per task.
    """
    columns = [measure_column(m) for m in measures]
    return df.groupBy(*map(_quoted, group_by)).agg(*columns) if group_by else df.agg(*columns)


# ---------------------------------------------------------------- join


def join_name(how: str) -> str:
    key = how.strip().lower().replace(" ", "_")
    if key not in JOIN_NAMES:
        raise ValueError(f"unknown join type {how!r}, expected one of {sorted(JOIN_NAMES)}")
    return JOIN_NAMES[key]


def join_tables(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join on same-named keys; the key columns appear once, in front.

    ``cross`` with keys is an inner join, as it is in Spark. When both sides carry a non-key column of the same name, a matched row takes the right value.
    ``null_safe`` lets null keys match each other. No side is force-broadcast: the planner and
    adaptive execution do that below their size thresholds, and otherwise split hot partitions.
    """
    if not on:
        raise ValueError("join needs at least one key column")
    kind = join_name(how)
    if kind == "outer":
        return _full_outer(left, right, on, null_safe)

    marker = "__matched"
    tagged = right.select(
        *[_quoted(k).alias(f"__right_{k}") for k in on],
        *[_quoted(c).alias(f"__right_{c}") for c in right.columns if c not in on],
        F.lit(True).alias(marker),
    )
    pairs = [
        _quoted(k).eqNullSafe(_quoted(f"__right_{k}")) if null_safe
        else _quoted(k) == _quoted(f"__right_{k}")
        for k in on
    ]
    joined = left.join(tagged, reduce(lambda a, b: a & b, pairs), kind)
    if kind in ("left_semi", "left_anti"):
        return joined.select(*map(_quoted, on), *[_quoted(c) for c in left.columns if c not in on])

    left_rest = [c for c in left.columns if c not in on]
    right_rest = [c for c in right.columns if c not in on]

    def value(name: str) -> Column:
        if name not in right_rest:
            return _quoted(name)
        theirs = _quoted(f"__right_{name}")
        if name not in left_rest or kind in ("inner", "right"):
            return theirs.alias(name)
        return F.when(_quoted(marker), theirs).otherwise(_quoted(name)).alias(name)

    keys = [_quoted(f"__right_{k}").alias(k) if kind == "right" else _quoted(k) for k in on]
    rest = left_rest + [c for c in right_rest if c not in left_rest]
    return joined.select(*keys, *map(value, rest))


def _full_outer(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool) -> DataFrame:
    """Full outer join as left join plus the right rows no left key reaches.

    Spark can split a hot partition of a left or anti join, but not of a full outer join. The left
    keys of the second part are reduced to distinct ones before they move.
    """
    left_part = join_tables(left, right, on, "left", null_safe=null_safe)
    left_keys = left.select(*map(_quoted, on)).distinct()
    right_part = join_tables(right, left_keys, on, "left_anti", null_safe=null_safe)
    return left_part.unionByName(right_part, allowMissingColumns=True)
