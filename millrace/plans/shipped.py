"""The two flows that come with the package, as plain specifications.

Fixed values throughout: column names, thresholds and bounds.
"""

from __future__ import annotations

from typing import Any

# Nested measurements per category: keep rows that have any, unfold them, summarise per category.
# The serving size is carried through the aggregate, because the density is derived after it.
ENRICHMENT: dict[str, Any] = {
    "transform_id": "category_density",
    "source": "food_payloads",
    "steps": [
        {"type": "filter", "where": "nutrients IS NOT NULL"},
        {"type": "flatten", "column": "nutrients", "into": ["nutrient_name", "nutrient_value", "unit"]},
        {"type": "aggregate", "group_by": ["food_category"], "measures": [
            {"column": "nutrient_value", "function": "avg", "alias": "avg_nutrient"},
            {"column": "nutrient_value", "function": "max", "alias": "max_nutrient"},
            {"column": "serving_size", "function": "avg", "alias": "serving_size"},
        ]},
        {"type": "derive", "new_column": "nutrient_density", "expression": "avg_nutrient / serving_size"},
        {"type": "quality_gate", "checks": [
            {"type": "not_null", "columns": ["food_category", "avg_nutrient"]},
            {"type": "valid_range", "column": "nutrient_density", "min": 0, "max": 10000},
        ]},
    ],
    "output": {"table": "curated.category_density", "format": "parquet", "partition_by": ["food_category"]},
}

# Text counts per place: name and type them, sort places into brackets, total per bracket.
BRACKETS: dict[str, Any] = {
    "transform_id": "bracket_totals",
    "source": "census_rows",
    "steps": [
        {"type": "rename", "mappings": {
            "NAME": "state_name", "P1_001N": "population", "P1_002N": "pop_one_race",
            "B19013_001E": "median_income"}},
        {"type": "cast", "columns": {"population": "int", "pop_one_race": "int", "median_income": "int"}},
        {"type": "derive", "new_column": "population_bracket", "expression":
            "CASE WHEN population > 10000000 THEN 'large' WHEN population > 1000000 THEN 'medium' "
            "ELSE 'small' END"},
        {"type": "aggregate", "group_by": ["population_bracket"], "measures": [
            {"column": "population", "function": "sum", "alias": "total_pop"},
            {"column": "state_name", "function": "count", "alias": "state_count"},
        ]},
        {"type": "quality_gate", "checks": [
            {"type": "not_null", "columns": ["population_bracket", "total_pop"]},
            {"type": "row_count", "min": 1},
        ]},
    ],
    "output": {"table": "curated.bracket_totals", "format": "parquet", "partition_by": ["population_bracket"]},
}
