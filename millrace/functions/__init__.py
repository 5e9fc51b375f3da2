from millrace.functions.scalar import (
    all_of,
    any_of,
    blank,
    digits_only,
    divide,
    error_category,
    event_epoch,
    first_text,
    floor_div,
    floor_mod,
    iso_epoch,
    iso_is_zoneless,
    json_lookup,
    luhn_valid,
    null_compare,
    number_text,
    parse_count,
    parse_measure,
    power,
    predicate,
    strip_text,
    text_truth,
    to_number,
    variant_kind,
    variant_lookup,
    whole_json,
    zone_name,
)

__all__ = [
    "all_of", "any_of", "blank", "digits_only", "divide", "error_category", "event_epoch", "first_text",
    "floor_div", "floor_mod", "iso_epoch", "iso_is_zoneless", "json_lookup", "luhn_valid",
    "null_compare", "number_text", "parse_count", "parse_measure", "power", "predicate",
    "strip_text", "text_truth", "to_number", "variant_kind", "variant_lookup", "whole_json", "zone_name",
]
