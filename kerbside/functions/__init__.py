from kerbside.functions.frames import evaluate_once, where_present
from kerbside.functions.geo import (
    circle_wkt,
    haversine_m,
    point_wkt,
    squared_chord,
    squared_chord_limit,
    unit_vector,
)
from kerbside.functions.json_values import (
    epoch_seconds,
    is_truthy,
    json_document,
    json_kind,
    json_list,
    json_long,
    json_scalar,
    json_text,
    json_value,
    long_overflows,
    strict_json,
)
from kerbside.functions.scalars import (
    civil_time,
    fingerprint,
    greatest_strict,
    hour_bucket,
    least_strict,
    minutes_between,
    non_empty,
    parse_feed_timestamp,
    safe_divide,
    utc_suffix,
)

__all__ = [
    "circle_wkt",
    "civil_time",
    "epoch_seconds",
    "evaluate_once",
    "fingerprint",
    "greatest_strict",
    "haversine_m",
    "hour_bucket",
    "is_truthy",
    "json_document",
    "json_kind",
    "json_list",
    "json_long",
    "json_scalar",
    "json_text",
    "json_value",
    "least_strict",
    "long_overflows",
    "minutes_between",
    "non_empty",
    "parse_feed_timestamp",
    "point_wkt",
    "safe_divide",
    "squared_chord",
    "squared_chord_limit",
    "strict_json",
    "unit_vector",
    "utc_suffix",
    "where_present",
]
