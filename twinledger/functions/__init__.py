from twinledger.functions.calendar import (
    LEVELS,
    bucket_label,
    bucket_start,
    epoch_ts,
    expand_years,
    literal_tags,
    months_of_quadrimester,
    parse_quadrimester,
    quadrimester_month,
    quadrimester_of,
    time_unit,
    window_of,
    window_text,
    year_bucket_label,
    year_bucket_values,
    year_month,
    year_of,
)
from twinledger.functions.keys import key_month, quadrimester_of_key
from twinledger.functions.text import (
    ENTITY_MARKER,
    SOURCE_MARKER,
    classify,
    extract_marker,
    first_column,
    is_submitted,
    java_trim,
    safe_error,
    sanitize_entity,
)

__all__ = [
    "ENTITY_MARKER",
    "LEVELS",
    "SOURCE_MARKER",
    "bucket_label",
    "bucket_start",
    "classify",
    "epoch_ts",
    "expand_years",
    "literal_tags",
    "extract_marker",
    "first_column",
    "is_submitted",
    "java_trim",
    "key_month",
    "months_of_quadrimester",
    "parse_quadrimester",
    "quadrimester_month",
    "quadrimester_of",
    "quadrimester_of_key",
    "safe_error",
    "sanitize_entity",
    "time_unit",
    "window_of",
    "window_text",
    "year_bucket_label",
    "year_bucket_values",
    "year_month",
    "year_of",
]
