from tradeloom.functions.columns import (
    add_interval,
    as_utc,
    cast_leaf,
    country_name,
    day_of,
    default_key,
    from_epoch_ms,
    shift_hours,
)
from tradeloom.functions.json_values import json_field, parse_json_text

__all__ = [
    "add_interval",
    "as_utc",
    "cast_leaf",
    "country_name",
    "day_of",
    "default_key",
    "from_epoch_ms",
    "json_field",
    "parse_json_text",
    "shift_hours",
]
