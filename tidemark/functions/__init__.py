from tidemark.functions.json import json_float, json_int, json_str, json_ts
from tidemark.functions.scalar import (
    as_double,
    bool_count,
    change_rate,
    day_of_week,
    fill_default,
    hour_floor,
    hour_of_day,
    hours_between,
    instant_to_ntz,
    iso_utc,
    mask_id,
    negative_flag,
    ntz_to_instant,
    ntz_to_seconds,
    parse_iso_utc,
    pct,
    safe_div,
    seconds_to_ntz,
    ts_literal,
)

__all__ = [
    "as_double",
    "bool_count",
    "change_rate",
    "day_of_week",
    "fill_default",
    "hour_floor",
    "hour_of_day",
    "hours_between",
    "instant_to_ntz",
    "iso_utc",
    "json_float",
    "json_int",
    "json_str",
    "json_ts",
    "mask_id",
    "negative_flag",
    "ntz_to_instant",
    "ntz_to_seconds",
    "parse_iso_utc",
    "pct",
    "safe_div",
    "seconds_to_ntz",
    "ts_literal",
]
