"""Scalar column helpers shared by every layer.

Everything here composes built-in expressions, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F



def epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ts_literal(value: str | _dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal; ``as_of`` is always passed this way so it constant-folds."""
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    text = _dt.datetime.fromisoformat(value.replace("Z", "").replace("T", " ")).isoformat(sep=" ")
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def safe_div(num: Column | str, den: Column | str) -> Column:
    """``SAFE_DIVIDE(a, NULLIF(b, 0))``: NULL on a zero or NULL divisor."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def change_rate(cur: Column | str, prev: Column | str, form: str = "diff") -> Column:
    """24-row change rate: ``(v - v24) / v24`` (form diff) or ``v / v24 - 1`` (form ratio)."""
    if form == "diff":
        return safe_div(_c(cur) - _c(prev), prev)
    if form == "ratio":
        return safe_div(cur, prev) - F.lit(1)
    raise ValueError(f"unknown change-rate form {form!r}")


def hour_floor(ts: Column | str) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour, staying NTZ (``date_trunc`` would return a zoned type)."""
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(_c(ts)).cast("bigint")


def day_of_week(ts: Column | str) -> Column:
    """Sunday = 1 ... Saturday = 7, as SQL ``DAYOFWEEK``."""
    return F.dayofweek(_c(ts)).cast("bigint")


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole hours from ``earlier`` to ``later`` (``TIMESTAMP_DIFF(later, earlier, HOUR)``)."""
    return F.timestamp_diff("HOUR", _c(earlier), _c(later))


def seconds_to_ntz(seconds: Column | str) -> Column:
    """Epoch seconds -> UTC wall-clock TIMESTAMP_NTZ, independent of the session zone."""
    return F.timestamp_add("SECOND", _c(seconds), epoch_ntz())


def ntz_to_seconds(ts: Column | str) -> Column:
    return F.timestamp_diff("SECOND", epoch_ntz(), _c(ts))


def epoch_hours(ts: Column | str) -> Column:
    """Whole hours since the epoch, the order of time-exact frames."""
    return F.floor(ntz_to_seconds(ts) / F.lit(3600))


def instant_to_ntz(ts: Column | str) -> Column:
    """A zoned TIMESTAMP (an instant) -> its UTC wall-clock TIMESTAMP_NTZ, zone independent."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), epoch_ntz())


def ntz_to_instant(ts: Column | str) -> Column:
    """UTC wall-clock TIMESTAMP_NTZ -> TIMESTAMP instant (needed by watermarks)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch_ntz(), _c(ts)))


def iso_utc(ts: Column | str) -> Column:
    """ISO-8601 text with a ``Z`` suffix, e.g. ``2025-05-20T09:00:00Z``."""
    return F.concat(F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))


def parse_iso_utc(text: Column | str) -> Column:
    """``2025-05-20T09:00:00Z`` / ``+00:00`` -> TIMESTAMP_NTZ in UTC."""
    return instant_to_ntz(F.to_timestamp(_c(text)))


def negative_flag(volume: Column | str, tvl: Column | str) -> Column:
    """``volume < 0 OR tvl < 0``; NULL comparisons give FALSE, never NULL."""
    return F.when((_c(volume) < 0) | (_c(tvl) < 0), F.lit(True)).otherwise(F.lit(False))


def mask_id(col: Column | str, keep: int = 6) -> Column:
    """Log-safe entity id: first ``keep`` characters and ``...``."""
    return F.concat(F.substring(_c(col), 1, keep), F.lit("..."))


def as_double(col: Column | str) -> Column:
    """int64 feature values are served as floats."""
    return _c(col).cast("double")


def fill_default(col: Column | str, default: float | None) -> Column:
    """Default fill; with no default the value stays NULL (absent)."""
    return _c(col) if default is None else F.coalesce(_c(col), F.lit(float(default)))


def pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """``ROUND(SAFE_DIVIDE(num, den) * 100, digits)``."""
    return F.round(safe_div(_c(num).cast("double"), _c(den).cast("double")) * 100, digits)


def bool_count(cond: Column | str) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as bigint."""
    return F.sum(F.when(_c(cond), F.lit(1)).otherwise(F.lit(0))).cast("bigint")
