"""JSON column helpers (Column -> Column, all JVM-side; no UDFs).

Paths are colon separated like ``"pool:token0:id"`` or given as lists.
Scalars come back unquoted.  Numbers are parsed tolerantly: a malformed value
becomes NULL instead of failing the query (ANSI mode is on in Spark 4).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalar import seconds_to_ntz


def _json_path(path: str | list[str]) -> str:
    parts = path.split(":") if isinstance(path, str) else list(path)
    return "$." + ".".join(parts)


def json_str(col: Column | str, path: str | list[str]) -> Column:
    """Unquoted scalar (or JSON text of an object) at ``path``; NULL if absent."""
    return F.get_json_object(F.col(col) if isinstance(col, str) else col, _json_path(path))


def json_float(col: Column | str, path: str | list[str], strict: bool = False) -> Column:
    s = json_str(col, path)
    return s.cast("double") if strict else s.try_cast("double")


def json_int(col: Column | str, path: str | list[str]) -> Column:
    return json_str(col, path).try_cast("bigint")


def json_ts(col: Column | str, path: str | list[str]) -> Column:
    """Epoch seconds stored in JSON -> UTC wall-clock TIMESTAMP_NTZ."""
    return seconds_to_ntz(json_int(col, path))
