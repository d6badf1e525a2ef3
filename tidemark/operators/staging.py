"""Typed staging of raw pool-hour JSON (M-1 and its parts P-1 ... P-5, U-1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import negative_flag, seconds_to_ntz, ts_literal
from tidemark.schemas import FIELD_MAP


def _paths_schema(paths: list[str]) -> T.StructType:
    """Nested all-string schema covering every dotted path."""
    tree: dict = {}
    for p in paths:
        node = tree
        parts = p.split(".")
        for part in parts[:-1]:
            node = node.setdefault(part, {})
            if node is None:  # a leaf is also used as an object: keep it as JSON text
                break
        else:
            node.setdefault(parts[-1], None)

    def build(node: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(k, T.StringType() if v is None else build(v)) for k, v in sorted(node.items())]
        )

    return build(tree)


def parse_json_paths(raw: Column, paths: list[str]) -> tuple[Column, dict[str, Column]]:
    """Parse the document once with ``from_json`` and address each path on the struct.

    ``get_json_object`` re-parses the text for every extracted field; one
    ``from_json`` with only the needed fields parses it once.
    """
    schema = _paths_schema(paths)
    parsed = F.from_json(raw, schema)
    out = {}
    for p in paths:
        c = F.col("_doc")
        for part in p.split("."):
            c = c.getField(part)
        out[p] = c
    return parsed, out


def flag_negative(df: DataFrame) -> DataFrame:
    """``has_negative_values``: volume or TVL below zero; NULL counts as not negative (P-5)."""
    return df.withColumn("has_negative_values", negative_flag("volume_usd", "tvl_usd"))


def union_protocols(*frames: DataFrame) -> DataFrame:
    """``UNION ALL`` of protocol branches, aligned by name (U-1)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def lookback_days(df: DataFrame, as_of: Column | str, days: int, col: str = "hour_ts",
                  by_date: bool = False) -> DataFrame:
    """Rows within ``days`` of ``as_of`` (P-7).

    ``by_date`` compares calendar dates (``DATE(ts) >= DATE_SUB(CURRENT_DATE(), n)``),
    otherwise instants.  When the frame is partitioned by ``hour_date`` the
    implied date predicate is added so the scan prunes partitions.
    """
    now = ts_literal(as_of) if isinstance(as_of, str) else as_of
    if by_date:
        cond = F.to_date(F.col(col)) >= F.date_sub(F.to_date(now), days)
    else:
        cond = F.col(col) >= F.timestamp_add("DAY", F.lit(-days), now)
    if "hour_date" in df.columns:
        cond = cond & (F.col("hour_date") >= F.date_sub(F.to_date(now), days))
    return df.filter(cond)


def stage_pool_hourly(
    raw: DataFrame,
    as_of: Column | str | None = None,
    lookback: int | None = 90,
    ohlc: bool = False,
    field_map: dict[str, dict[str, list[str]]] | None = None,
) -> DataFrame:
    """Raw envelope rows -> typed staging rows (M-1; with ``ohlc`` the token/OHLC variant P-2).

    Every staged column is the first non-null of the protocol's candidate JSON
    paths (P-3), parsed tolerantly (F-2, F-4).  ``hour_ts`` comes from the
    envelope, or from ``periodStartUnix`` with ``ohlc`` (F-3).
    """
    fmap = field_map or FIELD_MAP
    targets = ["volume_usd", "tvl_usd", "liquidity", "tx_count"]
    paths = sorted({p for m in fmap.values() for t in targets for p in m.get(t, [])})
    extra = ["pool.token0.id", "pool.token1.id", "open", "high", "low", "close", "periodStartUnix"] if ohlc else []
    parsed, at = parse_json_paths(F.col("raw"), paths + extra)

    src = raw
    if as_of is not None and lookback is not None:
        src = lookback_days(src, as_of, lookback, by_date=True)
    src = src.withColumn("_doc", parsed)

    def staged(target: str) -> Column:
        typ = "bigint" if target == "tx_count" else "double"
        expr = None
        for proto, m in fmap.items():
            cands = [at[p].try_cast(typ) for p in m.get(target, [])]
            if not cands:
                continue
            value = cands[0] if len(cands) == 1 else F.coalesce(*cands)
            expr = (F.when(F.col("dex_protocol") == proto, value) if expr is None
                    else expr.when(F.col("dex_protocol") == proto, value))
        return (expr if expr is not None else F.lit(None).cast(typ)).alias(target)

    hour = seconds_to_ntz(at["periodStartUnix"].try_cast("bigint")) if ohlc else F.col("hour_ts")
    cols: list[Column] = [
        F.col("dex_protocol"),
        F.col("pool_id"),
        hour.alias("hour_ts"),
        *[staged(t) for t in targets],
    ]
    if ohlc:
        cols += [
            at["pool.token0.id"].alias("token0_id"),
            at["pool.token1.id"].alias("token1_id"),
            *[at[c].try_cast("double").alias(c) for c in ("open", "high", "low", "close")],
        ]
    cols.append(F.col("load_ts"))
    out = src.select(*cols)
    out = flag_negative(out)
    order = ["dex_protocol", "pool_id", "hour_ts", *targets]
    if ohlc:
        order += ["token0_id", "token1_id", "open", "high", "low", "close"]
    return out.select(*order, "has_negative_values", "load_ts")
