"""Hand-made pool-hour frames for edge rules (see FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import STAGING


def staged_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """rows: (protocol, pool, hour_ts, volume, tvl, liquidity, tx_count[, has_negative])."""
    full = []
    for r in rows:
        proto, pool, hour, vol, tvl, liq, tx = r[:7]
        neg = r[7] if len(r) > 7 else bool((vol is not None and vol < 0) or (tvl is not None and tvl < 0))
        full.append((proto, pool, hour, vol, tvl, liq, tx, neg, hour))
    return spark.createDataFrame(full, STAGING)


def series(spark: SparkSession, pool: str, start: str, volumes: list[float], tvl: float | list = 100.0,
           protocol: str = "uniswap_v3", step_hours: int | list[int] = 1) -> DataFrame:
    t0 = dt.datetime.fromisoformat(start)
    if isinstance(step_hours, int):
        stamps = [t0 + dt.timedelta(hours=i * step_hours) for i in range(len(volumes))]
    else:
        stamps = [t0 + dt.timedelta(hours=h) for h in step_hours]
    tvls = tvl if isinstance(tvl, list) else [tvl] * len(volumes)
    return staged_rows(spark, [(protocol, pool, s, v, t, 1.0, 1) for s, v, t in zip(stamps, volumes, tvls)])
