"""Dashboard queries over the labelled table: latest status (M-4), anomaly
dashboard (M-5) and hourly KPI series (M-6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import bool_count, hour_of_day, pct, safe_div, ts_literal
from tidemark.operators.features import series_window
from tidemark.operators.staging import lookback_days


def _now(as_of: Column | str) -> Column:
    return ts_literal(as_of) if isinstance(as_of, str) else as_of


def latest_status(labeled: DataFrame, as_of: Column | str, hours: int = 24) -> DataFrame:
    """Newest row of every pool within the last ``hours`` (M-4: W-8, O-2, P-10).

    ``row_number() = 1`` is planned as a per-partition top-1 before the
    shuffle (``WindowGroupLimit``), so only one row per pool and task moves.
    """
    now = _now(as_of)
    recent = labeled.filter(F.col("hour_ts") >= F.timestamp_add("HOUR", F.lit(-hours), now))
    rn = F.row_number().over(series_window(descending=True))
    return recent.withColumn("rn", rn).filter(F.col("rn") == 1).drop("rn")


def anomaly_dashboard(labeled: DataFrame, as_of: Column | str, days: int = 7, keep: int = 168,
                      strategy: str = "window") -> DataFrame:
    """7-day per-pool detail with summary columns and an alert flag (M-5).

    The summary counts every row of the window before the ``rn <= keep`` cut.
    ``strategy='window'`` computes it as whole-partition window aggregates over
    the same pool partitioning as the recency rank: one scan, one exchange.
    ``'join'`` is the reference's aggregate + self-join (J-2).
    """
    now = _now(as_of)
    recent = lookback_days(labeled, now, days).select(
        "pool_id", "hour_ts", "volume_usd", "tvl_usd", "liquidity", "anomaly_score", "is_anomaly", "dex_protocol"
    )
    rn = F.row_number().over(series_window(descending=True))
    summary = {
        "total_hours": F.count(F.lit(1)),
        "anomaly_hours": F.sum(F.when(F.col("is_anomaly"), F.lit(1)).otherwise(F.lit(0))),
        "avg_volume": F.avg("volume_usd"),
        "avg_tvl": F.avg("tvl_usd"),
        "max_anomaly_score": F.max("anomaly_score"),
    }
    if strategy == "window":
        whole = Window.partitionBy("pool_id")
        lp = recent.select("*", rn.alias("rn"), *[agg.over(whole).alias(k) for k, agg in summary.items()])
    elif strategy == "join":
        ps = recent.groupBy("pool_id").agg(*[agg.alias(k) for k, agg in summary.items()])
        lp = recent.withColumn("rn", rn).join(ps, "pool_id")
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    out = lp.filter(F.col("rn") <= keep).select(
        "pool_id",
        "hour_ts",
        "volume_usd",
        "tvl_usd",
        "liquidity",
        "anomaly_score",
        F.when(F.col("is_anomaly"), F.lit("Anomaly Detected")).otherwise(F.lit("Normal")).alias("status"),
        F.when(F.col("is_anomaly") & (F.col("rn") == 1), F.lit(True)).otherwise(F.lit(False)).alias("needs_alert"),
        F.col("anomaly_hours").cast("bigint").alias("anomaly_hours"),
        F.col("total_hours").cast("bigint").alias("total_hours"),
        pct("anomaly_hours", "total_hours").alias("anomaly_rate_pct"),
        "avg_volume",
        "avg_tvl",
        "max_anomaly_score",
    )
    return out


def hourly_stats(labeled: DataFrame, as_of: Column | str, days: int = 30) -> DataFrame:
    """Fleet KPIs per (date, hour) over the last ``days`` (A-2 ... A-6, A-10)."""
    now = _now(as_of)
    recent = lookback_days(labeled, now, days)
    return recent.groupBy(F.to_date("hour_ts").alias("date"), hour_of_day("hour_ts").alias("hour")).agg(
        F.count_distinct("pool_id").alias("active_pools"),
        F.sum("volume_usd").alias("total_volume"),
        F.sum("tvl_usd").alias("total_tvl"),
        bool_count("is_anomaly").alias("anomaly_count"),
        F.avg("anomaly_score").alias("avg_anomaly_score"),
    )


def anomaly_timeseries(labeled: DataFrame, as_of: Column | str, days: int = 30) -> DataFrame:
    """Hourly KPIs with anomaly rate and day-over-day values, newest first (M-6: W-9, O-1).

    The day-over-day lag runs over the whole aggregated series (no partition
    key); its input is one row per hour of the window (720 rows for 30 days)
    whatever the size of the labelled table, and every row before it is
    aggregated in parallel with partial aggregation.
    """
    stats = hourly_stats(labeled, as_of, days)
    w = Window.orderBy("date", "hour")
    out = stats.select(
        "*",
        (safe_div(F.col("anomaly_count").cast("double"), F.col("active_pools").cast("double")) * 100)
        .alias("anomaly_rate_pct"),
        F.lag("total_volume", 24).over(w).alias("volume_24h_ago"),
        F.lag("anomaly_count", 24).over(w).alias("anomaly_count_24h_ago"),
    )
    return out.orderBy(F.col("date").desc(), F.col("hour").desc())
