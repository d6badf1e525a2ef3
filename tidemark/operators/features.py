"""Rolling per-pool features (M-2) and their incremental maintenance (V-4).

All five window expressions share one partitioning and order, so Catalyst
plans a single exchange, a single sort and a single ``Window`` node.  Window
partitions are bounded by time, not by data volume: after deduplication a
series holds at most one row per hour (2,160 rows in the 90-day view).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import (
    change_rate,
    day_of_week,
    epoch_hours,
    hour_of_day,
    hours_between,
    safe_div,
    ts_literal,
)
from tidemark.operators.staging import lookback_days
from tidemark.schemas import FAR_PAST

LAG_ROWS = 24
SHORT_ROWS = 6
LONG_ROWS = 24

FEATURE_COLUMNS = [
    "dex_protocol",
    "pool_id",
    "hour_ts",
    "volume_usd",
    "tvl_usd",
    "liquidity",
    "tx_count",
    "vol_rate_24h",
    "tvl_rate_24h",
    "vol_ma_6h",
    "vol_ma_24h",
    "vol_std_24h",
    "vol_tvl_ratio",
    "volume_zscore",
    "hour_of_day",
    "day_of_week",
]


def series_window(partition_by: Sequence[str] = ("pool_id",), descending: bool = False):
    """Per-series order by hour; ``dex_protocol`` breaks ties if a pool id is shared."""
    keys = [F.col("hour_ts").desc(), F.col("dex_protocol").desc()] if descending else [
        F.col("hour_ts"), F.col("dex_protocol")]
    return Window.partitionBy(*partition_by).orderBy(*keys)


def pool_features(
    staged: DataFrame,
    as_of: Column | str | None = None,
    lookback: int | None = 90,
    partition_by: Sequence[str] = ("pool_id",),
    rate_form: str = "diff",
    quality_filter: bool = True,
    frame: str = "rows",
) -> DataFrame:
    """The 13-feature time series plus ``hours_ago`` (M-2).

    With ``frame='rows'`` lags and frames count rows (a gap shifts them), as
    the reference does; with ``'hours'`` they are exact in time (D-4): the
    averages take the rows of the last 6 and 24 hours, a rate compares with
    the row exactly 24 hours before (the mean of its rows, should a series
    have several in that hour) and is NULL where there is none.
    ``rate_form='ratio'`` gives ``v / v24 - 1`` (W-6).
    """
    w = series_window(partition_by)
    if frame == "rows":
        last = lambda n: w.rowsBetween(-(n - 1), 0)
        before = lambda c: F.lag(c, LAG_ROWS).over(w)
    elif frame == "hours":
        hours = Window.partitionBy(*partition_by).orderBy(epoch_hours("hour_ts"))
        last = lambda n: hours.rangeBetween(-(n - 1), 0)
        before = lambda c: F.avg(c).over(hours.rangeBetween(-LAG_ROWS, -LAG_ROWS))
    else:
        raise ValueError(f"unknown frame {frame!r}")
    src = staged.filter(~F.col("has_negative_values")) if quality_filter else staged
    vol = F.col("volume_usd")
    metrics = src.select(
        "dex_protocol",
        "pool_id",
        "hour_ts",
        "volume_usd",
        "tvl_usd",
        "liquidity",
        "tx_count",
        before(vol).alias("_vol_prev"),
        before(F.col("tvl_usd")).alias("_tvl_prev"),
        F.avg(vol).over(last(SHORT_ROWS)).alias("vol_ma_6h"),
        F.avg(vol).over(last(LONG_ROWS)).alias("vol_ma_24h"),
        F.stddev_samp(vol).over(last(LONG_ROWS)).alias("vol_std_24h"),
    )
    now = None if as_of is None else (ts_literal(as_of) if isinstance(as_of, str) else as_of)
    out = metrics.select(
        "dex_protocol",
        "pool_id",
        "hour_ts",
        "volume_usd",
        "tvl_usd",
        "liquidity",
        "tx_count",
        change_rate("volume_usd", "_vol_prev", rate_form).alias("vol_rate_24h"),
        change_rate("tvl_usd", "_tvl_prev", rate_form).alias("tvl_rate_24h"),
        "vol_ma_6h",
        "vol_ma_24h",
        "vol_std_24h",
        safe_div("volume_usd", "tvl_usd").alias("vol_tvl_ratio"),
        safe_div(vol - F.col("vol_ma_24h"), "vol_std_24h").alias("volume_zscore"),
        hour_of_day("hour_ts").alias("hour_of_day"),
        day_of_week("hour_ts").alias("day_of_week"),
        (hours_between(now, "hour_ts") if now is not None else F.lit(None).cast("bigint")).alias("hours_ago"),
    )
    if now is not None and lookback is not None:
        out = lookback_days(out, now, lookback)
    return out


def high_water(target: DataFrame, col: str = "hour_ts") -> Column:
    """``COALESCE(MAX(col), '1900-01-01')`` of the target as a scalar subquery (A-9, J-3, F-7)."""
    return F.coalesce(target.select(F.max(col)).scalar(), ts_literal(FAR_PAST))


def incremental_filter(df: DataFrame, target: DataFrame, col: str = "hour_ts") -> DataFrame:
    """Rows later than the target's high-water mark (V-1)."""
    return df.filter(F.col(col) > high_water(target, col))


def incremental_features(
    staged: DataFrame,
    target: DataFrame | None,
    partition_by: Sequence[str] = ("pool_id",),
    rate_form: str = "diff",
    quality_filter: bool = True,
    as_of: Column | str | None = None,
    mark: Column | None = None,
) -> DataFrame:
    """Features of the rows newer than the target's mark, with a 24-row warm-up (V-4).

    The warm-up is the last 24 accepted rows of every series at or before the
    mark, picked by row count (a gap may push them far back).  Spark plans the
    pick as a per-partition top-24 before the shuffle (``WindowGroupLimit``).
    Equal to recomputing everything and keeping rows after the mark.  ``mark``
    (a literal) replaces the target's high-water subquery when it is known.
    """
    if mark is None:
        mark = high_water(target)
    src = staged.filter(~F.col("has_negative_values")) if quality_filter else staged
    old = src.filter(F.col("hour_ts") <= mark)
    new = src.filter(F.col("hour_ts") > mark)
    rn = F.row_number().over(series_window(partition_by, descending=True))
    warm = old.withColumn("_rn", rn).filter(F.col("_rn") <= LAG_ROWS).drop("_rn")
    feats = pool_features(
        warm.unionByName(new), as_of=as_of, lookback=None, partition_by=partition_by,
        rate_form=rate_form, quality_filter=False,
    )
    return feats.filter(F.col("hour_ts") > mark)


#: Days before the earliest touched hour that are read first; series with fewer rows there read on.
WARM_DAYS = 7


def stored_history(spark, path: str, since: DataFrame, rows: int = LAG_ROWS, days: int = WARM_DAYS,
                   partition_col: str = "hour_date") -> DataFrame:
    """Stored rows from which the features of each series can be computed from its ``since`` hour on.

    ``since``: ``pool_id`` and ``since``, one row per touched series.  The
    result holds all stored rows at or after it and at least the last ``rows``
    before it.  Day partitions from ``days`` before the earliest hour are read
    first; only series with fewer rows there have older days read too, through
    a semi-join (no list of ids passes through the driver).
    """
    import datetime as _dt

    table = spark.read.parquet(path)
    first = since.agg(F.min("since")).first()[0]
    if first is None:
        return table.limit(0)
    start = first.date() - _dt.timedelta(days=days)
    recent = table.filter(F.col(partition_col) >= F.lit(start)).join(since, "pool_id")
    enough = (recent.filter(F.col("hour_ts") < F.col("since")).groupBy("pool_id").agg(F.count(F.lit(1)).alias("_n"))
              .filter(F.col("_n") >= rows).select("pool_id"))
    short = since.join(enough, "pool_id", "left_anti").select("pool_id")
    older = table.filter(F.col(partition_col) < F.lit(start)).join(short, "pool_id", "left_semi")
    return recent.drop("since").unionByName(older.select(*table.columns))


def warm_history(spark, path: str, start: str, rows: int = LAG_ROWS, days: int = WARM_DAYS, partition_by: Sequence[str] = ("pool_id",),
                 partition_col: str = "hour_date", end: str | None = None, monthly: bool = False) -> DataFrame:
    """Stored staging rows from which all features from ``start`` on (before ``end``, if given) can be computed (D-5).

    The look-back sits below the windows: day partitions from ``days`` before
    ``start`` are read, and only series that are seen from ``start`` on with
    fewer than ``rows`` accepted rows before it have older days read, of which
    their last rows alone go on.  The ids of those series stay in a semi-join.
    ``monthly``: the partition column holds the first day of the month.
    """
    import datetime as _dt

    first = _dt.datetime.fromisoformat(start)
    floor = (lambda d: d.replace(day=1)) if monthly else (lambda d: d)
    edge = floor(first.date() - _dt.timedelta(days=days))
    table = spark.read.parquet(path).filter(~F.col("has_negative_values"))
    recent = table.filter(F.col(partition_col) >= F.lit(edge))
    if end is not None:
        last = _dt.datetime.fromisoformat(end)
        recent = recent.filter((F.col(partition_col) <= F.lit(floor(last.date()))) & (F.col("hour_ts") < F.lit(last)))
    now = F.col("hour_ts") >= F.lit(first)
    asked = (recent.groupBy(*partition_by).agg(F.count_if(now).alias("_now"), F.count_if(~now).alias("_before"))
             .filter((F.col("_now") > 0) & (F.col("_before") < rows)).select(*partition_by))
    older = table.filter(F.col(partition_col) < F.lit(edge)).join(asked, list(partition_by), "left_semi")
    rn = F.row_number().over(series_window(partition_by, descending=True))
    older = older.withColumn("_rn", rn).filter(F.col("_rn") <= rows).drop("_rn")
    return recent.unionByName(older.select(*recent.columns))


def recent_features(spark, path: str, start: str, as_of: Column | str | None = None, end: str | None = None, rate_form: str = "diff",
                    partition_by: Sequence[str] = ("pool_id",), **layout) -> DataFrame:
    """Features of the rows from ``start`` on (before ``end``) of a day-partitioned staging table.

    Equal to computing the whole history and keeping those rows, at the cost
    of the days asked for and their warm-up.  ``layout`` as in ``warm_history``.
    """
    rows = warm_history(spark, path, start, partition_by=partition_by, end=end, **layout)
    out = pool_features(rows, as_of=as_of, lookback=None, partition_by=partition_by, rate_form=rate_form, quality_filter=False)
    return out.filter(F.col("hour_ts") >= ts_literal(start))
