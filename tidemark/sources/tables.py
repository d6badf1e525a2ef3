"""Reading the driver's test tables and reshaping ``events`` into the pool-hour model.

The reference's input is an hourly panel of liquidity pools; the test data has
none, so ``events`` is aggregated into one: a user is a pool, the events of one
hour are that pool's hour.  The aggregation is a single ``groupBy`` with
map-side partial aggregation, so a hot user costs no more than a cold one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import hour_floor, ntz_to_seconds, ts_literal

# The reproducible "now" of every registered query over ``events``,
# and of the supplier-day series over ``lineitem`` (the day after its last ship date).
AS_OF = "2024-01-31 00:00:00"
SUPPLY_AS_OF = "2001-11-05 00:00:00"

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _protocol(user_id: Column) -> Column:
    return F.when(user_id % 2 == 0, F.lit("uniswap_v3")).otherwise(F.lit("sushiswap_v3"))


def pool_hours(spark: SparkSession, sf_dir: str, signed: bool = True, ohlc: bool = False) -> DataFrame:
    """``events`` -> one row per (pool, hour).

    ``signed``: ``error`` events count negative, so some hours carry a negative
    volume and exercise the data-quality flag and filter.
    """
    ev = load_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").try_cast("double")
    value = F.col("value")
    if signed:
        value = F.when(F.col("event_type") == "error", -value).otherwise(value)
    aggs = [
        F.round(F.sum(value), 6).alias("volume_usd"),
        F.max(k).alias("tvl_usd"),
        F.sum(k).alias("liquidity"),
        F.count(F.lit(1)).alias("tx_count"),
        F.max("ts").alias("load_ts"),
    ]
    if ohlc:
        order = F.struct("ts", "event_id")
        aggs += [
            F.min_by(value, order).alias("open"),
            F.max(value).alias("high"),
            F.min(value).alias("low"),
            F.max_by(value, order).alias("close"),
        ]
    hourly = ev.groupBy(F.col("user_id"), hour_floor("ts").alias("hour_ts")).agg(*aggs)
    uid = F.col("user_id")
    cols = [
        _protocol(uid).alias("dex_protocol"),
        F.concat(F.lit("pool_"), uid.cast("string")).alias("pool_id"),
        "hour_ts",
        "volume_usd",
        "tvl_usd",
        "liquidity",
        "tx_count",
        "load_ts",
    ]
    if ohlc:
        cols += [
            F.concat(F.lit("token_"), (uid % 10).cast("string")).alias("token0_id"),
            F.concat(F.lit("token_"), ((uid + 1) % 10 + 10).cast("string")).alias("token1_id"),
            "open",
            "high",
            "low",
            "close",
        ]
    return hourly.select(*cols)


def supplier_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` -> one row per (supplier, ship day): a second, daily series.

    A supplier is a pool and a ship day its period.  ``volume_usd`` is the
    day's net quantity shipped (returned lines count negative, so the quality
    flag has work), ``tvl_usd`` the largest line price, ``liquidity`` the
    day's revenue after discount, ``tx_count`` the number of lines.  Volumes
    are whole numbers, so 6- and 24-row averages never sit on a rounding tie
    at 6 digits and the DuckDB oracle compares exactly.  One ``groupBy`` with
    partial aggregation: a supplier holding a third of all lines still sends
    one row per day and task through the shuffle.
    """
    li = load_table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount", "l_quantity", "l_returnflag")
    qty = F.col("l_quantity")
    signed = F.when(F.col("l_returnflag") == "R", -qty).otherwise(qty)
    daily = li.groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(
        F.sum(signed).alias("volume_usd"),
        F.max("l_extendedprice").alias("tvl_usd"),
        F.sum(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("liquidity"),
        F.count(F.lit(1)).alias("tx_count"),
        F.max("l_shipdate").alias("load_ts"),
    )
    sk = F.col("l_suppkey")
    return daily.select(
        _protocol(sk).alias("dex_protocol"),
        F.concat(F.lit("supplier_"), sk.cast("string")).alias("pool_id"),
        F.col("day").cast("timestamp_ntz").alias("hour_ts"),
        "volume_usd",
        "tvl_usd",
        "liquidity",
        "tx_count",
        "load_ts",
    )


def pool_hour_records(pool_hours_df: DataFrame) -> DataFrame:
    """Pool-hours as nested API records, numbers as strings.

    The two protocols use different field names for TVL, liquidity and
    transaction count (the names of the field map's second candidates for
    ``sushiswap_v3``), so staging has to resolve both.  Returns ``record`` and
    ``protocol`` (``uniswap`` / ``sushiswap``) plus ``load_ts``.
    """
    d = pool_hours_df
    is_uni = F.col("dex_protocol") == "uniswap_v3"

    def s(c: str) -> Column:
        return F.col(c).cast("string")

    def uni(c: Column) -> Column:
        return F.when(is_uni, c)

    def sushi(c: Column) -> Column:
        return F.when(~is_uni, c)

    has_ohlc = "open" in d.columns
    token0 = F.col("token0_id") if has_ohlc else F.lit(None).cast("string")
    token1 = F.col("token1_id") if has_ohlc else F.lit(None).cast("string")
    start = ntz_to_seconds("hour_ts")
    record = F.struct(
        F.concat(F.col("pool_id"), F.lit("-"), start.cast("string")).alias("id"),
        start.alias("periodStartUnix"),
        F.struct(
            F.col("pool_id").alias("id"),
            F.struct(token0.alias("id"), F.lit("T0").alias("symbol"), F.lit("Token0").alias("name"),
                     F.lit("18").alias("decimals")).alias("token0"),
            F.struct(token1.alias("id"), F.lit("T1").alias("symbol"), F.lit("Token1").alias("name"),
                     F.lit("18").alias("decimals")).alias("token1"),
            F.lit("3000").alias("feeTier"),
        ).alias("pool"),
        s("volume_usd").alias("volumeUSD"),
        uni(s("tvl_usd")).alias("tvlUSD"),
        sushi(s("tvl_usd")).alias("totalValueLockedUSD"),
        uni(s("liquidity")).alias("liquidity"),
        sushi(s("liquidity")).alias("liquidityUSD"),
        uni(s("tx_count")).alias("txCount"),
        sushi(s("tx_count")).alias("hourlyTxns"),
        *([s(c).alias(c) for c in ("open", "high", "low", "close")] if has_ohlc else []),
    )
    return d.select(
        record.alias("record"),
        F.regexp_replace("dex_protocol", "_v3$", "").alias("protocol"),
        F.col("load_ts"),
    )
