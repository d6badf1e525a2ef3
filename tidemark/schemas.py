"""Table schemas and fixed contracts of the pool-hour model.

All times inside the library are ``TIMESTAMP_NTZ`` holding UTC wall-clock
time, so no result depends on the session time zone.  Sources that carry
instants (JSONL landing files) are normalised on read.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The 13-feature vector contract, in this order.
FEATURES: list[str] = [
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

# Integer-typed members of the feature vector.
INT_FEATURES: frozenset[str] = frozenset({"tx_count", "hour_of_day", "day_of_week"})

# Per-protocol JSON field map.  Each staging column is the first
# non-null of its candidate paths; the name the API actually returns comes
# first, the older/alternative name second.
FIELD_MAP: dict[str, dict[str, list[str]]] = {
    "uniswap_v3": {
        "volume_usd": ["volumeUSD"],
        "tvl_usd": ["tvlUSD", "totalValueLockedUSD"],
        "liquidity": ["liquidity", "totalValueLockedUSD"],
        "tx_count": ["txCount"],
    },
    "sushiswap_v3": {
        "volume_usd": ["volumeUSD"],
        "tvl_usd": ["tvlUSD", "totalValueLockedUSD"],
        "liquidity": ["liquidity", "liquidityUSD"],
        "tx_count": ["txCount", "hourlyTxns"],
    },
}

# Raw landing row as written to JSONL: the record stays JSON text.
RAW_JSONL = T.StructType(
    [
        T.StructField("raw", T.StringType(), False),
        T.StructField("pool_id", T.StringType(), False),
        T.StructField("dex_protocol", T.StringType(), False),
        T.StructField("hour_ts", T.TimestampType(), False),
        T.StructField("load_ts", T.TimestampType(), False),
    ]
)

RAW_REQUIRED: list[str] = ["raw", "pool_id", "dex_protocol", "hour_ts", "load_ts"]

STAGING = T.StructType(
    [
        T.StructField("dex_protocol", T.StringType(), False),
        T.StructField("pool_id", T.StringType(), False),
        T.StructField("hour_ts", T.TimestampNTZType(), False),
        T.StructField("volume_usd", T.DoubleType()),
        T.StructField("tvl_usd", T.DoubleType()),
        T.StructField("liquidity", T.DoubleType()),
        T.StructField("tx_count", T.LongType()),
        T.StructField("has_negative_values", T.BooleanType()),
        T.StructField("load_ts", T.TimestampNTZType()),
    ]
)

_FEATURE_FIELDS = [
    T.StructField(name, T.LongType() if name in INT_FEATURES else T.DoubleType()) for name in FEATURES
]

LABELED = T.StructType(
    [
        T.StructField("dex_protocol", T.StringType(), False),
        T.StructField("pool_id", T.StringType(), False),
        T.StructField("hour_ts", T.TimestampNTZType(), False),
        *_FEATURE_FIELDS,
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("anomaly_score", T.DoubleType()),
    ]
)

FEATURE_VALUES = T.StructType(
    [
        T.StructField("entity_id", T.StringType(), False),
        T.StructField("feature_timestamp", T.TimestampNTZType(), False),
        *_FEATURE_FIELDS,
    ]
)

# Landing-file timestamp text, ISO-8601 UTC, fraction optional.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"

FAR_PAST = "1900-01-01 00:00:00"
