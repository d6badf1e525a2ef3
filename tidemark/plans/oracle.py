"""DuckDB SQL equivalents of the registered queries, over the driver's tables.

Each string recomputes the pool-hour fixture from ``events`` and then states
the query the way the reference's SQL does.  Doubles are rounded to 6 digits
on both sides (window sums differ in the last bits between engines).
"""

from __future__ import annotations

AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def r6(cols: list[str], doubles: set[str], prefix: str = "") -> str:
    return ",\n  ".join(f"round({prefix}{c}, 6) AS {c}" if c in doubles else f"{prefix}{c}" for c in cols)


POOL_HOURS = """
pool_hours AS (
  SELECT
    CASE WHEN user_id % 2 = 0 THEN 'uniswap_v3' ELSE 'sushiswap_v3' END AS dex_protocol,
    'pool_' || CAST(user_id AS VARCHAR) AS pool_id,
    CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_ts,
    round(sum(CASE WHEN event_type = 'error' THEN -value ELSE value END), 6) AS volume_usd,
    max(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS tvl_usd,
    sum(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS liquidity,
    count(*) AS tx_count,
    max(ts) AS load_ts
  FROM events
  GROUP BY user_id, date_trunc('hour', ts)
)"""

POOL_HOURS_OHLC = """
pool_hours AS (
  SELECT
    CASE WHEN user_id % 2 = 0 THEN 'uniswap_v3' ELSE 'sushiswap_v3' END AS dex_protocol,
    'pool_' || CAST(user_id AS VARCHAR) AS pool_id,
    CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_ts,
    round(sum(sv), 6) AS volume_usd,
    max(k) AS tvl_usd,
    sum(k) AS liquidity,
    count(*) AS tx_count,
    'token_' || CAST(user_id % 10 AS VARCHAR) AS token0_id,
    'token_' || CAST((user_id + 1) % 10 + 10 AS VARCHAR) AS token1_id,
    arg_min(sv, (ts, event_id)) AS open,
    max(sv) AS high,
    min(sv) AS low,
    arg_max(sv, (ts, event_id)) AS close,
    max(ts) AS load_ts
  FROM (SELECT *, CASE WHEN event_type = 'error' THEN -value ELSE value END AS sv,
               TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
  GROUP BY user_id, date_trunc('hour', ts)
)"""

STG = """
stg AS (
  SELECT dex_protocol, pool_id, hour_ts, volume_usd, tvl_usd, liquidity, tx_count,
    CASE WHEN volume_usd < 0 OR tvl_usd < 0 THEN TRUE ELSE FALSE END AS has_negative_values,
    load_ts
  FROM pool_hours
)"""


def _win(frame: str = "") -> str:
    return f"OVER (PARTITION BY pool_id ORDER BY hour_ts, dex_protocol{frame})"


def features_cte(rate_form: str = "diff", source: str = "stg", name: str = "f", as_of_sql: str = AS_OF_SQL,
                 lookback: int | None = 90) -> str:
    if rate_form == "diff":
        vr = "(volume_usd - v24) / nullif(v24, 0)"
        tr = "(tvl_usd - t24) / nullif(t24, 0)"
    else:
        vr = "volume_usd / nullif(v24, 0) - 1"
        tr = "tvl_usd / nullif(t24, 0) - 1"
    return f"""
hm_{name} AS (
  SELECT dex_protocol, pool_id, hour_ts, volume_usd, tvl_usd, liquidity, tx_count,
    lag(volume_usd, 24) {_win()} AS v24,
    lag(tvl_usd, 24) {_win()} AS t24,
    avg(volume_usd) {_win(' ROWS BETWEEN 5 PRECEDING AND CURRENT ROW')} AS vol_ma_6h,
    avg(volume_usd) {_win(' ROWS BETWEEN 23 PRECEDING AND CURRENT ROW')} AS vol_ma_24h,
    stddev_samp(volume_usd) {_win(' ROWS BETWEEN 23 PRECEDING AND CURRENT ROW')} AS vol_std_24h
  FROM {source}
  WHERE NOT has_negative_values
),
{name} AS (
  SELECT dex_protocol, pool_id, hour_ts, volume_usd, tvl_usd, liquidity, tx_count,
    {vr} AS vol_rate_24h,
    {tr} AS tvl_rate_24h,
    vol_ma_6h, vol_ma_24h, vol_std_24h,
    volume_usd / nullif(tvl_usd, 0) AS vol_tvl_ratio,
    (volume_usd - vol_ma_24h) / nullif(vol_std_24h, 0) AS volume_zscore,
    CAST(hour(hour_ts) AS BIGINT) AS hour_of_day,
    CAST(dayofweek(hour_ts) + 1 AS BIGINT) AS day_of_week,
    CAST(date_diff('hour', hour_ts, {as_of_sql}) AS BIGINT) AS hours_ago
  FROM hm_{name}
  {f"WHERE hour_ts >= {as_of_sql} - INTERVAL {lookback} DAY" if lookback is not None else ""}
)"""


FEATURE_COLS = [
    "dex_protocol", "pool_id", "hour_ts", "volume_usd", "tvl_usd", "liquidity", "tx_count",
    "vol_rate_24h", "tvl_rate_24h", "vol_ma_6h", "vol_ma_24h", "vol_std_24h", "vol_tvl_ratio",
    "volume_zscore", "hour_of_day", "day_of_week",
]
FEATURE_DOUBLES = {
    "volume_usd", "tvl_usd", "liquidity", "vol_rate_24h", "tvl_rate_24h", "vol_ma_6h", "vol_ma_24h",
    "vol_std_24h", "vol_tvl_ratio", "volume_zscore",
}
LABELED_COLS = FEATURE_COLS + ["is_anomaly", "anomaly_score"]
LABELED_DOUBLES = FEATURE_DOUBLES | {"anomaly_score"}


def labeled_cte(score: str = "abs(f.volume_zscore)", name: str = "lab", pct: str = "quantile_cont(volume_usd, 0.9)") -> str:
    cols = ", ".join(f"f.{c}" for c in FEATURE_COLS)
    return f"""
pct AS (
  SELECT pool_id, {pct} AS pct_90 FROM f GROUP BY pool_id
),
{name} AS (
  SELECT {cols},
    CASE WHEN f.volume_usd >= p.pct_90 THEN TRUE ELSE FALSE END AS is_anomaly,
    CAST({score} AS DOUBLE) AS anomaly_score
  FROM f JOIN pct p ON f.pool_id = p.pool_id
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


STG_COLS = ["dex_protocol", "pool_id", "hour_ts", "volume_usd", "tvl_usd", "liquidity", "tx_count",
            "has_negative_values", "load_ts"]

SQL: dict[str, str] = {}

SQL["stg_pool_hourly_all"] = f"""
{with_ctes(POOL_HOURS, STG)}
SELECT {r6(STG_COLS, {"volume_usd", "tvl_usd", "liquidity"})}
FROM stg
WHERE CAST(hour_ts AS DATE) >= CAST({AS_OF_SQL} AS DATE) - INTERVAL 90 DAY
"""

_OHLC_COLS = ["dex_protocol", "pool_id", "hour_ts", "volume_usd", "tvl_usd", "liquidity", "tx_count",
              "token0_id", "token1_id", "open", "high", "low", "close", "has_negative_values", "load_ts"]
SQL["stg_pool_hourly_ohlc"] = f"""
{with_ctes(POOL_HOURS_OHLC)}
SELECT {r6(_OHLC_COLS[:-2], {"volume_usd", "tvl_usd", "liquidity", "open", "high", "low", "close"})},
  CASE WHEN volume_usd < 0 OR tvl_usd < 0 THEN TRUE ELSE FALSE END AS has_negative_values,
  load_ts
FROM pool_hours
"""

SQL["pool_features"] = f"""
{with_ctes(POOL_HOURS, STG, features_cte())}
SELECT {r6(FEATURE_COLS + ["hours_ago"], FEATURE_DOUBLES)}
FROM f
"""

SQL["change_rate_ratio"] = f"""
{with_ctes(POOL_HOURS, STG, features_cte("ratio"))}
SELECT pool_id, hour_ts, round(vol_rate_24h, 6) AS vol_rate_24h, round(tvl_rate_24h, 6) AS tvl_rate_24h
FROM f
"""

SQL["pool_features_labeled"] = f"""
{with_ctes(POOL_HOURS, STG, features_cte(), labeled_cte(score="NULL"))}
SELECT {r6(LABELED_COLS, LABELED_DOUBLES)}
FROM lab
"""

SQL["pool_p90"] = f"""
{with_ctes(POOL_HOURS, STG, features_cte())}
SELECT pool_id, round(quantile_cont(volume_usd, 0.9), 6) AS pct_90
FROM f GROUP BY pool_id
"""

# The newest row of a pool: the row that arg_max picks by (hour, protocol).
SQL["latest_status"] = f"""
{with_ctes(POOL_HOURS, STG, features_cte(), labeled_cte())},
newest AS (
  SELECT arg_max(lab, (hour_ts, dex_protocol)) AS r
  FROM lab
  WHERE date_diff('second', hour_ts, {AS_OF_SQL}) <= 24 * 3600
  GROUP BY pool_id
),
flat AS (SELECT unnest(r) FROM newest)
SELECT {r6(LABELED_COLS, LABELED_DOUBLES)} FROM flat
"""

# A pool's week as one sorted list: totals are list aggregates, the rows its unnested entries from the newest back.
def _dashboard_sql(ctes: str, as_of: str = AS_OF_SQL, days: int = 7) -> str:
    return f"""
{ctes},
week AS (
  SELECT pool_id, list(struct_pack(h := hour_ts, d := dex_protocol, v := volume_usd, t := tvl_usd, l := liquidity,
                                   s := anomaly_score, a := is_anomaly) ORDER BY hour_ts DESC, dex_protocol DESC) AS e,
         avg(volume_usd) AS mean_volume, avg(tvl_usd) AS mean_tvl
  FROM lab
  WHERE date_diff('second', hour_ts, {as_of}) <= {days} * 86400
  GROUP BY pool_id
),
spread AS (
  SELECT pool_id, e, mean_volume, mean_tvl, len(e) AS n, len(list_filter(e, lambda x: x.a)) AS bad,
         unnest(range(1, least(len(e), 168) + 1)) AS k
  FROM week
)
SELECT pool_id, e[k].h AS hour_ts, round(e[k].v, 6) AS volume_usd, round(e[k].t, 6) AS tvl_usd,
  round(e[k].l, 6) AS liquidity, round(e[k].s, 6) AS anomaly_score,
  if(e[k].a, 'Anomaly Detected', 'Normal') AS status,
  (k = 1 AND e[k].a) AS needs_alert,
  bad::BIGINT AS anomaly_hours, n::BIGINT AS total_hours,
  round(round(bad::DOUBLE / n::DOUBLE * 100, 2), 6) AS anomaly_rate_pct,
  round(mean_volume, 6) AS avg_volume, round(mean_tvl, 6) AS avg_tvl,
  round(list_max(list_transform(e, lambda x: x.s)), 6) AS max_anomaly_score
FROM spread
"""


SQL["anomaly_dashboard"] = _dashboard_sql(with_ctes(POOL_HOURS, STG, features_cte(), labeled_cte()))

# The earlier hour is found by its rank among the hours, not by a lag.
SQL["anomaly_timeseries"] = f"""
{with_ctes(POOL_HOURS, STG, features_cte(), labeled_cte())},
by_hour AS (
  SELECT hour_ts AS h, count(DISTINCT pool_id) AS pools, sum(volume_usd) AS v, sum(tvl_usd) AS t,
         count(*) FILTER (is_anomaly) AS bad, avg(anomaly_score) AS score
  FROM lab
  WHERE date_diff('second', hour_ts, {AS_OF_SQL}) <= 30 * 86400
  GROUP BY hour_ts
),
placed AS (SELECT *, dense_rank() OVER (ORDER BY h) AS k FROM by_hour)
SELECT CAST(x.h AS DATE) AS date, CAST(hour(x.h) AS BIGINT) AS hour, x.pools AS active_pools,
  round(x.v, 6) AS total_volume, round(x.t, 6) AS total_tvl, CAST(x.bad AS BIGINT) AS anomaly_count,
  round(x.score, 6) AS avg_anomaly_score,
  round(CAST(x.bad AS DOUBLE) / CAST(x.pools AS DOUBLE) * 100, 6) AS anomaly_rate_pct,
  round(y.v, 6) AS volume_24h_ago, CAST(y.bad AS BIGINT) AS anomaly_count_24h_ago
FROM placed x LEFT JOIN placed y ON y.k = x.k - 24
"""

# ---- store, maintenance and look-up queries -------------------------------------

_FEATS13 = FEATURE_COLS[3:]
_FEAT_DOUBLES13 = {c for c in _FEATS13 if c in FEATURE_DOUBLES}

SQL["feature_export"] = f"""
{with_ctes(POOL_HOURS, STG, features_cte(), labeled_cte())}
SELECT pool_id AS entity_id, hour_ts AS feature_timestamp,
  {r6(_FEATS13, _FEAT_DOUBLES13)}
FROM lab
WHERE hour_ts >= {AS_OF_SQL} - INTERVAL 1 HOUR AND hour_ts < {AS_OF_SQL}
"""


#: Every pool, and ids without rows.
ALL_IDS = """
ids AS (SELECT DISTINCT pool_id FROM pool_hours UNION ALL SELECT 'absent_' || CAST(s_suppkey AS VARCHAR) FROM supplier)"""


def latest_cte(source: str = "lab", where: str = "TRUE", name: str = "l") -> str:
    """The newest value of each feature that is not NULL."""
    cells = ", ".join(f"arg_max({c}, hour_ts) FILTER ({c} IS NOT NULL) AS {c}" for c in _FEATS13)
    return f"""
{name} AS (
  SELECT pool_id AS entity_id, max(hour_ts) AS feature_timestamp, {cells} FROM {source} WHERE {where} GROUP BY pool_id
)"""


def _read_features_sql(default: str | None, source: str = "lab", more: tuple[str, ...] = ()) -> str:
    def val(c: str) -> str:
        v = f"CAST(l.{c} AS DOUBLE)"
        v = v if default is None else f"coalesce({v}, {default})"
        return f"round({v}, 6) AS {c}"

    used = " + ".join(f"(CASE WHEN l.{c} IS NOT NULL THEN 1 ELSE 0 END)" for c in _FEATS13)
    return f"""
{with_ctes(POOL_HOURS, STG, features_cte(), labeled_cte(), *more, latest_cte(source), ALL_IDS)}
SELECT ids.pool_id,
  {", ".join(val(c) for c in _FEATS13)},
  CAST({used} AS BIGINT) AS features_used,
  CAST(13 - ({used}) AS BIGINT) AS features_missing
FROM ids LEFT JOIN l ON ids.pool_id = l.entity_id
"""


SQL["latest_features"] = _read_features_sql("0.0")
SQL["feature_lookup"] = _read_features_sql(None)

_DERIVED = [c for c in _FEATS13 if c not in ("volume_usd", "tvl_usd", "liquidity", "tx_count")]
SQL["partial_rows_lookup"] = _read_features_sql(None, "cut", (f"""
cut AS (
  SELECT pool_id, hour_ts, {", ".join(c if c not in _DERIVED else f"CASE WHEN tx_count > 1 THEN {c} END AS {c}" for c in _FEATS13)}
  FROM lab
)""",))

SQL["incremental_features"] = SQL["pool_features"]

SQL["upsert_labeled"] = f"""
{with_ctes(POOL_HOURS, STG, features_cte(),
           labeled_cte(score=f"CASE WHEN f.hour_ts >= {AS_OF_SQL} - INTERVAL 7 DAY THEN abs(f.volume_zscore) END"))}
SELECT {r6(LABELED_COLS, LABELED_DOUBLES)}
FROM lab
"""

RELOAD = f"""
reloaded AS (
  SELECT dex_protocol, pool_id, hour_ts, volume_usd, tvl_usd, liquidity, tx_count, load_ts FROM pool_hours
  UNION ALL
  SELECT
    CASE WHEN user_id % 2 = 0 THEN 'uniswap_v3' ELSE 'sushiswap_v3' END,
    'pool_' || CAST(user_id AS VARCHAR),
    CAST(date_trunc('hour', ts) AS TIMESTAMP),
    round(sum(value), 6),
    max(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)),
    sum(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)),
    count(*),
    {AS_OF_SQL}
  FROM events
  WHERE ts >= TIMESTAMP '2024-01-30 00:00:00'
  GROUP BY user_id, date_trunc('hour', ts)
)"""

SQL["dedup_latest"] = f"""
{with_ctes(POOL_HOURS, RELOAD)}
SELECT {r6(STG_COLS[:-2], {"volume_usd", "tvl_usd", "liquidity"})},
  CASE WHEN volume_usd < 0 OR tvl_usd < 0 THEN TRUE ELSE FALSE END AS has_negative_values,
  load_ts
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY dex_protocol, pool_id, hour_ts ORDER BY load_ts DESC) AS rn
  FROM reloaded
) WHERE rn = 1
"""

SQL["retention_prune"] = f"""
{with_ctes(POOL_HOURS, STG)}
SELECT {r6(STG_COLS, {"volume_usd", "tvl_usd", "liquidity"})}
FROM stg
WHERE CAST(hour_ts AS DATE) >= CAST({AS_OF_SQL} AS DATE) - INTERVAL 7 DAY
"""

SQL["import_stats"] = f"""
{with_ctes(POOL_HOURS, STG, features_cte(), labeled_cte())}
SELECT COUNT(DISTINCT pool_id) AS imported_entity_count,
  CAST({" + ".join(f"COUNT({c})" for c in _FEATS13)} AS BIGINT) AS imported_feature_value_count
FROM lab
"""

SQL["not_null_report"] = f"""
{with_ctes(POOL_HOURS, STG)}
{" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
    f"COUNT(*) AS row_count, count_if({c} IS NULL) = 0 AS passed FROM stg"
    for c in STG_COLS)}
"""

SQL["interval_page"] = f"""
{with_ctes(POOL_HOURS, STG)}
SELECT {r6(STG_COLS, {"volume_usd", "tvl_usd", "liquidity"})}
FROM stg
WHERE hour_ts >= {AS_OF_SQL} - INTERVAL 24 HOUR AND hour_ts < {AS_OF_SQL}
ORDER BY hour_ts, pool_id, dex_protocol
LIMIT 100 OFFSET 100
"""

SQL["high_water_mark"] = f"""
{with_ctes(POOL_HOURS, STG, features_cte())}
SELECT coalesce(max(hour_ts), TIMESTAMP '1900-01-01 00:00:00') AS high_water FROM f
"""

SQL["predict_ids"] = f"""
{with_ctes(POOL_HOURS, STG, features_cte(), labeled_cte())},
latest AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY pool_id ORDER BY hour_ts DESC, dex_protocol DESC) AS rn
    FROM lab WHERE hour_ts >= {AS_OF_SQL} - INTERVAL 24 HOUR
  ) WHERE rn = 1
),
req AS (
  SELECT user_id // 100 AS request_id,
    ROW_NUMBER() OVER (PARTITION BY user_id // 100 ORDER BY user_id) - 1 AS position,
    'pool_' || CAST(user_id AS VARCHAR) AS pool_id
  FROM (SELECT DISTINCT user_id FROM events)
)
SELECT req.request_id, req.position, req.pool_id,
  round(coalesce(l.anomaly_score, 0.0), 6) AS anomaly_score,
  coalesce(l.is_anomaly, FALSE) AS is_anomaly
FROM req LEFT JOIN latest l ON req.pool_id = l.pool_id
"""

SQL["stream_hourly_stats"] = f"""
{with_ctes(POOL_HOURS, STG)}
SELECT hour_ts, COUNT(DISTINCT pool_id) AS active_pools,
  round(SUM(volume_usd), 6) AS total_volume,
  round(SUM(tvl_usd), 6) AS total_tvl,
  CAST(SUM(CASE WHEN has_negative_values THEN 1 ELSE 0 END) AS BIGINT) AS flagged_count
FROM stg
GROUP BY hour_ts
"""

SQL["stream_dedup_latest"] = SQL["dedup_latest"]
SQL["stream_features"] = SQL["pool_features"]

SQL["pool_p90_approx"] = f"""
{with_ctes(POOL_HOURS, STG, features_cte())}
SELECT pool_id, round(quantile_disc(volume_usd, 0.9), 6) AS pct_90
FROM f GROUP BY pool_id
"""

# ---- supplier-day series over lineitem ------------------------------------------------

SUPPLY_AS_OF_SQL = "TIMESTAMP '2001-11-05 00:00:00'"

SUPPLIER_DAYS = """
pool_hours AS (
  SELECT
    CASE WHEN l_suppkey % 2 = 0 THEN 'uniswap_v3' ELSE 'sushiswap_v3' END AS dex_protocol,
    'supplier_' || CAST(l_suppkey AS VARCHAR) AS pool_id,
    CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS hour_ts,
    sum(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END) AS volume_usd,
    max(l_extendedprice) AS tvl_usd,
    sum(l_extendedprice * (1.0 - l_discount)) AS liquidity,
    count(*) AS tx_count,
    max(l_shipdate) AS load_ts
  FROM lineitem
  GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
)"""

SQL["supplier_day_features"] = f"""
{with_ctes(SUPPLIER_DAYS, STG, features_cte(as_of_sql=SUPPLY_AS_OF_SQL, lookback=None))}
SELECT {r6(FEATURE_COLS + ["hours_ago"], FEATURE_DOUBLES)} FROM f
"""

SQL["supplier_day_labeled"] = f"""
{with_ctes(SUPPLIER_DAYS, STG, features_cte(as_of_sql=SUPPLY_AS_OF_SQL, lookback=None),
           labeled_cte(score="NULL"))}
SELECT {r6(LABELED_COLS, LABELED_DOUBLES)} FROM lab
"""

# ---- written tables ----------------------------------------------------------------------

SQL["raw_json_fields"] = f"""
{with_ctes(POOL_HOURS_OHLC)}
SELECT dex_protocol, pool_id, hour_ts,
  pool_id AS doc_pool_id,
  token0_id,
  round(volume_usd, 6) AS volume_usd,
  round(CASE WHEN dex_protocol = 'uniswap_v3' THEN tvl_usd END, 6) AS tvl_usd_uni,
  CASE WHEN dex_protocol = 'sushiswap_v3' THEN tx_count END AS tx_count_sushi,
  round(close, 6) AS close,
  3000.0 AS fee_tier,
  hour_ts AS period_start,
  CAST(NULL AS VARCHAR) AS missing
FROM pool_hours
"""

SQL["raw_rejects"] = f"""
{with_ctes(POOL_HOURS)}
SELECT dex_protocol, hour_ts, CAST(count_if(tx_count = 1) AS BIGINT) AS without_record,
  CAST(count_if(tx_count = 2) AS BIGINT) AS without_pool
FROM pool_hours WHERE tx_count <= 2 GROUP BY dex_protocol, hour_ts
"""

SQL["stream_labeled"] = SQL["pool_features_labeled"]

SQL["raw_table_ingest"] = SQL["stg_pool_hourly_all"]
SQL["labeled_table_upsert"] = SQL["upsert_labeled"]

# ---- the same views from written tables ---------------------------------------------------

SQL["stored_feature_export"] = SQL["feature_export"]
SQL["stored_latest_status"] = SQL["latest_status"]
SQL["stored_dashboard"] = SQL["anomaly_dashboard"]
SQL["stored_timeseries"] = SQL["anomaly_timeseries"]

SQL["last_hour_features"] = f"""
{with_ctes(POOL_HOURS, STG, features_cte())}
SELECT {r6(FEATURE_COLS + ["hours_ago"], FEATURE_DOUBLES)} FROM f
WHERE hour_ts >= {AS_OF_SQL} - INTERVAL 1 HOUR AND hour_ts < {AS_OF_SQL}
"""

# The value 24 hours before by a join on the hour; averages over ranges of time.
SQL["pool_features_by_time"] = f"""
{with_ctes(POOL_HOURS, STG)},
good AS (SELECT * FROM stg WHERE NOT has_negative_values),
spans AS (
  SELECT *,
    avg(volume_usd) OVER (PARTITION BY pool_id ORDER BY hour_ts RANGE BETWEEN INTERVAL 5 HOUR PRECEDING AND CURRENT ROW) AS vol_ma_6h,
    avg(volume_usd) OVER (PARTITION BY pool_id ORDER BY hour_ts RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW) AS vol_ma_24h,
    stddev_samp(volume_usd) OVER (PARTITION BY pool_id ORDER BY hour_ts RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW) AS vol_std_24h
  FROM good
),
f AS (
  SELECT s.dex_protocol, s.pool_id, s.hour_ts, s.volume_usd, s.tvl_usd, s.liquidity, s.tx_count,
    (s.volume_usd - p.volume_usd) / nullif(p.volume_usd, 0) AS vol_rate_24h,
    (s.tvl_usd - p.tvl_usd) / nullif(p.tvl_usd, 0) AS tvl_rate_24h,
    s.vol_ma_6h, s.vol_ma_24h, s.vol_std_24h, s.volume_usd / nullif(s.tvl_usd, 0) AS vol_tvl_ratio,
    (s.volume_usd - s.vol_ma_24h) / nullif(s.vol_std_24h, 0) AS volume_zscore,
    CAST(hour(s.hour_ts) AS BIGINT) AS hour_of_day, CAST(dayofweek(s.hour_ts) + 1 AS BIGINT) AS day_of_week,
    CAST(date_diff('hour', s.hour_ts, {AS_OF_SQL}) AS BIGINT) AS hours_ago
  FROM spans s LEFT JOIN good p ON p.pool_id = s.pool_id AND p.hour_ts = s.hour_ts - INTERVAL 24 HOUR
  WHERE s.hour_ts >= {AS_OF_SQL} - INTERVAL 90 DAY
)
SELECT {r6(FEATURE_COLS + ["hours_ago"], FEATURE_DOUBLES)} FROM f
"""

SQL["retention_table"] = f"""
{with_ctes(POOL_HOURS, STG)}
SELECT {r6(STG_COLS, {"volume_usd", "tvl_usd", "liquidity"})}, NOT has_negative_values AS exported
FROM stg
WHERE CAST(hour_ts AS DATE) >= CAST({AS_OF_SQL} AS DATE) - INTERVAL 7 DAY
"""

SQL["compacted_table"] = f"""
{with_ctes(POOL_HOURS, STG)}
SELECT {r6(STG_COLS, {"volume_usd", "tvl_usd", "liquidity"})}, TRUE AS few_files FROM stg
"""

SQL["seek_page"] = f"""
{with_ctes(POOL_HOURS, STG)}
SELECT {r6(STG_COLS, {"volume_usd", "tvl_usd", "liquidity"})}
FROM stg ORDER BY hour_ts, pool_id, dex_protocol LIMIT 333 OFFSET 444
"""

SQL["supplier_recent_features"] = f"""
{with_ctes(SUPPLIER_DAYS, STG, features_cte(as_of_sql=SUPPLY_AS_OF_SQL, lookback=90))}
SELECT {r6(FEATURE_COLS + ["hours_ago"], FEATURE_DOUBLES)} FROM f
"""

SQL["supplier_dashboard"] = _dashboard_sql(
    with_ctes(SUPPLIER_DAYS, STG, features_cte(as_of_sql=SUPPLY_AS_OF_SQL, lookback=None), labeled_cte()), SUPPLY_AS_OF_SQL, 1500)

# ---- Isolation Forest: sample, growth and walk, level by level ---------------------------

TREES, PSI, HEIGHT, SEED, PRIME = 200, 256, 8, 42, 2147483647


def _digits(*parts: str, n: int = 12) -> str:
    return f"('0x' || substr(md5({" || '|' || ".join(parts)}), 1, {n}))::BIGINT"


def _vec(prefix: str = "") -> str:
    return "[" + ", ".join(f"round(coalesce(CAST({prefix}{c} AS DOUBLE), 0.0) * 1e6) / 1e6" for c in _FEATS13) + "]"


def forest_cte() -> str:
    """``nodes`` of the forest trained on the last 30 days of ``lab``."""
    lo = ", ".join(f"min(x[{i}])" for i in range(1, 14))
    hi = ", ".join(f"max(x[{i}])" for i in range(1, 14))
    fraction = lambda name: f"{_digits(repr(str(SEED)), 'tree', 'node', repr(name))} / 281474976710656.0"
    ctes = [f"""
train AS MATERIALIZED (
  SELECT {_digits("pool_id", "CAST(hour_ts AS VARCHAR)", n=15)} AS k, {_vec()} AS x
  FROM lab WHERE hour_ts >= {AS_OF_SQL} - INTERVAL 30 DAY
),
numbers AS (
  SELECT t AS tree, {_digits(repr(str(SEED)), "t", "'a'")} % {PRIME - 1} + 1 AS a, {_digits(repr(str(SEED)), "t", "'b'")} % {PRIME} AS b
  FROM (SELECT unnest(range(0, {TREES})) AS t)
),
l0 AS MATERIALIZED (
  SELECT tree, x, 0 AS node FROM train, numbers
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY (a * (k % {PRIME}) + b) % {PRIME}, k, x) <= {PSI}
)"""]
    for d in range(HEIGHT + 1):
        ctes.append(f"""
s{d} AS (
  SELECT tree, node, count(*) AS size, [{lo}] AS lo, [{hi}] AS hi FROM l{d} GROUP BY tree, node
),
o{d} AS (
  SELECT *, list_filter(range(1, 14), lambda i: hi[i] > lo[i]) AS open FROM s{d}
),
f{d} AS (
  SELECT *, CASE WHEN {d} < {HEIGHT} AND len(open) > 0
    THEN open[1 + CAST(floor({fraction("feature")} * len(open)) AS INT)] ELSE 0 END AS feature FROM o{d}
),
a{d} AS (
  SELECT *, lo[feature] + {fraction("split")} * (hi[feature] - lo[feature]) AS s FROM f{d}
),
n{d} AS MATERIALIZED (
  SELECT tree, node, feature, CASE WHEN feature = 0 THEN 0.0 WHEN s > lo[feature] AND s <= hi[feature] THEN s
    ELSE (lo[feature] + hi[feature]) / 2.0 END AS split, size, {d} AS depth FROM a{d}
)""")
        if d < HEIGHT:
            ctes.append(f"""
l{d + 1} AS MATERIALIZED (
  SELECT l.tree, x, 2 * l.node + CASE WHEN x[feature] < split THEN 1 ELSE 2 END AS node
  FROM l{d} l JOIN n{d} n ON n.tree = l.tree AND n.node = l.node WHERE feature > 0
)""")
    ctes.append("""
nodes AS MATERIALIZED (
""" + " UNION ALL ".join(f"SELECT * FROM n{d}" for d in range(HEIGHT + 1)) + """
)""")
    return ",".join(ctes)


def scored_cte(source: str, name: str = "scored", key: str = "r") -> str:
    """``(key, score)`` of every row of ``source``, which has ``key`` and the vector ``x``."""
    c = lambda n: f"CASE WHEN {n} > 2 THEN 2.0 * (ln({n} - 1.0) + 0.5772156649015329) - 2.0 * ({n} - 1.0) / {n} WHEN {n} = 2 THEN 1.0 ELSE 0.0 END"
    ctes = [f"""
{name}_w0 AS (SELECT {key}, x, t AS tree, 0 AS node FROM {source}, (SELECT unnest(range(0, {TREES})) AS t))"""]
    for d in range(HEIGHT):
        ctes.append(f"""
{name}_w{d + 1} AS (
  SELECT w.{key}, x, w.tree, CASE WHEN feature = 0 THEN w.node WHEN x[feature] < split THEN 2 * w.node + 1 ELSE 2 * w.node + 2 END AS node
  FROM {name}_w{d} w JOIN nodes n ON n.tree = w.tree AND n.node = w.node
)""")
    psi = f"(SELECT least({PSI}, count(*)) FROM train)"
    ctes.append(f"""
{name} AS MATERIALIZED (
  SELECT w.{key}, pow(2.0, -(sum(round((depth + {c("size")}) * 1099511627776.0) / 1099511627776.0) / {TREES}) / (SELECT {c("n")} FROM (SELECT {psi} AS n))) AS score
  FROM {name}_w{HEIGHT} w JOIN nodes n ON n.tree = w.tree AND n.node = w.node GROUP BY w.{key}
)""")
    return ",".join(ctes)


def _forest_sql(*more: str) -> str:
    return with_ctes(POOL_HOURS, STG, features_cte(), labeled_cte(), forest_cte(), *more)


ALL_ROWS = f"""
points AS MATERIALIZED (SELECT row_number() OVER () AS r, dex_protocol, pool_id, hour_ts, {_vec()} AS x FROM lab)"""
OFFSET = """
edge AS (SELECT quantile_disc(score, 0.9) AS cut FROM scored)"""

SQL["iforest_scores"] = f"""
{_forest_sql(ALL_ROWS, scored_cte("points"))}
SELECT pool_id, hour_ts, round(score, 6) AS anomaly_score FROM points JOIN scored USING (r)
"""

SQL["iforest_decisions"] = f"""
{_forest_sql(ALL_ROWS, scored_cte("points"), OFFSET)}
SELECT pool_id, hour_ts, round(score, 6) AS anomaly_score, score >= 3.0 AS is_anomaly, 3.0::DOUBLE AS threshold,
  CASE WHEN score > cut THEN -1 ELSE 1 END AS prediction
FROM points JOIN scored USING (r), edge
"""

SQL["iforest_mean_score"] = f"""
{_forest_sql(ALL_ROWS, scored_cte("points"))}
SELECT round(avg(score), 6) AS mean_anomaly_score, count(*) AS rows FROM scored
"""

_USED = " + ".join(f"(CASE WHEN l.{c} IS NOT NULL THEN 1 ELSE 0 END)" for c in _FEATS13)
SQL["predict_pools"] = f"""
{_forest_sql(latest_cte(), ALL_IDS, f"""
asked AS MATERIALIZED (
  SELECT ids.pool_id, {_vec("l.")} AS x, {_USED} AS used FROM ids LEFT JOIN l ON l.entity_id = ids.pool_id
)""", scored_cte("asked", key="pool_id"))}
SELECT pool_id, round(score, 6) AS score, score >= 3.0 AS is_anomaly, 3.0::DOUBLE AS threshold, used::BIGINT AS features_used,
  (13 - used)::BIGINT AS features_missing, NULL::VARCHAR AS error
FROM asked JOIN scored USING (pool_id)
"""

_EXPORTED = f"pool_id IN (SELECT pool_id FROM lab WHERE hour_ts >= {AS_OF_SQL} - INTERVAL 1 HOUR AND hour_ts < {AS_OF_SQL})"
SQL["hourly_pipeline"] = f"""
{_forest_sql(latest_cte(where=_EXPORTED), f"""
asked AS MATERIALIZED (SELECT entity_id, feature_timestamp, {_vec()} AS x FROM l)""", scored_cte("asked", key="entity_id"))}
SELECT entity_id, feature_timestamp, round(score, 6) AS anomaly_score, score >= 3.0 AS is_anomaly,
  CASE WHEN score > 0.5 THEN -1 ELSE 1 END AS prediction
FROM asked JOIN scored USING (entity_id)
"""

# One batch up to the mark and one after it; the newest row of a pool in a batch is judged.
SQL["stream_alerts"] = f"""
{_forest_sql(ALL_ROWS, scored_cte("points"), OFFSET)},
newest AS (
  SELECT *, CASE WHEN hour_ts < TIMESTAMP '2024-01-25 00:00:00' THEN 0 ELSE 1 END AS batch_id FROM points
  QUALIFY row_number() OVER (PARTITION BY pool_id, batch_id ORDER BY hour_ts DESC, dex_protocol DESC) = 1
)
SELECT dex_protocol, pool_id, hour_ts, round(score, 6) AS anomaly_score, round(cut, 6) AS threshold, batch_id
FROM newest JOIN scored USING (r), edge WHERE score >= cut
"""

SQL["hourly_write_back"] = f"""
{_forest_sql(latest_cte(where=_EXPORTED), f"""
asked AS MATERIALIZED (SELECT entity_id, feature_timestamp, {_vec()} AS x FROM l)""", scored_cte("asked", key="entity_id"))}
SELECT {r6([f"{c}" for c in FEATURE_COLS], FEATURE_DOUBLES, "lab.")}, is_anomaly, round(score, 6) AS anomaly_score
FROM lab LEFT JOIN asked ON lab.pool_id = asked.entity_id AND lab.hour_ts = asked.feature_timestamp LEFT JOIN scored USING (entity_id)
"""

SQL["iforest_saved_model"] = SQL["iforest_scores"].replace("round(score, 6) AS anomaly_score FROM", "round(score, 6) AS anomaly_score, '1' AS version FROM")

SQL["instance_errors"] = f"""
{_forest_sql(ALL_ROWS, scored_cte("points"), OFFSET)},
checked AS (
  SELECT p.pool_id, p.hour_ts, score, cut, CASE lab.tx_count WHEN 1 THEN 'expected 13 features, got 12' WHEN 2 THEN 'non-finite feature value'
    WHEN 3 THEN 'missing instance' END AS error
  FROM points p JOIN scored USING (r) JOIN lab ON lab.pool_id = p.pool_id AND lab.hour_ts = p.hour_ts AND lab.dex_protocol = p.dex_protocol, edge
)
SELECT pool_id, hour_ts, CASE WHEN error IS NULL THEN round(score, 6) ELSE 0.0 END AS anomaly_score, error IS NULL AND score >= 0.5 AS is_anomaly,
  0.5::DOUBLE AS threshold, CASE WHEN error IS NULL THEN CASE WHEN score > cut THEN -1 ELSE 1 END END AS prediction, error
FROM checked
"""
