"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Every query starts from the driver's tables (``events`` reshaped into pool
hours, see ``tidemark.sources.tables``) and runs the library operators over
all of it.  Double columns are rounded to 6 digits at the very end, the
comparison contract shared with ``tidemark.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.features import high_water, incremental_features, pool_features
from tidemark.operators.lookup import predict_ids, read_features, to_feature_values
from tidemark.operators.maintenance import check_not_null, dedup_latest, import_stats, page, prune, upsert
from tidemark.operators.labels import label, pool_percentile, with_score
from tidemark.operators.staging import flag_negative, stage_pool_hourly
from tidemark.operators.views import anomaly_dashboard, anomaly_timeseries, latest_status
from tidemark.plans import oracle
from tidemark.schemas import FEATURES
from tidemark.sources.raw import hour_slice, to_raw
from tidemark.sources.store import export_feature_values
from tidemark.sources.tables import AS_OF, SUPPLY_AS_OF, load_table, pool_hour_records, pool_hours, supplier_days

Query = Callable[[SparkSession, str], DataFrame]


def round6(df: DataFrame) -> DataFrame:
    """Round doubles to 6 digits as ``round(x * 1e6) / 1e6`` in binary floating point.

    Spark's ``round(x, 6)`` rounds the shortest decimal text of ``x`` while
    DuckDB rounds ``x * 1e6``; they disagree on exact ties such as 2.0534375.
    Rounding the scaled product gives the same double in both engines.
    """
    return df.select(
        *[(F.round(F.col(f.name) * F.lit(1e6)) / F.lit(1e6)).alias(f.name)
          if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
          for f in df.schema.fields]
    )


# ---- building blocks shared by several queries ---------------------------------

def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging rows computed straight from the pool-hour fixture (same values as the JSON path)."""
    ph = pool_hours(spark, sf_dir, signed=True)
    return flag_negative(ph).select(
        "dex_protocol", "pool_id", "hour_ts", "volume_usd", "tvl_usd", "liquidity", "tx_count",
        "has_negative_values", "load_ts",
    )


def raw_envelope(spark: SparkSession, sf_dir: str, ohlc: bool = False) -> DataFrame:
    recs = pool_hour_records(pool_hours(spark, sf_dir, signed=True, ohlc=ohlc))
    return to_raw(recs, F.col("protocol"), load_ts="load_ts")


def features(spark: SparkSession, sf_dir: str, rate_form: str = "diff") -> DataFrame:
    return pool_features(staged(spark, sf_dir), as_of=AS_OF, rate_form=rate_form)


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label(features(spark, sf_dir))


def scored_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows whose ``anomaly_score`` is ``|volume_zscore|`` (SQL-checkable score)."""
    return with_score(labeled(spark, sf_dir), F.abs(F.col("volume_zscore")))


# ---- registered queries --------------------------------------------------------

def q_stg_pool_hourly_all(spark, sf_dir):
    return round6(stage_pool_hourly(raw_envelope(spark, sf_dir), as_of=AS_OF))


def q_stg_pool_hourly_ohlc(spark, sf_dir):
    return round6(stage_pool_hourly(raw_envelope(spark, sf_dir, ohlc=True), ohlc=True))


def q_pool_features(spark, sf_dir):
    return round6(features(spark, sf_dir))


def q_change_rate_ratio(spark, sf_dir):
    return round6(features(spark, sf_dir, rate_form="ratio").select("pool_id", "hour_ts", "vol_rate_24h",
                                                                   "tvl_rate_24h"))


def q_pool_features_labeled(spark, sf_dir):
    return round6(labeled(spark, sf_dir))


def q_pool_p90(spark, sf_dir):
    return round6(pool_percentile(features(spark, sf_dir)))


def q_pool_p90_approx(spark, sf_dir):
    return round6(pool_percentile(features(spark, sf_dir), approx=True))


def q_latest_status(spark, sf_dir):
    return round6(latest_status(scored_labeled(spark, sf_dir), AS_OF))


def q_anomaly_dashboard(spark, sf_dir):
    return round6(anomaly_dashboard(scored_labeled(spark, sf_dir), AS_OF))


def q_anomaly_timeseries(spark, sf_dir):
    return round6(anomaly_timeseries(scored_labeled(spark, sf_dir), AS_OF))


def q_feature_export(spark, sf_dir):
    return round6(export_feature_values(scored_labeled(spark, sf_dir), AS_OF))


def _store_values(spark, sf_dir):
    """All hourly exports, as the store holds them: a read has no time limit."""
    return to_feature_values(scored_labeled(spark, sf_dir))


def _all_pool_ids(spark, sf_dir):
    """Every pool, and as many ids without rows as there are suppliers."""
    absent = load_table(spark, sf_dir, "supplier").select(F.concat(F.lit("absent_"), F.col("s_suppkey").cast("string")).alias("pool_id"))
    return pool_hours(spark, sf_dir).select("pool_id").distinct().unionByName(absent)


def q_latest_features(spark, sf_dir):
    return round6(read_features(_store_values(spark, sf_dir), _all_pool_ids(spark, sf_dir), default=0.0))


def q_feature_lookup(spark, sf_dir):
    return round6(read_features(_store_values(spark, sf_dir), _all_pool_ids(spark, sf_dir), default=None))


def q_partial_rows_lookup(spark, sf_dir):
    """A store whose rows of hours with one event hold the four measures alone: the other features come from older rows."""
    values = _store_values(spark, sf_dir)
    whole = F.col("tx_count") > 1
    derived = [c for c in FEATURES if c not in ("volume_usd", "tvl_usd", "liquidity", "tx_count")]
    values = values.withColumns({c: F.when(whole, F.col(c)) for c in derived})
    return round6(read_features(values, _all_pool_ids(spark, sf_dir), default=None))


MARK = "2024-01-25 00:00:00"
SUPPLY_FROM = "2001-08-07 00:00:00"  # 90 days before the supplier series' own now
LATER = "2024-02-01 00:00:00"


def q_incremental_features(spark, sf_dir):
    """The rows up to a mark written as a table; the mark is read from it, and the rest computed and added (V-1, V-4)."""
    from tidemark.operators.maintenance import write_days
    from tidemark.session import scratch_path

    stg = staged(spark, sf_dir)
    path = scratch_path(spark, "features")
    older = pool_features(stg.filter(F.col("hour_ts") < F.lit(MARK).cast("timestamp_ntz")), as_of=AS_OF)
    write_days(older.withColumn("hour_date", F.to_date("hour_ts")), path, "append")
    target = spark.read.parquet(path).drop("hour_date")
    new = incremental_features(stg, target, as_of=AS_OF)
    return round6(target.select(*older.columns).unionByName(new))


def q_upsert_labeled(spark, sf_dir):
    from tidemark.operators.staging import lookback_days

    target = labeled(spark, sf_dir)
    updates = lookback_days(scored_labeled(spark, sf_dir), AS_OF, 7)
    return round6(upsert(target, updates, ("pool_id", "hour_ts")))


def q_dedup_latest(spark, sf_dir):
    first = raw_envelope(spark, sf_dir)
    again = pool_hours(spark, sf_dir, signed=False).filter(F.col("hour_ts") >= F.lit("2024-01-30").cast(
        "timestamp_ntz"))
    reload = to_raw(pool_hour_records(again), F.col("protocol"), load_ts=AS_OF)
    # Staging is a per-row map that keeps the key and load_ts, so the JSON is parsed
    # map-side and only typed columns are shuffled by the dedup aggregation.
    rows = stage_pool_hourly(first.unionByName(reload), as_of=AS_OF)
    return round6(dedup_latest(rows, ("dex_protocol", "pool_id", "hour_ts"), "load_ts"))


def q_retention_prune(spark, sf_dir):
    return round6(prune(staged(spark, sf_dir), AS_OF, 7))


def q_import_stats(spark, sf_dir):
    return import_stats(to_feature_values(scored_labeled(spark, sf_dir)), FEATURES)


def q_not_null_report(spark, sf_dir):
    stg = stage_pool_hourly(raw_envelope(spark, sf_dir), as_of=AS_OF)
    return check_not_null(stg, stg.columns)


def q_interval_page(spark, sf_dir):
    return round6(page(hour_slice(staged(spark, sf_dir), AS_OF, hours=24), first=100, skip=100))


def q_high_water_mark(spark, sf_dir):
    f = features(spark, sf_dir)
    return spark.range(1).select(high_water(f).alias("high_water"))


def pool_requests(spark, sf_dir):
    """Request batches of at most 100 pool ids (ids grouped by ``user_id div 100``), in id order."""
    users = load_table(spark, sf_dir, "events").select("user_id").distinct()
    req = users.groupBy(F.expr("user_id div 100").alias("request_id")).agg(
        F.sort_array(F.collect_list("user_id")).alias("_ids"))
    return req.select("request_id", F.transform("_ids", lambda u: F.concat(F.lit("pool_"), u.cast("string")))
                      .alias("pool_ids"))


def q_predict_ids(spark, sf_dir):
    from tidemark.operators.views import latest_status as _latest

    scores = _latest(scored_labeled(spark, sf_dir), AS_OF)
    out = predict_ids(pool_requests(spark, sf_dir), scores)
    return round6(out.withColumn("position", F.col("position").cast("bigint")))


# ---- written tables: the batch ingest and the labelled-table maintenance paths ------

def q_raw_json_fields(spark, sf_dir):
    """The JSON column macros (X-1) on raw envelopes: nested paths, numbers, epoch times, absent paths."""
    from tidemark.functions.json import json_float, json_int, json_str, json_ts

    raw = raw_envelope(spark, sf_dir, ohlc=True)
    return round6(raw.select(
        "dex_protocol", "pool_id", "hour_ts",
        json_str("raw", "pool:id").alias("doc_pool_id"),
        json_str("raw", "pool:token0:id").alias("token0_id"),
        json_float("raw", "volumeUSD").alias("volume_usd"),
        json_float("raw", "tvlUSD").alias("tvl_usd_uni"),
        json_int("raw", "hourlyTxns").alias("tx_count_sushi"),
        json_float("raw", "close").alias("close"),
        json_float("raw", "pool:feeTier").alias("fee_tier"),
        json_ts("raw", "periodStartUnix").alias("period_start"),
        json_str("raw", "pool:missing").alias("missing"),
    ))


def q_raw_table_ingest(spark, sf_dir):
    """Batch ingest: landing JSONL (S-15) -> pinned-schema scan (S-2) -> REQUIRED split (S-3) ->
    day-partitioned raw table per protocol (S-4) -> all tables as one source (S-6) -> staging (M-1)."""
    from tidemark.session import scratch_path
    from tidemark.sources.raw import append_raw, enforce_required, read_raw, read_raw_jsonl, write_landing

    inbox = scratch_path(spark, "landing")
    tables = scratch_path(spark, "raw-tables")
    write_landing(raw_envelope(spark, sf_dir), inbox)
    good, _ = enforce_required(read_raw_jsonl(spark, inbox))
    paths = {}
    for (proto,) in good.select("dex_protocol").distinct().collect():  # one raw table per protocol that came in
        paths[proto] = f"{tables}/{proto}"
        append_raw(good.filter(F.col("dex_protocol") == proto), paths[proto])
    raw = read_raw(spark, paths).drop("hour_date")
    return round6(stage_pool_hourly(raw, as_of=AS_OF))


def q_raw_rejects(spark, sf_dir):
    """Rows that fail the REQUIRED check (S-3), landed and read back: pool-hours of one event come without
    their record, those of two without their pool id."""
    from tidemark.session import scratch_path
    from tidemark.sources.raw import enforce_required, read_raw_jsonl, write_landing

    inbox = scratch_path(spark, "landing")
    hours = pool_hours(spark, sf_dir, signed=True)
    raw = to_raw(pool_hour_records(hours), F.col("protocol"), load_ts="load_ts")
    few = hours.filter("tx_count <= 2").select("dex_protocol", "pool_id", "hour_ts", "tx_count")
    raw = raw.join(few, ["dex_protocol", "pool_id", "hour_ts"], "left")
    broken = raw.withColumns({"raw": F.when(F.coalesce("tx_count", F.lit(0)) != 1, F.col("raw")),
                              "pool_id": F.when(F.coalesce("tx_count", F.lit(0)) != 2, F.col("pool_id"))}).drop("tx_count")
    write_landing(broken, inbox)
    _, rejected = enforce_required(read_raw_jsonl(spark, inbox))
    return rejected.groupBy("dex_protocol", "hour_ts").agg(
        F.count_if(F.col("raw").isNull()).alias("without_record"), F.count_if(F.col("pool_id").isNull()).alias("without_pool"))


def q_labeled_table_upsert(spark, sf_dir):
    """Labelled table written by day (S-12), then the last 7 days' scores applied in place with
    an incremental materialization (V-6 -> V-2/V-5 on touched days only)."""
    from tidemark.operators.maintenance import materialize
    from tidemark.operators.staging import lookback_days
    from tidemark.session import scratch_path
    from tidemark.sources.store import write_labeled

    path = scratch_path(spark, "labeled-table")
    write_labeled(labeled(spark, sf_dir), path)
    updates = lookback_days(scored_labeled(spark, sf_dir), AS_OF, 7)
    out = materialize(updates, "incremental", path=path)
    return round6(out.drop("hour_date"))


def _labeled_table(spark, sf_dir) -> str:
    from tidemark.session import scratch_path
    from tidemark.sources.store import write_labeled

    path = scratch_path(spark, "labeled-table")
    write_labeled(scored_labeled(spark, sf_dir), path)
    return path


def q_stored_feature_export(spark, sf_dir):
    """The last hour's export from the written labelled table: one day partition is read, nothing is computed again."""
    from tidemark.sources.store import read_labeled_since

    return round6(export_feature_values(read_labeled_since(spark, _labeled_table(spark, sf_dir), AS_OF, 1), AS_OF))


def q_stored_latest_status(spark, sf_dir):
    from tidemark.sources.store import read_labeled_since

    return round6(latest_status(read_labeled_since(spark, _labeled_table(spark, sf_dir), AS_OF, 24), AS_OF))


def q_stored_dashboard(spark, sf_dir):
    from tidemark.sources.store import read_labeled_since

    return round6(anomaly_dashboard(read_labeled_since(spark, _labeled_table(spark, sf_dir), AS_OF, 7 * 24), AS_OF))


def q_stored_timeseries(spark, sf_dir):
    from tidemark.sources.store import read_labeled_since

    return round6(anomaly_timeseries(read_labeled_since(spark, _labeled_table(spark, sf_dir), AS_OF, 30 * 24), AS_OF))


def q_last_hour_features(spark, sf_dir):
    """Features of the last hour from the written staging table: its day, a week of warm-up, and older rows of sparse series."""
    from tidemark.operators.features import recent_features
    from tidemark.operators.maintenance import write_days
    from tidemark.session import scratch_path

    path = scratch_path(spark, "staging")
    write_days(staged(spark, sf_dir).withColumn("hour_date", F.to_date("hour_ts")), path, "append")
    return round6(recent_features(spark, path, "2024-01-30 23:00:00", as_of=AS_OF, end=AS_OF))


def q_pool_features_by_time(spark, sf_dir):
    """Features with time-exact frames (D-4)."""
    return round6(pool_features(staged(spark, sf_dir), as_of=AS_OF, frame="hours"))


def q_retention_table(spark, sf_dir):
    """Retention on disk (S-14): staging and exports written by day and run, older partitions deleted twice over, the rest read."""
    from tidemark.operators.maintenance import prune_table, write_days
    from tidemark.session import scratch_path

    path, exports = scratch_path(spark, "staging"), scratch_path(spark, "exports")
    rows = staged(spark, sf_dir)
    write_days(rows.withColumn("hour_date", F.to_date("hour_ts")), path, "append")
    runs = to_feature_values(scored_labeled(spark, sf_dir)).withColumn("run_time", F.date_format("feature_timestamp", "yyyy-MM-dd'T'000000"))
    runs.hint("rebalance", "run_time").write.partitionBy("run_time").parquet(exports)
    for _ in range(2):
        prune_table(spark, path, AS_OF, 7)
        prune_table(spark, exports, AS_OF, 7, partition_col="run_time")
    kept = spark.read.parquet(exports).select(F.col("entity_id").alias("pool_id"), F.col("feature_timestamp").alias("hour_ts"), F.lit(True).alias("exported"))
    out = spark.read.parquet(path).drop("hour_date").join(kept, ["pool_id", "hour_ts"], "left")
    return round6(out.select(*rows.columns, F.coalesce("exported", F.lit(False)).alias("exported")))


def q_compacted_table(spark, sf_dir):
    """A raw table appended by six runs, compacted (S-4): rows and files by day."""
    from tidemark.operators.maintenance import compact, partitions
    from tidemark.session import scratch_path
    from tidemark.sources.raw import append_raw

    path = scratch_path(spark, "raw-table")
    raw = raw_envelope(spark, sf_dir).checkpoint()
    for run in range(6):
        append_raw(raw.filter(F.hour("hour_ts") % 6 == run), path)
    most = max(files for files, _ in partitions(spark, path).values())
    compact(spark, path, most_files=2)
    compacted = max(files for files, _ in partitions(spark, path).values()) <= max(2, most // 3)
    rows = stage_pool_hourly(spark.read.parquet(path).drop("hour_date"), as_of=AS_OF)
    return round6(rows.withColumn("few_files", F.lit(compacted)))


def q_seek_page(spark, sf_dir):
    """A page by the index of key ranges (O-4): only the ranges that hold it are read."""
    from tidemark.operators.maintenance import read_page, write_pages
    from tidemark.session import scratch_path

    path = scratch_path(spark, "pages")
    write_pages(staged(spark, sf_dir), path, rows_per_range=150)
    return round6(read_page(spark, path, first=333, skip=444))


# ---- the daily supplier series over lineitem: same operators, longer series ----------

def supplier_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-history features of every supplier-day (no lookback cut: 460+ days per series)."""
    stg = flag_negative(supplier_days(spark, sf_dir))
    return pool_features(stg, as_of=SUPPLY_AS_OF, lookback=None)


def q_supplier_day_features(spark, sf_dir):
    return round6(supplier_features(spark, sf_dir))


def q_supplier_day_labeled(spark, sf_dir):
    return round6(label(supplier_features(spark, sf_dir)))


def q_supplier_recent_features(spark, sf_dir):
    """The last 90 days of every supplier from a table written by month, with a warm-up that reaches behind them (P-7, D-5)."""
    from tidemark.operators.features import recent_features
    from tidemark.session import scratch_path

    path = scratch_path(spark, "supplier-days")
    rows = flag_negative(supplier_days(spark, sf_dir)).withColumn("month", F.trunc("hour_ts", "month"))
    rows.hint("rebalance", "month").sortWithinPartitions("month", "pool_id").write.partitionBy("month").parquet(path)
    return round6(recent_features(spark, path, SUPPLY_FROM, as_of=SUPPLY_AS_OF, partition_col="month", monthly=True))


def q_supplier_dashboard(spark, sf_dir):
    """The dashboard over 1,500 days of suppliers: more rows than it shows, so the cut at 168 binds (O-3)."""
    lab = label(supplier_features(spark, sf_dir))
    return round6(anomaly_dashboard(with_score(lab, F.abs(F.col("volume_zscore"))), SUPPLY_AS_OF, days=1500))


# ---- Isolation Forest ------------------------------------------------------------

def _model(spark, sf_dir, contamination="auto"):
    from tidemark.plans.pipeline import train_model

    return train_model(labeled(spark, sf_dir), AS_OF, contamination=contamination)


def q_iforest_scores(spark, sf_dir):
    from tidemark.operators.iforest import score

    lab = labeled(spark, sf_dir)
    return round6(score(lab, _model(spark, sf_dir)).select("pool_id", "hour_ts", "anomaly_score"))


def q_iforest_decisions(spark, sf_dir):
    from tidemark.operators.iforest import decide, predict_class, score

    lab = labeled(spark, sf_dir)
    model = _model(spark, sf_dir, contamination=0.1)
    out = predict_class(decide(score(lab.select("pool_id", "hour_ts", *FEATURES), model), threshold=3.0), model)
    return round6(out.select("pool_id", "hour_ts", "anomaly_score", "is_anomaly", "threshold", "prediction"))


def q_iforest_mean_score(spark, sf_dir):
    from tidemark.operators.iforest import mean_score, score

    return round6(mean_score(score(labeled(spark, sf_dir), _model(spark, sf_dir))))


def q_predict_pools(spark, sf_dir):
    from tidemark.operators.iforest import predict_from_features

    out = predict_from_features(_store_values(spark, sf_dir), _all_pool_ids(spark, sf_dir),
                                _model(spark, sf_dir))
    return round6(out)


def q_hourly_pipeline(spark, sf_dir):
    """The hourly job with its export written and imported again (S-7, S-8, S-9)."""
    from tidemark.plans.pipeline import hourly_pipeline
    from tidemark.session import scratch_path

    lab = labeled(spark, sf_dir)
    path = scratch_path(spark, "exports")
    res = hourly_pipeline(lab, _store_values(spark, sf_dir), _model(spark, sf_dir), AS_OF, export_path=path)
    return round6(res.predictions.select("entity_id", "feature_timestamp", "anomaly_score", "is_anomaly",
                                         "prediction"))


def q_hourly_write_back(spark, sf_dir):
    """The labelled table after the hourly job: scores of the exported pools on their newest rows (J-6)."""
    from tidemark.plans.pipeline import hourly_pipeline

    res = hourly_pipeline(labeled(spark, sf_dir), _store_values(spark, sf_dir), _model(spark, sf_dir), AS_OF)
    return round6(res.labeled)


def q_iforest_saved_model(spark, sf_dir):
    """Fitted, saved twice under other versions, an alias set back to the first, loaded by it, scored (I-11)."""
    from tidemark.operators.iforest import load_model, save_model, score, set_alias
    from tidemark.session import scratch_path

    path, lab = scratch_path(spark, "models"), labeled(spark, sf_dir)
    model = _model(spark, sf_dir)
    save_model(model, path, aliases=("latest", "production"))
    other = _model(spark, sf_dir, contamination=0.1)
    other.version = "2"
    save_model(other, path, aliases=("latest", "production"))
    set_alias(spark, path, "production", "1")
    back = load_model(spark, path, "production")
    return round6(score(lab, back).select("pool_id", "hour_ts", "anomaly_score", F.lit(back.version).alias("version")))


def q_instance_errors(spark, sf_dir):
    """Instance vectors with faults (I-7, I-8): rows of one event lack a value, of two hold a NaN, of three have no vector."""
    from tidemark.operators.iforest import score_vectors
    from tidemark.operators.lookup import feature_vector

    rows = feature_vector(labeled(spark, sf_dir))
    n = F.col("tx_count")
    bad = F.transform("features", lambda x, i: F.when(i == 4, F.lit(float("nan"))).otherwise(x))
    instance = F.when(n == 1, F.slice("features", 1, 12)).when(n == 2, bad).when(n != 3, F.col("features"))
    out = score_vectors(rows.withColumn("instance", instance), _model(spark, sf_dir, contamination=0.1), threshold=0.5)
    return round6(out.select("pool_id", "hour_ts", "anomaly_score", "is_anomaly", "threshold", "prediction", "error"))


# ---- Structured Streaming: landing drops -> stream -> table in the shared folder ----

KEYS3 = ("dex_protocol", "pool_id", "hour_ts")


def _landing_runs(spark, sf_dir, split_at: str | None = None, reload_last_day: bool = False) -> list[DataFrame]:
    """Raw envelopes cut into hourly-job runs (optionally at ``split_at``, plus a re-load of the last day)."""
    raw = raw_envelope(spark, sf_dir)
    if split_at is None:
        parts = [raw]
    else:
        cut = F.lit(split_at).cast("timestamp_ntz")
        parts = [raw.filter(F.col("hour_ts") < cut), raw.filter(F.col("hour_ts") >= cut)]
    if reload_last_day:
        again = pool_hours(spark, sf_dir, signed=False).filter(
            F.col("hour_ts") >= F.lit("2024-01-30").cast("timestamp_ntz"))
        parts.append(to_raw(pool_hour_records(again), F.col("protocol"), load_ts=AS_OF))
    return parts


def _stream_runs(spark, runs: list[DataFrame], build) -> None:
    """Replay runs as hourly jobs: land run ``i`` as JSONL drops in the watched folder, then
    trigger the same streaming query (one checkpoint) with ``availableNow``."""
    from tidemark.session import scratch_path
    from tidemark.sources.raw import write_landing
    from tidemark.streaming.streams import run_available_now

    inbox = scratch_path(spark, "inbox")
    ckpt = scratch_path(spark, "ckpt")
    for i, run in enumerate(runs):
        write_landing(run, f"{inbox}/run={i}")
        run_available_now(build(inbox, ckpt))


def q_stream_hourly_stats(spark, sf_dir):
    from tidemark.session import scratch_path
    from tidemark.streaming.streams import heartbeat, stage_stream, stream_dedup, stream_hourly_stats, stream_raw

    out = scratch_path(spark, "stream-hourly-stats")

    def build(inbox, ckpt):
        stats = stream_hourly_stats(stream_dedup(stage_stream(stream_raw(spark, inbox)), KEYS3), delay=None)
        return (stats.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
                .outputMode("append"))

    # the last drop is a heartbeat a day later: it closes every hour of the data
    _stream_runs(spark, [*_landing_runs(spark, sf_dir), heartbeat(spark, LATER)], build)
    return round6(spark.read.parquet(out))


def q_stream_dedup_latest(spark, sf_dir):
    from tidemark.session import scratch_path
    from tidemark.streaming.streams import stream_raw, upsert_latest_batch

    target = scratch_path(spark, "stream-raw-table")

    def build(inbox, ckpt):
        return (stream_raw(spark, inbox).writeStream.foreachBatch(upsert_latest_batch(target, KEYS3))
                .option("checkpointLocation", ckpt))

    _stream_runs(spark, _landing_runs(spark, sf_dir, reload_last_day=True), build)
    rows = spark.read.parquet(target).drop("hour_date")
    return round6(stage_pool_hourly(rows, as_of=AS_OF))


def q_stream_features(spark, sf_dir):
    from tidemark.session import scratch_path
    from tidemark.streaming.streams import features_batch, stage_stream, stream_raw

    target, rings = scratch_path(spark, "stream-features"), scratch_path(spark, "stream-rings")

    def build(inbox, ckpt):
        return (stage_stream(stream_raw(spark, inbox)).writeStream
                .foreachBatch(features_batch(target, as_of=AS_OF, ring_path=rings)).option("checkpointLocation", ckpt))

    _stream_runs(spark, _landing_runs(spark, sf_dir, split_at=MARK), build)
    out = spark.read.parquet(target).drop("hour_date")
    return round6(out.select(*[c for c in features(spark, sf_dir).columns]))


def q_stream_labeled(spark, sf_dir):
    """Features and labels of drops that overlap, come late and come again: the protocols apart, the later half first,
    last an older copy of one protocol with other volumes, which changes nothing."""
    from tidemark.session import scratch_path
    from tidemark.streaming.streams import features_batch, stage_stream, stream_labels, stream_raw

    target, rings, marks = (scratch_path(spark, name) for name in ("stream-features", "stream-rings", "stream-percentiles"))

    def build(inbox, ckpt):
        body = features_batch(target, as_of=AS_OF, ring_path=rings, percentile_path=marks)
        return stage_stream(stream_raw(spark, inbox)).writeStream.foreachBatch(body).option("checkpointLocation", ckpt)

    raw = raw_envelope(spark, sf_dir)
    one, late = F.col("dex_protocol") == "uniswap_v3", F.col("hour_ts") >= F.lit(MARK).cast("timestamp_ntz")
    drops = [raw.filter(one & late), raw.filter(~one), raw.filter(one).unionByName(raw.filter(one & ~late))]
    older = raw.filter(one).withColumns({"load_ts": F.col("load_ts") - F.expr("INTERVAL 1 DAY"),
                                         "raw": F.regexp_replace("raw", r'("volumeUSD":"?-?)', "$1" + "9")})
    _stream_runs(spark, [*drops, older], build)
    return round6(stream_labels(spark, target, marks))


def q_stream_alerts(spark, sf_dir):
    from tidemark.session import scratch_path
    from tidemark.streaming.streams import features_batch, stage_stream, stream_raw

    target = scratch_path(spark, "stream-features")
    alerts = scratch_path(spark, "stream-alerts")
    model = _model(spark, sf_dir, contamination=0.1)

    def build(inbox, ckpt):
        body = features_batch(target, as_of=AS_OF, model=model, alerts_path=alerts)
        return stage_stream(stream_raw(spark, inbox)).writeStream.foreachBatch(body).option(
            "checkpointLocation", ckpt)

    _stream_runs(spark, _landing_runs(spark, sf_dir, split_at=MARK), build)
    # explicit schema: a run in which no pool alerts leaves no data file to infer it from
    schema = ("dex_protocol string, pool_id string, hour_ts timestamp_ntz, anomaly_score double, "
              "threshold double, batch_id int")
    return round6(spark.read.schema(schema).parquet(alerts))


QUERIES: dict[str, Query] = {
    "stg_pool_hourly_all": q_stg_pool_hourly_all,
    "stg_pool_hourly_ohlc": q_stg_pool_hourly_ohlc,
    "pool_features": q_pool_features,
    "change_rate_ratio": q_change_rate_ratio,
    "pool_features_labeled": q_pool_features_labeled,
    "pool_p90": q_pool_p90,
    "pool_p90_approx": q_pool_p90_approx,
    "latest_status": q_latest_status,
    "anomaly_dashboard": q_anomaly_dashboard,
    "anomaly_timeseries": q_anomaly_timeseries,
    "feature_export": q_feature_export,
    "latest_features": q_latest_features,
    "feature_lookup": q_feature_lookup,
    "partial_rows_lookup": q_partial_rows_lookup,
    "incremental_features": q_incremental_features,
    "upsert_labeled": q_upsert_labeled,
    "dedup_latest": q_dedup_latest,
    "retention_prune": q_retention_prune,
    "import_stats": q_import_stats,
    "not_null_report": q_not_null_report,
    "interval_page": q_interval_page,
    "high_water_mark": q_high_water_mark,
    "predict_ids": q_predict_ids,
    "raw_json_fields": q_raw_json_fields,
    "raw_table_ingest": q_raw_table_ingest,
    "raw_rejects": q_raw_rejects,
    "labeled_table_upsert": q_labeled_table_upsert,
    "supplier_day_features": q_supplier_day_features,
    "supplier_day_labeled": q_supplier_day_labeled,
    "iforest_scores": q_iforest_scores,
    "iforest_decisions": q_iforest_decisions,
    "iforest_mean_score": q_iforest_mean_score,
    "predict_pools": q_predict_pools,
    "hourly_pipeline": q_hourly_pipeline,
    "stored_feature_export": q_stored_feature_export,
    "stored_latest_status": q_stored_latest_status,
    "stored_dashboard": q_stored_dashboard,
    "stored_timeseries": q_stored_timeseries,
    "last_hour_features": q_last_hour_features,
    "pool_features_by_time": q_pool_features_by_time,
    "retention_table": q_retention_table,
    "compacted_table": q_compacted_table,
    "seek_page": q_seek_page,
    "supplier_recent_features": q_supplier_recent_features,
    "supplier_dashboard": q_supplier_dashboard,
    "hourly_write_back": q_hourly_write_back,
    "iforest_saved_model": q_iforest_saved_model,
    "instance_errors": q_instance_errors,
    "stream_hourly_stats": q_stream_hourly_stats,
    "stream_dedup_latest": q_stream_dedup_latest,
    "stream_features": q_stream_features,
    "stream_labeled": q_stream_labeled,
    "stream_alerts": q_stream_alerts,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in oracle.SQL.items() if k in QUERIES}
