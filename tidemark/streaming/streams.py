"""Structured Streaming form of the hourly loop (T-1 ... T-5).

The reference runs hourly cron jobs; here the same work is a file stream
triggered with ``availableNow`` once per hour (or continuously).  State is
kept by Spark (watermarked aggregations, deduplication) or in the target
table itself (``foreachBatch`` upserts that are idempotent per key, so a
replayed micro-batch after an executor or driver loss changes nothing).
Checkpoints live under the cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.functions.scalar import instant_to_ntz, ts_literal
from tidemark.operators.features import LAG_ROWS, pool_features, series_window, stored_history
from tidemark.operators.labels import LABEL_P, label
from tidemark.operators.maintenance import dedup_latest, one_per_key, read_touched, table_exists, write_days, write_upsert, written
from tidemark.schemas import ISO_MICROS, LABELED, RAW_JSONL
from tidemark.sources.raw import enforce_required
from tidemark.session import scratch_path

WATERMARK = "2 hours"


def stream_raw(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Incremental scan of JSONL landing drops with the pinned raw schema (T-1).

    Keeps the instant ``event_time`` for watermarks and adds the library's
    UTC ``TIMESTAMP_NTZ`` columns.
    """
    reader = spark.readStream.schema(RAW_JSONL).option("timestampFormat", ISO_MICROS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.json(path)
    return df.select(
        "raw",
        "pool_id",
        "dex_protocol",
        instant_to_ntz("hour_ts").alias("hour_ts"),
        instant_to_ntz("load_ts").alias("load_ts"),
        F.col("hour_ts").alias("event_time"),
    )


def stream_dedup(df: DataFrame, keys: Sequence[str] = ("dex_protocol", "pool_id", "hour_ts"),
                 time_col: str = "event_time", delay: str = WATERMARK) -> DataFrame:
    """Drop re-delivered copies of a key seen within the lateness bound (T-2); the first copy wins."""
    return df.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_hourly_stats(df: DataFrame, time_col: str = "event_time", delay: str | None = WATERMARK) -> DataFrame:
    """Tumbling one-hour fleet KPIs, emitted once the watermark closes the hour (T-3).

    Two chained aggregations: one row of state per (hour, pool), then one per
    hour that counts them, so ``active_pools`` is exact and no state row grows
    with the number of pools.  Labelled rows also give ``anomaly_count`` and
    ``avg_anomaly_score``.  Pass ``delay=None`` when an upstream operator
    (``stream_dedup``) already set the watermark.  An hour that no later row
    has closed yet is held back; ``heartbeat`` closes it.
    """
    labelled = {"is_anomaly", "anomaly_score"} <= set(df.columns)
    flagged = "is_anomaly" if "is_anomaly" in df.columns else "has_negative_values"
    src = df if delay is None else df.withWatermark(time_col, delay)
    parts = {"total_volume": F.sum("volume_usd"), "total_tvl": F.sum("tvl_usd"),
             "flagged_count": F.count_if(flagged)}
    if labelled:
        parts |= {"anomaly_count": F.count_if("is_anomaly"), "score_sum": F.sum("anomaly_score"), "score_count": F.count("anomaly_score")}
    pools = src.groupBy(F.window(time_col, "1 hour").alias("w"), "pool_id").agg(*[c.alias(k) for k, c in parts.items()])
    # a row without a pool id is in the sums but is no pool
    hours = pools.groupBy(F.window("w", "1 hour").alias("h")).agg(
        F.count("pool_id").alias("active_pools"), *[F.sum(k).alias(k) for k in parts])
    more = ["anomaly_count", (F.col("score_sum") / F.nullif("score_count", F.lit(0))).alias("avg_anomaly_score")] if labelled else []
    return hours.select(instant_to_ntz(F.col("h.start")).alias("hour_ts"), "active_pools", "total_volume", "total_tvl", "flagged_count", *more)


def run_available_now(writer: DataStreamWriter, timeout: float | None = None) -> StreamingQuery:
    """Process everything available, then stop (one hourly run)."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination(timeout)
    if q.exception():
        raise q.exception()
    return q


def _with_keys(batch: DataFrame, keys: Sequence[str], batch_id: int, rejects_path: str | None) -> DataFrame:
    """The rows of a batch whose keys are all there (S-3); the others go to ``rejects_path``, as the batch's partition."""
    good, rejected = enforce_required(batch, list(keys))
    if rejects_path is not None:
        write_batch_partition(rejected.withColumn("batch_id", F.lit(batch_id)), rejects_path)
    return good


def upsert_latest_batch(path: str, keys: Sequence[str] = ("dex_protocol", "pool_id", "hour_ts"),
                        order: str = "load_ts", partition_col: str = "hour_date", rejects_path: str | None = None) -> Callable:
    """``foreachBatch`` body: newest ``order`` per key wins across all batches (V-3 on a stream).

    Only the day partitions the batch touches are read back from the table.
    Rows without a key do not enter it (S-3).
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = dedup_latest(_with_keys(batch.drop("event_time"), keys, batch_id, rejects_path), keys, order)
        if table_exists(spark, path):
            dated = rows.withColumn(partition_col, F.to_date("hour_ts"))
            cur = read_touched(spark, path, dated, partition_col).drop(partition_col).select(*rows.columns)
            # an incoming copy older than the stored one must not replace it
            stored = cur.join(rows.select(*keys), list(keys), "left_semi")
            rows = dedup_latest(rows.unionByName(stored), keys, order)
        write_upsert(path, rows, keys, partition_col=partition_col)

    return run


KEYS = ("dex_protocol", "pool_id", "hour_ts")
HISTORY_COLUMNS = ["dex_protocol", "pool_id", "hour_ts", "volume_usd", "tvl_usd", "liquidity", "tx_count"]


def _not_older(spark: SparkSession, staged: DataFrame, loads_path: str) -> DataFrame:
    """Rows of a batch, one per key, without those older than the copy of their key that was taken before."""
    if not table_exists(spark, loads_path):
        return staged
    taken = read_touched(spark, loads_path, staged.withColumn("hour_date", F.to_date("hour_ts")))
    taken = taken.select(*KEYS, F.col("load_ts").alias("_taken"))
    older = F.col("_taken").isNotNull() & (F.col("load_ts").isNull() | (F.col("load_ts") < F.col("_taken")))
    return staged.join(taken, list(KEYS), "left").filter(~older).select(*staged.columns)


#: Hash partitions of the ring table: a batch rewrites those of its series.
RING_BUCKETS = 64


def _ring_rows(ring: DataFrame) -> DataFrame:
    return ring.select(F.explode("rows").alias("r")).select("r.*")


def _write_ring(path: str, rows: DataFrame) -> None:
    """Keep the last ``LAG_ROWS`` accepted rows of each series of ``rows``, one table row a series."""
    rn = F.row_number().over(series_window(descending=True))
    last = rows.filter(~F.col("has_negative_values")).withColumn("_rn", rn).filter(F.col("_rn") <= LAG_ROWS)
    row = F.struct("hour_ts", "dex_protocol", *[c for c in HISTORY_COLUMNS if c not in ("hour_ts", "dex_protocol")])
    rings = last.groupBy("pool_id").agg(F.sort_array(F.collect_list(row)).alias("rows"), F.max("hour_ts").alias("last_hour"))
    write_upsert(path, rings.select("pool_id", "rows", "last_hour", _bucket()), ("pool_id",), partition_col="bucket")


def _warm_up(spark: SparkSession, staged: DataFrame, since: DataFrame, target_path: str, ring_path: str | None) -> DataFrame | None:
    """The stored rows that the features of a batch need: rings of the series whose rows all come after those stored,
    the table's history for the others."""
    if not table_exists(spark, target_path):
        return None
    lit = F.lit(False).alias("has_negative_values")
    if ring_path is None or not table_exists(spark, ring_path):
        return stored_history(spark, target_path, since).select(*HISTORY_COLUMNS, lit)
    rings = read_touched(spark, ring_path, since.select("*", _bucket()), "bucket")
    rings = rings.join(since, "pool_id")
    later = rings.filter(F.col("since") > F.col("last_hour"))
    rows = _ring_rows(later).select(*HISTORY_COLUMNS, lit)
    # a series without a ring may have rows all the same (all of them rejected since, or a table older than its rings)
    late = since.join(later.select("pool_id"), "pool_id", "left_anti")
    if late.isEmpty():
        return rows
    return rows.unionByName(stored_history(spark, target_path, late).select(*HISTORY_COLUMNS, lit))


def _bucket(col: str = "pool_id") -> Column:
    return F.pmod(F.xxhash64(col), F.lit(RING_BUCKETS)).cast("int").alias("bucket")


def _save_changes(spark: SparkSession, staged: DataFrame, target_path: str, path: str) -> None:
    """How often each volume of a series comes (+) and goes (-) by this batch, against the table as it is before it.

    Written once, before the table changes: a replayed batch takes the file it
    wrote, so that it adds nothing twice.
    """
    if written(spark, path):
        return
    one = lambda n: (F.col("pool_id"), F.col("volume_usd"), F.lit(n).cast("bigint").alias("n"))
    moved = staged.filter(~F.col("has_negative_values")).select(*one(1))
    if table_exists(spark, target_path):
        before = read_touched(spark, target_path, staged.withColumn("hour_date", F.to_date("hour_ts")))
        moved = moved.unionByName(before.join(staged.select(*KEYS), list(KEYS), "left_semi").select(*one(-1)))
    moved = moved.filter(F.col("volume_usd").isNotNull()).groupBy("pool_id", "volume_usd").agg(F.sum("n").alias("n")).filter("n <> 0")
    moved.write.mode("overwrite").parquet(path)


def _apply_changes(spark: SparkSession, path: str, root: str, batch_id: int, p: float) -> None:
    """Add a batch's changes to the value counts of its series, and set their percentiles anew.

    The counts lie in hash partitions that say which batch they hold last, so
    a replay passes over those that have it already.  A value that is gone
    keeps a row of count 0.
    """
    schema = "pool_id string, volume_usd double, n bigint"
    moved = spark.read.schema(schema).parquet(path).select("*", _bucket())
    values, marks = f"{root}/values", f"{root}/percentiles"
    stage = scratch_path(spark, "percentiles")
    if table_exists(spark, values):
        now = read_touched(spark, values, moved, "bucket")
        done = now.filter(F.col("batch_id") == batch_id).select("bucket").distinct()
        moved_on = moved.join(done, "bucket", "left_anti").unionByName(now.join(done, "bucket", "left_anti").select(*moved.columns))
    else:
        moved_on = moved
    summed = moved_on.groupBy("bucket", "pool_id", "volume_usd").agg(F.sum("n").alias("n")).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    summed.write.parquet(stage)
    write_days(spark.read.schema(summed.schema).parquet(stage), values, "overwrite" if table_exists(spark, values) else "append", "bucket")
    if not table_exists(spark, values):
        return
    held = read_touched(spark, values, moved, "bucket").filter("n > 0")
    new = held.groupBy("bucket", "pool_id").agg(F.percentile("volume_usd", F.lit(p), F.col("n")).alias("pct_90"))
    write_days(new, marks, "overwrite" if table_exists(spark, marks) else "append", "bucket")


def stream_labels(spark: SparkSession, target_path: str, percentile_path: str) -> DataFrame:
    """Labelled features of a stream (M-3, A-7, J-1): the stored features against their series' stored percentile.

    A new row can move its series' percentile and with it the labels of all
    its rows; the percentile alone is stored, so no batch writes labels again.
    """
    marks = spark.read.schema("pool_id string, pct_90 double, bucket int").parquet(f"{percentile_path}/percentiles").select("pool_id", "pct_90")
    rows = spark.read.parquet(target_path).drop("hour_date").join(marks, "pool_id", "left")
    flag = F.coalesce(F.col("volume_usd") >= F.col("pct_90"), F.lit(False))
    return rows.select("*", flag.alias("is_anomaly"), F.lit(None).cast("double").alias("anomaly_score")).select(*LABELED.fieldNames())


def features_batch(target_path: str, as_of: Column | str | None = None, model=None,
                   alerts_path: str | None = None, threshold: float | None = None,
                   labeled_path: str | None = None, relabel: bool = True, rejects_path: str | None = None,
                   ring_path: str | None = None, percentile_path: str | None = None, p: float = LABEL_P) -> Callable:
    """``foreachBatch`` body for hourly features (T-4), labels and alerts (T-5).

    Rows may come late, twice, or for some series only.  Of a key given more
    than once, in the batch or in batches before, the newest ``load_ts`` counts
    (of equal ones in two batches the later batch's): a key that is stored
    already is replaced (or removed, if its new row fails the quality filter)
    unless its new row is older than the one taken before.  The load times of
    all keys taken, removed ones too, are kept in a table beside the target
    (``<target_path>-loads``); without ``load_ts`` the later batch counts.  Each touched series is computed anew from its earliest touched
    hour, with the stored rows before it as warm-up, and upserted by key; so
    the table holds what one run over all rows would give, whatever the order
    and the cut of the drops.

    With ``labeled_path`` the labelled table is kept as well: a new row can
    move its series' percentile, so all rows of the touched series are labelled
    again, or, with ``relabel=False``, only the rows computed in this batch.
    Rows without a key are rejected (S-3), to ``rejects_path`` if it is given.
    With ``ring_path`` the last 24 rows of every series are kept as one row of
    a state table: a batch whose rows come after those stored reads its series'
    rings and no history; series with late rows are read from the table.  A
    replayed batch finds its own rows in the ring and takes the second way.
    With ``percentile_path`` each series' values are counted in a state table
    and its percentile kept beside it; ``stream_labels`` reads the labels.
    With a model, every pool whose newest written row is anomalous gets an
    alert row (the dashboard's ``needs_alert`` rule, T-5).
    """
    loads_path = f"{target_path.rstrip('/')}-loads"

    def run(batch: DataFrame, batch_id: int) -> None:
        reprocess(_with_keys(batch.drop("event_time"), KEYS, batch_id, rejects_path), batch_id)

    def reprocess(staged: DataFrame, batch_id: int) -> None:
        spark = staged.sparkSession
        kept = scratch_path(spark, "stream-batch")
        staged = one_per_key(staged, KEYS)
        staged.write.parquet(kept)  # read several times below; never held in executor memory
        staged = spark.read.schema(staged.schema).parquet(kept)
        if "load_ts" in staged.columns:
            _not_older(spark, staged, loads_path).write.parquet(f"{kept}-current")
            staged = spark.read.schema(staged.schema).parquet(f"{kept}-current")
            # a batch replayed after a failure finds its own load times, which are not newer than its rows
            write_upsert(loads_path, staged.select(*KEYS, "load_ts"), KEYS)
        since = staged.groupBy("pool_id").agg(F.min("hour_ts").alias("since"))
        rows = staged.select(*HISTORY_COLUMNS, "has_negative_values")
        history = _warm_up(spark, staged, since, target_path, ring_path)
        if history is not None:
            rows = rows.unionByName(history.join(staged.select(*KEYS), list(KEYS), "left_anti"))
        if ring_path is not None:
            rows.write.parquet(f"{kept}-rows")  # read for the features and for the new rings
            rows = spark.read.schema(rows.schema).parquet(f"{kept}-rows")
        feats = pool_features(rows, as_of=as_of, lookback=None).join(since, "pool_id").filter("hour_ts >= since").drop("since")
        feats = feats.select(*pool_features(rows, as_of=as_of, lookback=None).columns)
        gone = staged.filter("has_negative_values").select(*KEYS)
        if percentile_path is not None:
            changes = f"{percentile_path}/changes/batch={batch_id}"
            _save_changes(spark, staged, target_path, changes)
        if not table_exists(spark, target_path) and feats.isEmpty():
            return
        write_upsert(target_path, feats, KEYS, deletes=gone)
        if ring_path is not None:
            _write_ring(ring_path, rows)
        if percentile_path is not None:
            _apply_changes(spark, changes, percentile_path, batch_id, p)
        touched = since.select("pool_id")
        if labeled_path is not None:
            series = spark.read.parquet(target_path).drop("hour_date") if table_exists(spark, target_path) else feats.limit(0)
            series = series.join(touched, "pool_id", "left_semi")
            marks = label(series)
            if not relabel:
                marks = marks.join(since, "pool_id").filter("hour_ts >= since").drop("since")
            write_upsert(labeled_path, marks, KEYS, deletes=gone)
        if model is not None and alerts_path is not None and table_exists(spark, target_path):
            from tidemark.operators.iforest import decide, score

            thr = model.offset if threshold is None else threshold
            # read back what was written for this batch: its days, then its keys
            dated = staged.withColumn("hour_date", F.to_date("hour_ts"))
            written = read_touched(spark, target_path, dated).drop("hour_date").join(
                staged.select(*KEYS), list(KEYS), "left_semi")
            # an alert is raised when a pool's newest row is anomalous (a catch-up batch
            # holding many hours of a pool alerts at most once for it)
            newest = F.row_number().over(series_window(descending=True))
            latest = written.withColumn("_rn", newest).filter(F.col("_rn") == 1).drop("_rn")
            alerts = decide(score(latest, model), thr).filter(F.col("is_anomaly"))
            out = alerts.select("dex_protocol", "pool_id", "hour_ts", "anomaly_score", "threshold")
            write_batch_partition(out.withColumn("batch_id", F.lit(batch_id)), alerts_path)

    return run


def heartbeat(spark: SparkSession, hour: str) -> DataFrame:
    """A raw envelope of no pool at a later hour: landed last, it moves the watermark past all hours before it.

    Its own hour stays open and is never emitted.
    """
    return spark.range(1).select(
        F.lit("{}").alias("raw"), F.lit("-").alias("pool_id"), F.lit("uniswap_v3").alias("dex_protocol"),
        ts_literal(hour).alias("hour_ts"), ts_literal(hour).alias("load_ts"))


def write_batch_partition(df: DataFrame, path: str, col: str = "batch_id") -> None:
    """Write a micro-batch's rows as its own ``batch_id`` partition, replacing it if present.

    A micro-batch replayed after a failure rewrites the same partition instead
    of appending a second copy, so the sink is idempotent per batch.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(col).parquet(path)


def stage_stream(raw_stream: DataFrame) -> DataFrame:
    """Typed staging of a raw stream (M-1 on a stream) with an instant ``event_time`` for watermarks."""
    from tidemark.functions.scalar import ntz_to_instant
    from tidemark.operators.staging import stage_pool_hourly

    staged = stage_pool_hourly(raw_stream, as_of=None, lookback=None)
    return staged.withColumn("event_time", ntz_to_instant("hour_ts"))
