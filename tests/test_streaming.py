import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF001
from tidemark.operators.staging import stage_pool_hourly
from tidemark.plans.registry import KEYS3, raw_envelope, round6
from tidemark.sources.raw import write_landing
from tidemark.streaming import (
    run_available_now,
    stage_stream,
    stream_dedup,
    stream_hourly_stats,
    stream_raw,
    upsert_latest_batch,
)


def test_stream_equals_batch_on_closed_windows(spark, tmp_shared):
    raw = raw_envelope(spark, SF001)
    write_landing(raw, f"{tmp_shared}/in")
    out = f"{tmp_shared}/out"
    stats = stream_hourly_stats(stage_stream(stream_raw(spark, f"{tmp_shared}/in")))
    run_available_now(stats.writeStream.format("parquet").option("path", out)
                      .option("checkpointLocation", f"{tmp_shared}/ckpt").outputMode("append"))
    got = {r.hour_ts: r for r in round6(spark.read.parquet(out)).collect()}
    batch = stage_pool_hourly(raw).groupBy("hour_ts").agg(F.count(F.lit(1)).alias("n"),
                                                         F.sum("volume_usd").alias("v"))
    last = batch.agg(F.max("hour_ts")).first()[0]
    closed = {r.hour_ts: r for r in round6(batch).collect() if r.hour_ts <= last - dt.timedelta(hours=3)}
    assert set(got) == set(closed)
    for h, r in closed.items():
        assert got[h].active_pools == r.n and got[h].total_volume == r.v


def test_stream_dedup_drops_redelivered_copies(spark, tmp_shared):
    raw = raw_envelope(spark, SF001)
    write_landing(raw, f"{tmp_shared}/in/run=0")
    write_landing(raw, f"{tmp_shared}/in/run=1")  # the same hour delivered twice
    dedup = stream_dedup(stream_raw(spark, f"{tmp_shared}/in"), KEYS3)
    run_available_now(dedup.writeStream.format("parquet").option("path", f"{tmp_shared}/out")
                      .option("checkpointLocation", f"{tmp_shared}/ckpt"))
    assert spark.read.parquet(f"{tmp_shared}/out").count() == raw.count()


def test_upsert_latest_replay_is_idempotent(spark, tmp_shared):
    raw = raw_envelope(spark, SF001)
    write_landing(raw, f"{tmp_shared}/in")
    target = f"{tmp_shared}/table"
    body = upsert_latest_batch(target, KEYS3)
    batch = stream_raw(spark, f"{tmp_shared}/in")
    run_available_now(batch.writeStream.foreachBatch(body).option("checkpointLocation", f"{tmp_shared}/ckpt"))
    first = spark.read.parquet(target).count()
    # replaying a micro-batch (as after a failure) changes nothing
    body(spark.read.parquet(target).drop("hour_date"), 99)
    assert spark.read.parquet(target).count() == first == raw.count()


def test_features_and_alerts_replay_is_idempotent(spark, tmp_shared):
    from tidemark.operators.features import pool_features
    from tidemark.operators.iforest import fit_iforest
    from tidemark.streaming.streams import features_batch

    staged = stage_pool_hourly(raw_envelope(spark, SF001))
    model = fit_iforest(pool_features(staged, lookback=None), n_trees=10, key_cols=["pool_id", "hour_ts"],
                        contamination=0.1)
    # threshold 0: every pool's newest row alerts, once per pool however many hours the batch holds
    body = features_batch(f"{tmp_shared}/features", model=model, alerts_path=f"{tmp_shared}/alerts",
                          threshold=0.0)
    body(staged, 0)
    feats = spark.read.parquet(f"{tmp_shared}/features").count()
    alerts = spark.read.parquet(f"{tmp_shared}/alerts").count()
    assert alerts == staged.select("pool_id").distinct().count()
    body(staged, 0)  # the same micro-batch again, as after a driver failure
    assert spark.read.parquet(f"{tmp_shared}/features").count() == feats
    assert spark.read.parquet(f"{tmp_shared}/alerts").count() == alerts


def test_late_split_and_repeated_drops_give_the_batch_result(spark, tmp_shared):
    """Drops of one protocol after the other, the later hours first, rows twice: nothing is lost or doubled."""
    from tidemark.operators.features import pool_features
    from tidemark.operators.labels import label
    from tidemark.streaming.streams import features_batch

    staged = stage_pool_hourly(raw_envelope(spark, SF001))
    one, late = F.col("dex_protocol") == "uniswap_v3", F.col("hour_ts") >= F.lit("2024-01-20").cast("timestamp_ntz")
    body = features_batch(f"{tmp_shared}/features", labeled_path=f"{tmp_shared}/labels")
    for i, part in enumerate([staged.filter(one & late), staged.filter(~one), staged.filter(one).unionByName(staged.filter(one))]):
        body(part, i)
    want = label(pool_features(staged, lookback=None))
    got = spark.read.parquet(f"{tmp_shared}/labels").select(*want.columns)
    assert got.count() == want.count()
    assert round6(got).exceptAll(round6(want)).count() == 0
    assert spark.read.parquet(f"{tmp_shared}/features").count() == want.count()


def test_a_row_that_turns_negative_leaves_the_table(spark, tmp_shared):
    from tidemark.streaming.streams import features_batch

    staged = stage_pool_hourly(raw_envelope(spark, SF001)).filter("pool_id = 'pool_1'")
    body = features_batch(f"{tmp_shared}/features")
    body(staged, 0)
    n = spark.read.parquet(f"{tmp_shared}/features").count()
    # a row of a day with others (a day that loses its only row keeps its file: the writer has no rows to replace it with)
    day = staged.filter("NOT has_negative_values").groupBy(F.to_date("hour_ts").alias("d")).count().orderBy(F.desc("count"), "d").first()["d"]
    last = staged.filter("NOT has_negative_values").filter(F.to_date("hour_ts") == F.lit(day)).orderBy("hour_ts").limit(1)
    body(last.withColumns({"volume_usd": F.lit(-1.0), "has_negative_values": F.lit(True)}), 1)
    assert spark.read.parquet(f"{tmp_shared}/features").count() == n - 1


def test_an_older_copy_that_comes_again_changes_nothing(spark, tmp_shared):
    """Older copies with other values, also of a key whose newest row was removed, leave features and labels alone."""
    from tidemark.operators.features import pool_features
    from tidemark.operators.labels import label
    from tidemark.streaming.streams import features_batch

    staged = stage_pool_hourly(raw_envelope(spark, SF001)).filter("pool_id IN ('pool_1', 'pool_2')")
    body = features_batch(f"{tmp_shared}/features", labeled_path=f"{tmp_shared}/labels")
    body(staged, 0)
    older = F.col("load_ts") - F.expr("INTERVAL 1 DAY")
    body(staged.withColumns({"load_ts": older, "volume_usd": F.col("volume_usd") * 3 + 1, "has_negative_values": F.lit(False)}), 1)
    want = label(pool_features(staged, lookback=None))
    assert staged.filter("has_negative_values").count() > 0
    got = spark.read.parquet(f"{tmp_shared}/labels").select(*want.columns)
    assert got.count() == want.count() and round6(got).exceptAll(round6(want)).count() == 0


def test_a_day_that_loses_its_only_row_goes(spark, tmp_shared):
    from tidemark.streaming.streams import features_batch

    good = stage_pool_hourly(raw_envelope(spark, SF001)).filter("pool_id = 'pool_1' AND NOT has_negative_values")
    two = good.groupBy(F.to_date("hour_ts")).agg(F.min("hour_ts").alias("hour_ts")).orderBy("hour_ts").limit(2).select("hour_ts")
    rows = good.join(two, "hour_ts").select(*good.columns)
    bad = lambda df: df.withColumns({"volume_usd": F.lit(-1.0), "has_negative_values": F.lit(True)})
    body = features_batch(f"{tmp_shared}/features", labeled_path=f"{tmp_shared}/labels")
    body(rows, 0)
    assert spark.read.parquet(f"{tmp_shared}/features").count() == spark.read.parquet(f"{tmp_shared}/labels").count() == 2
    body(bad(rows.orderBy("hour_ts").limit(1)), 1)
    assert spark.read.parquet(f"{tmp_shared}/features").count() == spark.read.parquet(f"{tmp_shared}/labels").count() == 1
    body(bad(rows), 2)  # the last rows go; the tables are empty and can be filled again
    body(rows.withColumn("load_ts", F.col("load_ts") + F.expr("INTERVAL 1 DAY")), 3)
    assert spark.read.parquet(f"{tmp_shared}/features").count() == spark.read.parquet(f"{tmp_shared}/labels").count() == 2


def test_hours_are_closed_by_the_heartbeat(spark, tmp_shared):
    from tidemark.streaming.streams import heartbeat

    raw = raw_envelope(spark, SF001)
    stats = lambda: stream_hourly_stats(stage_stream(stream_raw(spark, f"{tmp_shared}/in"))).writeStream.format("parquet").option(
        "path", f"{tmp_shared}/out").option("checkpointLocation", f"{tmp_shared}/ckpt").outputMode("append")
    write_landing(raw, f"{tmp_shared}/in/run=0")
    run_available_now(stats())
    write_landing(heartbeat(spark, "2024-03-01 00:00:00"), f"{tmp_shared}/in/run=1")
    run_available_now(stats())
    assert spark.read.parquet(f"{tmp_shared}/out").count() == raw.select("hour_ts").distinct().count()
