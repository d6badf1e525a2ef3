import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF001
from tidemark.operators.staging import stage_pool_hourly
from tidemark.plans.registry import raw_envelope, round6, staged
from tidemark.sources.raw import append_raw, enforce_required, read_raw_jsonl, to_raw, write_landing
from tidemark.sources.tables import pool_hour_records, pool_hours


def _sorted(df):
    return sorted(df.collect(), key=lambda r: (r.pool_id, r.hour_ts))


def test_json_round_trip_equals_direct_path(spark):
    via_json = stage_pool_hourly(raw_envelope(spark, SF001))
    direct = staged(spark, SF001)
    assert _sorted(round6(via_json)) == _sorted(round6(direct))


def test_field_map_resolves_both_protocol_layouts(spark):
    raw = raw_envelope(spark, SF001)
    sushi = raw.filter(F.col("dex_protocol") == "sushiswap_v3").first().raw
    uni = raw.filter(F.col("dex_protocol") == "uniswap_v3").first().raw
    assert "totalValueLockedUSD" in sushi and "hourlyTxns" in sushi and "tvlUSD" not in sushi
    assert "tvlUSD" in uni and "txCount" in uni
    staged_rows = stage_pool_hourly(raw)
    assert staged_rows.filter(F.col("tvl_usd").isNull() | F.col("tx_count").isNull()).count() == 0


def test_landing_jsonl_round_trip(spark, tmp_shared):
    raw = raw_envelope(spark, SF001)
    write_landing(raw, f"{tmp_shared}/landing")
    back = read_raw_jsonl(spark, f"{tmp_shared}/landing")
    assert back.count() == raw.count()
    assert _sorted(round6(stage_pool_hourly(back))) == _sorted(round6(stage_pool_hourly(raw)))


def test_unknown_fields_ignored_and_required(spark, tmp_shared):
    path = f"{tmp_shared}/drop.jsonl"
    lines = [
        '{"raw": {"pool": {"id": "p"}}, "pool_id": "p", "dex_protocol": "uniswap_v3", '
        '"hour_ts": "2025-05-20T09:00:00Z", "load_ts": "2025-05-20T09:05:00Z", "extra": 1}',
        '{"raw": {"pool": {"id": "q"}}, "dex_protocol": "uniswap_v3", '
        '"hour_ts": "2025-05-20T09:00:00Z", "load_ts": "2025-05-20T09:05:00Z"}',
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    df = read_raw_jsonl(spark, path)
    assert "extra" not in df.columns
    good, bad = enforce_required(df)
    assert good.count() == 1 and bad.count() == 1
    row = good.first()
    assert row.hour_ts == dt.datetime(2025, 5, 20, 9) and row.raw.startswith("{")


def test_to_raw_envelope(spark):
    recs = pool_hour_records(pool_hours(spark, SF001).limit(3))
    env = to_raw(recs, "uniswap", load_ts="2024-01-31 00:00:00")
    r = env.first()
    assert r.dex_protocol == "uniswap_v3" and r.load_ts == dt.datetime(2024, 1, 31)
    assert r.hour_ts.minute == 0


def test_append_raw_layout(spark, tmp_shared):
    raw = raw_envelope(spark, SF001)
    append_raw(raw, f"{tmp_shared}/raw", files_per_day=2)
    back = spark.read.parquet(f"{tmp_shared}/raw")
    assert back.count() == raw.count()
    pruned = back.filter(F.col("hour_date") == dt.date(2024, 1, 5))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour_date" in plan


def test_ohlc_variant(spark):
    raw = to_raw(pool_hour_records(pool_hours(spark, SF001, ohlc=True)), F.col("protocol"), load_ts="load_ts")
    out = stage_pool_hourly(raw, ohlc=True)
    assert {"token0_id", "token1_id", "open", "high", "low", "close"} <= set(out.columns)
    assert out.filter(F.col("high") < F.col("low")).count() == 0


def test_append_raw_splits_a_hot_day_over_write_tasks(spark, tmp_shared):
    import glob

    from tests.conftest import SF01

    raw = raw_envelope(spark, SF01)
    # one day holding most of the rows: every envelope copied 20 times onto 2024-01-05,
    # produced by several map tasks (a rebalance splits a partition along map outputs)
    hot = raw.withColumn("hour_ts", F.lit("2024-01-05 03:00:00").cast("timestamp_ntz")).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("copy").repartition(8)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    prev = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        append_raw(hot.unionByName(raw), tmp_shared)
    finally:
        spark.conf.set(key, prev)
    hot_files = glob.glob(f"{tmp_shared}/hour_date=2024-01-05/part-*")
    assert len(hot_files) > 1
    assert spark.read.parquet(tmp_shared).count() == hot.count() + raw.count()


def test_landing_drops_are_compressed(spark, tmp_shared):
    from tests.conftest import SF001
    from tidemark.operators.maintenance import _hadoop
    from tidemark.plans.registry import raw_envelope
    from tidemark.sources.raw import read_raw_jsonl, write_landing

    raw = raw_envelope(spark, SF001)
    write_landing(raw, tmp_shared)
    system, folder = _hadoop(spark, tmp_shared)
    text = spark.read.text(tmp_shared).selectExpr("sum(octet_length(value) + 1)").first()[0]
    assert system.getContentSummary(folder).getLength() < text / 3
    back = read_raw_jsonl(spark, tmp_shared)
    assert back.count() == raw.count() and back.select("raw", "load_ts").exceptAll(raw.select("raw", "load_ts")).count() == 0
