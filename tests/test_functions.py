import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import (
    day_of_week,
    hour_floor,
    iso_utc,
    json_float,
    json_int,
    json_str,
    json_ts,
    mask_id,
    negative_flag,
    parse_iso_utc,
    safe_div,
)


def test_safe_div_null_on_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    got = [r[0] for r in df.select(safe_div("a", "b")).collect()]
    assert got == [None, None, 1.5]


def test_negative_flag_null_is_false(spark):
    df = spark.createDataFrame([(-1.0, 5.0), (5.0, -1.0), (None, None), (1.0, 1.0)], "v double, t double")
    assert [r[0] for r in df.select(negative_flag("v", "t")).collect()] == [True, True, False, False]


def test_json_helpers_bad_missing_nested(spark):
    doc = '{"volumeUSD": "12x", "pool": {"id": "p1", "token0": {"id": "t0"}}, "txCount": "7", "periodStartUnix": 3600}'
    df = spark.createDataFrame([(doc,)], "raw string")
    row = df.select(
        json_float("raw", "volumeUSD").alias("bad"),
        json_float("raw", "tvlUSD").alias("missing"),
        json_str("raw", "pool:token0:id").alias("nested"),
        json_int("raw", "txCount").alias("tx"),
        json_ts("raw", "periodStartUnix").alias("ts"),
    ).first()
    assert row.bad is None and row.missing is None
    assert row.nested == "t0" and row.tx == 7
    assert row.ts == dt.datetime(1970, 1, 1, 1, 0)


def test_time_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 16, 42, 5, 123),)], "ts timestamp_ntz")
    row = df.select(hour_floor("ts").alias("h"), day_of_week("ts").alias("d"), iso_utc(hour_floor("ts")).alias("iso"))
    row = row.first()
    assert row.h == dt.datetime(2024, 1, 7, 16) and row.d == 1  # 2024-01-07 is a Sunday
    assert row.iso == "2024-01-07T16:00:00Z"
    back = spark.createDataFrame([(row.iso,)], "s string").select(parse_iso_utc("s").alias("t")).first().t
    assert back == dt.datetime(2024, 1, 7, 16)


def test_mask_id(spark):
    df = spark.createDataFrame([("0xabcdef123",)], "id string")
    assert df.select(mask_id("id")).first()[0] == "0xabcd..."


def test_time_helpers_zone_independent(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),)], "ts timestamp_ntz")
        assert df.select(hour_floor("ts")).first()[0] == dt.datetime(2024, 3, 10, 2)
        assert df.select(F.lit(1)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
