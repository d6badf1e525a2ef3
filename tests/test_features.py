import math

from pyspark.sql import functions as F

from tests.frames import series, staged_rows
from tidemark.operators.features import incremental_features, pool_features
from tidemark.operators.staging import flag_negative

from tests.conftest import hours


def _rows(df):
    return [r.asDict() for r in df.orderBy("pool_id", "hour_ts").collect()]


def test_one_pool_30h_lag_and_frames(spark):
    vols = [float(i + 1) for i in range(30)]
    out = _rows(pool_features(series(spark, "p", "2024-01-01 00:00:00", vols)))
    assert len(out) == 30
    assert all(r["vol_rate_24h"] is None for r in out[:24])
    for i in range(24, 30):
        assert math.isclose(out[i]["vol_rate_24h"], (vols[i] - vols[i - 24]) / vols[i - 24])
    assert math.isclose(out[9]["vol_ma_6h"], sum(vols[4:10]) / 6)
    assert math.isclose(out[29]["vol_ma_24h"], sum(vols[6:30]) / 24)
    assert out[0]["vol_std_24h"] is None and out[0]["volume_zscore"] is None
    assert out[0]["hour_of_day"] == 0 and out[0]["day_of_week"] == 2  # 2024-01-01 is a Monday


def test_gap_pool_lag_counts_rows_not_hours(spark):
    steps = list(range(10)) + list(range(20, 40))  # a 10-hour hole after row 10
    vols = [float(i + 1) for i in range(30)]
    out = _rows(pool_features(series(spark, "p", "2024-01-01 00:00:00", vols, step_hours=steps)))
    assert out[24]["vol_rate_24h"] is not None
    assert math.isclose(out[24]["vol_rate_24h"], (vols[24] - vols[0]) / vols[0])


def test_single_row_and_constant_pool(spark):
    one = _rows(pool_features(series(spark, "a", "2024-01-01 00:00:00", [5.0])))
    assert one[0]["vol_std_24h"] is None and one[0]["volume_zscore"] is None
    const = _rows(pool_features(series(spark, "b", "2024-01-01 00:00:00", [7.0] * 24)))
    assert const[-1]["vol_std_24h"] == 0.0 and const[-1]["volume_zscore"] is None


def test_zero_tvl_and_zero_lag(spark):
    vols = [0.0] + [1.0] * 24
    tvl = [0.0] * 25
    out = _rows(pool_features(series(spark, "z", "2024-01-01 00:00:00", vols, tvl=tvl)))
    assert out[24]["vol_rate_24h"] is None  # lagged volume 0
    assert out[24]["vol_tvl_ratio"] is None and out[24]["tvl_rate_24h"] is None


def test_negatives_flag_and_filter(spark):
    h = hours("2024-01-01 00:00:00", 3)
    df = staged_rows(spark, [("uniswap_v3", "n", h[0], -1.0, 1.0, 1.0, 1),
                             ("uniswap_v3", "n", h[1], 1.0, -1.0, 1.0, 1),
                             ("uniswap_v3", "n", h[2], None, None, 1.0, 1)])
    flags = [r.has_negative_values for r in flag_negative(df.drop("has_negative_values")).orderBy("hour_ts").collect()]
    assert flags == [True, True, False]
    assert pool_features(df).count() == 1


def test_two_protocols_one_pool_partition_choice(spark):
    a = series(spark, "same", "2024-01-01 00:00:00", [1.0] * 25, protocol="uniswap_v3")
    b = series(spark, "same", "2024-01-01 00:30:00", [2.0] * 25, protocol="sushiswap_v3")
    by_pool = pool_features(a.unionByName(b))
    by_both = pool_features(a.unionByName(b), partition_by=("dex_protocol", "pool_id"))
    # sharing one series shifts the lag: rows of both protocols interleave
    assert by_pool.filter(F.col("vol_rate_24h").isNotNull()).count() == 26
    assert by_both.filter(F.col("vol_rate_24h").isNotNull()).count() == 2


def test_incremental_equals_full(spark):
    import random

    rnd = random.Random(7)
    frames = []
    for p in range(4):
        steps = sorted(rnd.sample(range(80), 60))
        vols = [rnd.uniform(-5, 100) for _ in steps]
        frames.append(series(spark, f"p{p}", "2024-01-01 00:00:00", vols, step_hours=steps))
    stg = frames[0]
    for f in frames[1:]:
        stg = stg.unionByName(f)
    stg = flag_negative(stg.drop("has_negative_values")).select(*stg.columns)
    full = pool_features(stg)
    for cut in ["2024-01-02 00:00:00", "2024-01-03 05:00:00"]:
        target = pool_features(stg.filter(F.col("hour_ts") < F.lit(cut).cast("timestamp_ntz")))
        inc = incremental_features(stg, target)
        got = sorted(_rows(target.unionByName(inc)), key=lambda r: (r["pool_id"], r["hour_ts"]))
        exp = sorted(_rows(full), key=lambda r: (r["pool_id"], r["hour_ts"]))
        assert len(got) == len(exp)
        for g, e in zip(got, exp):
            for k, v in e.items():
                if isinstance(v, float):
                    assert math.isclose(g[k], v, rel_tol=1e-9, abs_tol=1e-9), (k, g, e)
                else:
                    assert g[k] == v


def test_late_row_skipped_by_incremental(spark):
    base = series(spark, "p", "2024-01-01 00:00:00", [1.0] * 30)
    target = pool_features(base)
    late = series(spark, "p", "2024-01-01 03:30:00", [9.0])
    assert incremental_features(base.unionByName(late), target).count() == 0


def test_stored_history_equals_full_warmup(spark, tmp_shared):
    """Bounded warm-up read = last 24 rows per pool over the whole table, for dense and gappy pools."""
    import datetime as dt

    from pyspark.sql import Window

    from tidemark.operators.features import stored_history

    dense = series(spark, "dense", "2024-01-01 00:00:00", [float(i) for i in range(400)])
    # 30 rows, one every 12 hours: only 14 of them in the last 7 days
    gappy = series(spark, "gappy", "2024-01-03 00:00:00", [float(i) for i in range(30)], step_hours=12)
    sparse = series(spark, "sparse", "2024-01-01 00:00:00", [1.0, 2.0, 3.0], step_hours=100)
    feats = pool_features(dense.unionByName(gappy).unionByName(sparse), lookback=None)
    feats.withColumn("hour_date", F.to_date("hour_ts")).write.partitionBy("hour_date").parquet(tmp_shared)
    at = dt.datetime(2024, 1, 18)
    since = spark.createDataFrame([(p, at) for p in ("dense", "gappy", "sparse", "new")], "pool_id string, since timestamp_ntz")
    got = stored_history(spark, tmp_shared, since)
    w = Window.partitionBy("pool_id").orderBy(F.col("hour_ts").desc())

    def last24(df):
        return sorted((r.pool_id, r.hour_ts) for r in
                      df.withColumn("rn", F.row_number().over(w)).filter("rn <= 24").collect())

    assert last24(got) == last24(spark.read.parquet(tmp_shared))
    assert got.filter("pool_id = 'dense'").count() < 400  # old days of a dense pool are not read
