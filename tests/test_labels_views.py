import datetime as dt

from pyspark.sql import functions as F

from tests.frames import series
from tidemark.operators.features import pool_features
from tidemark.operators.labels import apply_scores, label, pool_percentile
from tidemark.operators.views import anomaly_dashboard, anomaly_timeseries, latest_status


def test_p90_exact_and_approx(spark):
    df = spark.createDataFrame([("p", float(v)) for v in [1, 2, 3, 4]], "pool_id string, volume_usd double")
    assert abs(pool_percentile(df).first().pct_90 - 3.7) < 1e-12
    assert pool_percentile(df, approx=True).first().pct_90 == 4.0


def test_label_rule_and_strategies_agree(spark):
    feats = pool_features(series(spark, "p", "2024-01-01 00:00:00", [float(v) for v in range(1, 31)]))
    a = label(feats).orderBy("hour_ts").collect()
    b = label(feats, strategy="join").orderBy("hour_ts").collect()
    assert [r.is_anomaly for r in a] == [r.is_anomaly for r in b]
    assert sum(r.is_anomaly for r in a) == 3  # 28, 29, 30 are >= 27.1
    assert all(r.anomaly_score is None for r in a)


def test_apply_scores_keeps_old_when_absent(spark):
    feats = pool_features(series(spark, "p", "2024-01-01 00:00:00", [1.0, 2.0, 3.0]))
    lab = label(feats)
    scores = lab.limit(1).select("pool_id", "hour_ts", F.lit(0.7).alias("anomaly_score"))
    out = apply_scores(lab, scores).orderBy("hour_ts").collect()
    assert [r.anomaly_score for r in out] == [0.7, None, None]


def test_dashboard_window_equals_join(spark):
    feats = pool_features(series(spark, "p", "2024-01-20 00:00:00", [float(v % 7) for v in range(264)]))
    lab = label(feats).withColumn("anomaly_score", F.abs("volume_zscore"))
    as_of = "2024-01-31 00:00:00"
    w = anomaly_dashboard(lab, as_of).orderBy("hour_ts").collect()
    j = anomaly_dashboard(lab, as_of, strategy="join").orderBy("hour_ts").collect()
    assert w == j
    assert len(w) == 168 and w[0].total_hours == 168
    assert sum(r.needs_alert for r in w) <= 1
    cut = anomaly_dashboard(lab, as_of, keep=100).collect()
    assert len(cut) == 100 and all(r.total_hours == 168 for r in cut)  # summary before the cut


def test_latest_status_and_timeseries(spark):
    feats = pool_features(series(spark, "p", "2024-01-29 00:00:00", [1.0] * 40))
    lab = label(feats)
    st = latest_status(lab, "2024-01-31 00:00:00").collect()
    assert len(st) == 1 and st[0].hour_ts == dt.datetime(2024, 1, 30, 15)
    ts = anomaly_timeseries(lab, "2024-01-31 00:00:00").collect()
    assert len(ts) == 40 and ts[0].date == dt.date(2024, 1, 30)  # newest first
    assert ts[0].volume_24h_ago == 1.0 and ts[-1].volume_24h_ago is None
