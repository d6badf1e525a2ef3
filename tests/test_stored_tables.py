"""Written tables: retention, compaction, paging, null keys, warm-up reads, stored views and stream state."""

import datetime as dt
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.frames import series, staged_rows
from tests.test_plans import plan_of
from tidemark.operators.features import pool_features, recent_features, warm_history
from tidemark.operators.labels import label
from tidemark.operators.lookup import latest_per_feature
from tidemark.operators.maintenance import (
    compact,
    drop_partition,
    page,
    partitions,
    prune_table,
    read_page,
    upsert,
    write_days,
    write_pages,
    write_upsert,
)
from tidemark.operators.views import latest_status
from tidemark.sources.store import read_labeled_since, write_labeled


def rows_of(df, *cols):
    return sorted(map(repr, df.select(*cols).collect()))


def dated(df):
    return df.withColumn("hour_date", F.to_date("hour_ts"))


# --- retention, compaction, paging -----------------------------------------------------------


def test_old_partitions_are_deleted_and_only_those(spark, tmp_shared):
    df = series(spark, "p", "2024-01-01", [1.0] * 240)  # ten days
    late = df.withColumn("hour_ts", F.lit(None).cast("timestamp_ntz")).limit(1)
    write_days(dated(df.unionByName(late)), tmp_shared, "append")
    gone = prune_table(spark, tmp_shared, "2024-01-10 12:00:00", 3)
    assert gone == [f"2024-01-0{d}" for d in range(1, 7)]
    left = spark.read.parquet(tmp_shared)
    assert left.count() == 4 * 24 + 1  # the row without a day stays
    assert prune_table(spark, tmp_shared, "2024-01-10 12:00:00", 3) == []


def test_compaction_touches_only_days_with_many_files(spark, tmp_shared):
    df = series(spark, "p", "2024-01-01", [float(i) for i in range(48)])
    for part in range(6):
        write_days(dated(df.filter((F.to_date("hour_ts") == "2024-01-01") & (F.hour("hour_ts") % 6 == part))), tmp_shared, "append")
    write_days(dated(df.filter(F.to_date("hour_ts") == "2024-01-02")), tmp_shared, "append")
    before = partitions(spark, tmp_shared)
    assert before["2024-01-01"][0] == 6 and before["2024-01-02"][0] == 1
    want = rows_of(df, "pool_id", "hour_ts", "volume_usd")
    assert compact(spark, tmp_shared, most_files=3) == ["2024-01-01"]
    after = partitions(spark, tmp_shared)
    assert after["2024-01-01"][0] < 4 and after["2024-01-02"] == before["2024-01-02"]
    assert rows_of(spark.read.parquet(tmp_shared), "pool_id", "hour_ts", "volume_usd") == want
    assert compact(spark, tmp_shared, most_files=3) == []


def test_pages_by_index_equal_the_offset_form(spark, tmp_shared):
    df = series(spark, "a", "2024-01-01", [1.0] * 60).unionByName(series(spark, "b", "2024-01-01", [2.0] * 60))
    write_pages(df, tmp_shared, rows_per_range=17)
    for first, skip in ((10, 0), (25, 16), (1, 119), (50, 100), (200, 0), (5, 120), (0, 3)):
        got = [tuple(r) for r in read_page(spark, tmp_shared, first, skip).select("hour_ts", "pool_id").collect()]
        assert got == [tuple(r) for r in page(df, first, skip).select("hour_ts", "pool_id").collect()]
    plan = plan_of(read_page(spark, tmp_shared, 10, 40))
    assert "PartitionFilters: [page_range" in plan or "page_range" in plan.split("PartitionFilters:")[1].split("\n")[0]


def test_pages_hold_few_tasks_and_files(spark, tmp_shared, monkeypatch):
    """Short ranges share a task and a file: the driver hears of groups of rows, not of every range."""
    from tidemark.operators import maintenance

    df = series(spark, "a", "2024-01-01", [1.0] * 600).unionByName(series(spark, "b", "2024-01-01", [2.0] * 600))
    write_pages(df, f"{tmp_shared}/one", rows_per_range=5)
    assert list(partitions(spark, f"{tmp_shared}/one/rows", "page_range_group").values())[0][0] == 1
    assert len(partitions(spark, f"{tmp_shared}/one/rows", "page_range_group")) == 1
    index = spark.read.parquet(f"{tmp_shared}/one/index").orderBy("page_range").collect()
    assert [r["rows"] for r in index] == [5] * 240 and [r["before"] for r in index] == list(range(0, 1200, 5))
    monkeypatch.setattr(maintenance, "PAGE_GROUP_ROWS", 300)
    write_pages(df, f"{tmp_shared}/more", rows_per_range=7)
    assert 2 <= len(partitions(spark, f"{tmp_shared}/more/rows", "page_range_group")) <= 4
    for path in (f"{tmp_shared}/one", f"{tmp_shared}/more"):
        for first, skip in ((10, 0), (700, 290), (5, 1198), (3, 1200), (1200, 0)):
            got = [tuple(r) for r in read_page(spark, path, first, skip).select("hour_ts", "pool_id").collect()]
            assert got == [tuple(r) for r in page(df, first, skip).select("hour_ts", "pool_id").collect()]


def test_pages_of_nothing(spark, tmp_shared):
    write_pages(series(spark, "a", "2024-01-01", [1.0]).limit(0), tmp_shared)
    assert read_page(spark, tmp_shared, 10).collect() == []


# --- null keys -------------------------------------------------------------------------------


def test_rows_without_an_hour_survive_later_upserts(spark, tmp_shared):
    def batch(pool, hour, volume):
        rows = staged_rows(spark, [("uniswap_v3", pool, hour or h, volume, 1.0, 1.0, 1)])
        return rows if hour else rows.withColumn("hour_ts", F.lit(None).cast("timestamp_ntz"))

    h = dt.datetime(2024, 1, 1, 5)
    write_upsert(tmp_shared, batch("p", None, 1.0).unionByName(batch("p", h, 2.0)))
    write_upsert(tmp_shared, batch("q", None, 3.0))
    write_upsert(tmp_shared, batch("q", None, 4.0).unionByName(batch("p", h, 5.0)))
    got = sorted((r.pool_id, r.hour_ts is None, r.volume_usd) for r in spark.read.parquet(tmp_shared).collect())
    assert got == [("p", False, 5.0), ("p", True, 1.0), ("q", True, 4.0)]
    assert upsert(batch("p", None, 1.0), batch("p", None, 2.0)).count() == 1


def test_streams_reject_rows_without_a_key(spark, tmp_shared):
    from tidemark.streaming.streams import features_batch

    good = series(spark, "p", "2024-01-01", [1.0] * 30)
    bad = good.limit(2).withColumn("hour_ts", F.lit(None).cast("timestamp_ntz")).unionByName(good.limit(1).withColumn("pool_id", F.lit(None).cast("string")))
    body = features_batch(f"{tmp_shared}/t", rejects_path=f"{tmp_shared}/rejects")
    for _ in range(2):  # replayed as well
        body(good.unionByName(bad), 0)
    assert spark.read.parquet(f"{tmp_shared}/t").count() == 30
    assert spark.read.parquet(f"{tmp_shared}/rejects").count() == 3


# --- look-back below the windows -------------------------------------------------------------


def history(spark):
    frames = [series(spark, "dense", "2024-01-01", [float(i % 17) for i in range(480)]),
              series(spark, "sparse", "2024-01-01", [float(i) for i in range(40)], step_hours=[12 * i for i in range(40)]),
              series(spark, "ended", "2024-01-01", [1.0] * 50),
              series(spark, "new", "2024-01-20", [5.0, 6.0]),
              series(spark, "signs", "2024-01-01", [(-1.0) ** i * i for i in range(480)])]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def test_recent_features_equal_the_whole_history(spark, tmp_shared):
    df = history(spark)
    write_days(dated(df), tmp_shared, "append")
    start = "2024-01-20 00:00:00"
    want = pool_features(df, as_of="2024-01-21", lookback=None).filter(F.col("hour_ts") >= F.lit(start).cast("timestamp_ntz"))
    got = recent_features(spark, tmp_shared, start, as_of="2024-01-21")
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)
    end = "2024-01-20 05:00:00"
    got = recent_features(spark, tmp_shared, start, as_of="2024-01-21", end=end)
    want = want.filter(F.col("hour_ts") < F.lit(end).cast("timestamp_ntz"))
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)


def test_warm_up_reads_older_days_only_for_sparse_series(spark, tmp_shared):
    write_days(dated(history(spark)), tmp_shared, "append")
    rows = warm_history(spark, tmp_shared, "2024-01-20 00:00:00")
    old = rows.filter("hour_date < '2024-01-13'")
    assert {r[0] for r in old.select("pool_id").distinct().collect()} == {"sparse"}
    assert old.count() <= 24 and rows.filter("pool_id = 'ended'").count() == 0
    plan = plan_of(rows)
    assert plan.count("PartitionFilters: [isnotnull(hour_date") >= 2 and "LeftSemi" in plan


def test_stored_views_read_their_days(spark, tmp_shared):
    lab = label(pool_features(history(spark), as_of="2024-01-21", lookback=None))
    write_labeled(lab, tmp_shared)
    got = latest_status(read_labeled_since(spark, tmp_shared, "2024-01-21 00:00:00", 24), "2024-01-21 00:00:00")
    want = latest_status(lab, "2024-01-21 00:00:00")
    assert rows_of(got, *lab.columns) == rows_of(want, *lab.columns)
    plan = plan_of(got)
    assert "PartitionFilters: [isnotnull(hour_date" in plan and "hour_date#" in plan


def test_frames_exact_in_time(spark):
    steps = [0, 1, 2, 5, 6, 23, 24, 25, 30, 48, 49, 50, 72, 200]
    df = series(spark, "p", "2024-01-01", [float(3 * i + 1) for i in range(len(steps))], tvl=[float(i + 2) for i in range(len(steps))], step_hours=steps)
    got = {r.hour_ts: r for r in pool_features(df, lookback=None, frame="hours").collect()}
    t0 = dt.datetime(2024, 1, 1)
    at = {s: float(3 * i + 1) for i, s in enumerate(steps)}
    for s in steps:
        r = got[t0 + dt.timedelta(hours=s)]
        six, day = [v for k, v in at.items() if s - 5 <= k <= s], [v for k, v in at.items() if s - 23 <= k <= s]
        assert math.isclose(r.vol_ma_6h, np.mean(six)) and math.isclose(r.vol_ma_24h, np.mean(day))
        assert r.vol_std_24h is None if len(day) < 2 else math.isclose(r.vol_std_24h, np.std(day, ddof=1))
        assert r.vol_rate_24h is None if s - 24 not in at else math.isclose(r.vol_rate_24h, (at[s] - at[s - 24]) / at[s - 24])
    with pytest.raises(ValueError):
        pool_features(df, frame="days")


# --- newest value of each feature ------------------------------------------------------------


def test_each_feature_has_its_newest_value(spark):
    t = [dt.datetime(2024, 1, 1, h) for h in range(4)]
    rows = [("p", t[0], 1.0, 7.0), ("p", t[1], 5.0, None), ("p", t[2], None, None), ("q", t[3], None, None), ("p", None, 9.0, 9.0),
            ("r", t[1], 2.0, None), ("r", t[1], 3.0, None), ("s", None, 4.0, None)]
    df = spark.createDataFrame(rows, "entity_id string, feature_timestamp timestamp_ntz, a double, b double")
    got = {r.entity_id: tuple(r)[1:] for r in latest_per_feature(df, ["a", "b"]).collect()}
    assert got == {"p": (t[2], 5.0, 7.0), "q": (t[3], None, None), "r": (t[1], 3.0, None), "s": (None, 4.0, None)}


# --- forest draws ----------------------------------------------------------------------------


def test_draws_are_digits_of_md5_in_sql_and_python(spark):
    from tidemark.operators.iforest import _draw, _multipliers, _uniform, hash_number

    row = spark.range(1).select(hash_number(F.lit("a"), F.lit(3), F.lit(None).cast("string")).alias("n"), _uniform(F.lit(42), F.lit(7), F.lit(-5)).alias("u"),
                                _draw(F.lit(-5), *(F.lit(x).cast("bigint") for x in _multipliers(42, 7))).alias("d")).first()
    assert row.n == int(hashlib.md5(b"a|3|").hexdigest()[:12], 16)
    a, b = _multipliers(42, 7)
    assert row.u == row.d == ((a * (-5 % 2147483647) + b) % 2147483647) / 2147483647


def test_trees_grow_as_a_node_by_node_recursion_would():
    from tidemark.operators.iforest import _node_fraction, grow_tree

    x = np.round(np.random.default_rng(3).normal(size=(64, 3)), 1)
    x[:, 2] = 1.0
    want = []

    def grow(node, rows, depth):
        low, high = rows.min(0), rows.max(0)
        spread = [i for i in range(3) if high[i] > low[i]]
        if depth == 6 or not spread:
            want.append((node, -1, 0.0, len(rows), depth))
            return
        f = spread[int(_node_fraction(1, 5, node, "feature") * len(spread))]
        p = low[f] + _node_fraction(1, 5, node, "split") * (high[f] - low[f])
        p = p if low[f] < p <= high[f] else (low[f] + high[f]) / 2
        want.append((node, f, float(p), len(rows), depth))
        grow(2 * node + 1, rows[rows[:, f] < p], depth + 1)
        grow(2 * node + 2, rows[rows[:, f] >= p], depth + 1)

    grow(0, x, 0)
    assert sorted(grow_tree(x, 5, 6, 1)) == sorted(want)


def test_scoring_keeps_nan_in_other_columns(spark):
    from tidemark.operators.iforest import fit_iforest, score

    df = spark.range(50).select("id", F.col("id").cast("double").alias("a"), F.array(F.lit(float("nan"))).alias("v"), F.lit(float("nan")).alias("x"))
    out = score(df, fit_iforest(df, features=["a"], n_trees=5, key_cols=["id"])).collect()
    assert all(r.x is not None and math.isnan(r.x) and math.isnan(r.v[0]) for r in out)


# --- stream state ----------------------------------------------------------------------------


def test_drops_in_order_read_rings_and_no_history(spark, tmp_shared, monkeypatch):
    from tidemark.streaming import streams

    df = history(spark)
    cut = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 17, 7), dt.datetime(2024, 2, 1)]
    parts = [df.filter((F.col("hour_ts") >= F.lit(a)) & (F.col("hour_ts") < F.lit(z))) for a, z in zip(cut, cut[1:])]
    body = streams.features_batch(f"{tmp_shared}/t", ring_path=f"{tmp_shared}/ring")

    def refuse(*_a, **_k):
        raise AssertionError("history was read")

    with monkeypatch.context() as m:
        body(parts[0], 0)
        body(df.filter("pool_id = 'new'").limit(0), 1)
        m.setattr(streams, "stored_history", refuse)
        known = parts[1].filter("pool_id in ('dense', 'sparse', 'signs')")
        body(known, 2)
    body(parts[2], 3)
    body(parts[2], 3)  # replayed
    body(parts[1], 4)  # late rows of one series, the others again
    want = pool_features(df, lookback=None)
    got = spark.read.parquet(f"{tmp_shared}/t")
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)
    ring = {r.pool_id: r for r in spark.read.parquet(f"{tmp_shared}/ring").collect()}
    accepted = {k: sorted(r.hour_ts for r in df.filter(~F.col("has_negative_values")).filter(F.col("pool_id") == k).collect()) for k in ring}
    assert all([x.hour_ts for x in ring[k].rows] == accepted[k][-24:] for k in ring) and set(ring) == {"dense", "sparse", "ended", "new", "signs"}


def test_labels_of_a_stream_from_counted_values(spark, tmp_shared):
    from tidemark.streaming import streams

    df = history(spark)
    mid = F.lit(dt.datetime(2024, 1, 10))
    body = streams.features_batch(f"{tmp_shared}/t", ring_path=f"{tmp_shared}/ring", percentile_path=f"{tmp_shared}/pct")
    body(df.filter(F.col("hour_ts") >= mid), 0)
    body(df.filter((F.col("hour_ts") < mid) & (F.col("pool_id") != "ended")), 1)
    body(df.filter((F.col("hour_ts") < mid) & (F.col("pool_id") != "ended")), 1)  # replayed whole
    streams._apply_changes(spark, f"{tmp_shared}/pct/changes/batch=1", f"{tmp_shared}/pct", 1, 0.9)  # and in part
    body(df.filter("pool_id = 'ended'"), 2)
    # values replaced and taken back by newer loads
    newer = df.filter("pool_id in ('dense', 'signs') and day(hour_ts) = 5").withColumn("load_ts", F.col("load_ts") + F.expr("INTERVAL 1 DAY"))
    newer = newer.withColumn("volume_usd", F.when(F.hour("hour_ts") < 12, F.col("volume_usd") + 100).otherwise(-1.0))
    newer = newer.withColumn("has_negative_values", F.col("volume_usd") < 0)
    body(newer, 3)
    keys = ["dex_protocol", "pool_id", "hour_ts"]
    final = df.join(newer.select(*keys), keys, "left_anti").unionByName(newer.select(*df.columns))
    want = label(pool_features(final, lookback=None))
    got = streams.stream_labels(spark, f"{tmp_shared}/t", f"{tmp_shared}/pct")
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)
