import contextlib
import io
import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import hours
from tests.frames import series
from tidemark.operators.features import pool_features
from tidemark.operators.labels import label
from tidemark.operators.lookup import feature_vector, latest_values, read_features, to_feature_values
from tidemark.operators.maintenance import (
    check_not_null,
    dedup_latest,
    import_stats,
    page,
    prune,
    upsert,
    write_upsert,
)
from tidemark.schemas import FEATURES
from tidemark.sources.store import export_feature_values, has_files, import_feature_values


def test_dup_loads_newest_wins(spark):
    h = dt.datetime(2024, 1, 1, 5)
    rows = [("uniswap_v3", "p", h, 1.0, dt.datetime(2024, 1, 1, 6)),
            ("uniswap_v3", "p", h, 2.0, dt.datetime(2024, 1, 1, 8)),
            ("uniswap_v3", "p", h, 3.0, dt.datetime(2024, 1, 1, 7))]
    df = spark.createDataFrame(rows, "dex_protocol string, pool_id string, hour_ts timestamp_ntz, "
                                     "volume_usd double, load_ts timestamp_ntz")
    out = dedup_latest(df).collect()
    assert len(out) == 1 and out[0].volume_usd == 2.0
    assert list(dedup_latest(df).columns) == df.columns


def test_dedup_hot_key_is_aggregated_map_side(spark):
    h = dt.datetime(2024, 1, 1, 5)
    df = spark.range(20000).select(F.lit("uniswap_v3").alias("dex_protocol"), F.lit("hot").alias("pool_id"),
                                   F.lit(h).cast("timestamp_ntz").alias("hour_ts"),
                                   F.col("id").cast("double").alias("volume_usd"),
                                   F.timestamp_add("SECOND", F.col("id"), F.lit(h).cast("timestamp_ntz"))
                                   .alias("load_ts"))
    out = dedup_latest(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan or "Partial" in plan
    assert out.first().volume_usd == 19999.0


def test_upsert_idempotent(spark):
    feats = label(pool_features(series(spark, "p", "2024-01-01 00:00:00", [float(i) for i in range(30)])))
    upd = feats.filter(F.col("hour_ts") >= F.lit("2024-01-02").cast("timestamp_ntz")).withColumn(
        "anomaly_score", F.lit(0.5))
    once = upsert(feats, upd)
    twice = upsert(once, upd)
    key = ["pool_id", "hour_ts"]
    assert once.count() == 30
    assert sorted(once.collect(), key=lambda r: r.hour_ts) == sorted(twice.collect(), key=lambda r: r.hour_ts)
    assert once.filter(F.col("anomaly_score") == 0.5).count() == upd.count()
    assert once.select(*key).distinct().count() == 30


def test_write_upsert_on_disk_only_touched_days(spark, tmp_shared):
    feats = label(pool_features(series(spark, "p", "2024-01-01 00:00:00", [float(i) for i in range(48)])))
    path = f"{tmp_shared}/labeled"
    write_upsert(path, feats)
    upd = feats.filter(F.col("hour_ts") >= F.lit("2024-01-02 12:00").cast("timestamp_ntz")).withColumn(
        "anomaly_score", F.lit(0.9))
    write_upsert(path, upd)
    write_upsert(path, upd)
    back = spark.read.parquet(path)
    assert back.count() == 48
    assert back.filter(F.col("anomaly_score") == 0.9).count() == 12
    assert back.filter(F.col("hour_date") == dt.date(2024, 1, 1)).count() == 24


def test_prune_and_page(spark):
    df = series(spark, "p", "2024-01-20 00:00:00", [1.0] * 264)
    kept = prune(df, "2024-01-31 00:00:00", 7)
    assert kept.agg(F.min("hour_ts")).first()[0] == dt.datetime(2024, 1, 24)
    p = page(df, first=10, skip=5).collect()
    assert [r.hour_ts for r in p] == hours("2024-01-20 05:00:00", 10)


def test_not_null_report(spark):
    df = spark.createDataFrame([("a", None), (None, 1)], "pool_id string, x int")
    rep = {r.column_name: r for r in check_not_null(df, ["pool_id", "x"]).collect()}
    assert rep["pool_id"].null_count == 1 and not rep["pool_id"].passed and rep["x"].row_count == 2


def _store(spark):
    rows = [
        ("pool_001", dt.datetime(2024, 1, 1, 0), 900.0, 40000.0, 42),
        ("pool_001", dt.datetime(2024, 1, 1, 1), 1000.0, 50000.0, 42),
        ("pool_002", dt.datetime(2024, 1, 1, 1), 2000.0, None, None),
    ]
    df = spark.createDataFrame(rows, "entity_id string, feature_timestamp timestamp_ntz, volume_usd double, "
                                     "tvl_usd double, tx_count bigint")
    for c in FEATURES:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("bigint" if c in ("hour_of_day", "day_of_week") else "double"))
    return df.select("entity_id", "feature_timestamp", *FEATURES)


def test_read_features_defaults_and_counts(spark):
    ids = spark.createDataFrame([("pool_001",), ("pool_002",), ("nonexistent_pool",)], "pool_id string")
    got = {r.pool_id: r for r in read_features(_store(spark), ids, default=-999.0).collect()}
    assert got["pool_001"].volume_usd == 1000.0 and got["pool_001"].tvl_usd == 50000.0
    assert got["pool_001"].tx_count == 42.0  # int64 served as float
    assert got["pool_002"].volume_usd == 2000.0 and got["pool_002"].tvl_usd == -999.0
    assert got["nonexistent_pool"].volume_usd == -999.0
    assert (got["pool_001"].features_used, got["pool_001"].features_missing) == (3, 10)
    assert (got["nonexistent_pool"].features_used, got["nonexistent_pool"].features_missing) == (0, 13)
    nodef = {r.pool_id: r for r in read_features(_store(spark), ids, default=None).collect()}
    assert nodef["nonexistent_pool"].volume_usd is None


def test_feature_vector_order_and_fill(spark):
    row = feature_vector(_store(spark)).filter(F.col("entity_id") == "pool_002").first()
    assert len(row.features) == 13 and row.features[0] == 2000.0 and row.features[1] == 0.0


def test_latest_values_and_import_stats(spark):
    lv = {r.entity_id: r for r in latest_values(_store(spark)).collect()}
    assert lv["pool_001"].feature_timestamp == dt.datetime(2024, 1, 1, 1)
    stats = import_stats(_store(spark).filter(F.col("feature_timestamp") == dt.datetime(2024, 1, 1, 1)),
                         FEATURES).first()
    assert stats.imported_entity_count == 2 and stats.imported_feature_value_count == 4


def test_export_import_round_trip(spark, tmp_shared):
    feats = label(pool_features(series(spark, "p", "2024-01-30 00:00:00", [1.0] * 24)))
    out = f"{tmp_shared}/export"
    assert not has_files(spark, f"{out}/*")
    assert import_feature_values(spark, f"{out}/*") is None
    exp = export_feature_values(feats, "2024-01-31 00:00:00", path=out, run_time="2024-01-31T000000")
    assert exp.count() == 1 and exp.first().feature_timestamp == dt.datetime(2024, 1, 30, 23)
    assert has_files(spark, f"{out}/*")
    back = import_feature_values(spark, f"{out}/*")
    assert back.count() == 1 and back.columns[:2] == ["entity_id", "feature_timestamp"]
    assert to_feature_values(feats).columns == back.columns


def test_layers_views_union_and_materialize(spark, tmp_shared):
    from tidemark.operators.features import incremental_filter
    from tidemark.operators.maintenance import materialize
    from tidemark.operators.staging import union_protocols
    from tidemark.sources.raw import read_raw
    from tidemark.sources.store import read_labeled, register_views, write_labeled

    uni = series(spark, "u", "2024-01-01 00:00:00", [1.0] * 30, protocol="uniswap_v3")
    sushi = series(spark, "s", "2024-01-01 00:00:00", [2.0] * 30, protocol="sushiswap_v3")
    both = union_protocols(uni, sushi)
    assert both.count() == 60
    uni.write.parquet(f"{tmp_shared}/raw_u")
    sushi.write.parquet(f"{tmp_shared}/raw_s")
    assert read_raw(spark, {"uniswap": f"{tmp_shared}/raw_u", "sushiswap": f"{tmp_shared}/raw_s"}).count() == 60

    lab = label(pool_features(both))
    write_labeled(lab, f"{tmp_shared}/labeled")
    write_labeled(lab.filter(F.col("hour_ts") < F.lit("2024-01-02").cast("timestamp_ntz")), f"{tmp_shared}/labeled")
    assert read_labeled(spark, f"{tmp_shared}/labeled").count() == 60  # day 2 untouched by the rewrite
    register_views({"mart_pool_features_labeled": lab})
    assert spark.sql("SELECT count(*) FROM mart_pool_features_labeled").first()[0] == 60

    target = materialize(lab.filter(F.col("hour_ts") < F.lit("2024-01-01 12:00").cast("timestamp_ntz")),
                         "table", path=f"{tmp_shared}/mat")
    assert target.count() == 24
    newer = incremental_filter(lab, target.drop("hour_date"))
    assert newer.count() == 36
    merged = materialize(newer, "incremental", path=f"{tmp_shared}/mat")
    assert merged.count() == 60
    assert materialize(lab, "view", name="v_lab").count() == 60


def test_read_touched_prunes_partitions_statically(spark, tmp_shared):
    from tidemark.operators.maintenance import read_touched

    feats = label(pool_features(series(spark, "p", "2024-01-01 00:00:00", [float(i) for i in range(72)])))
    feats.withColumn("hour_date", F.to_date("hour_ts")).write.partitionBy("hour_date").parquet(tmp_shared)
    upd = feats.filter(F.col("hour_ts") >= F.lit("2024-01-03").cast("timestamp_ntz")).withColumn(
        "hour_date", F.to_date("hour_ts"))
    cur = read_touched(spark, tmp_shared, upd)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        cur.explain("formatted")
    plan = buf.getvalue()
    line = next(x for x in plan.splitlines() if x.startswith("PartitionFilters"))
    assert "hour_date" in line and "2024-01-03" in line
    assert "Join" not in plan
    assert cur.count() == 24


def test_write_upsert_touches_only_updated_days(spark, tmp_shared):
    feats = label(pool_features(series(spark, "p", "2024-01-01 00:00:00", [float(i) for i in range(72)])))
    write_upsert(tmp_shared, feats)
    upd = feats.filter(F.col("hour_ts") >= F.lit("2024-01-03").cast("timestamp_ntz")).withColumn(
        "anomaly_score", F.lit(0.25))
    write_upsert(tmp_shared, upd)
    write_upsert(tmp_shared, upd)
    out = spark.read.parquet(tmp_shared)
    assert out.count() == 72
    by_day = {r.d: r.n for r in out.groupBy(F.col("hour_date").cast("string").alias("d"))
              .agg(F.count_if(F.col("anomaly_score") == 0.25).alias("n")).collect()}
    assert by_day == {"2024-01-01": 0, "2024-01-02": 0, "2024-01-03": 24}


def test_upsert_takes_one_row_per_key(spark):
    from tidemark.operators.maintenance import upsert

    target = spark.createDataFrame([("a", 1, 1.0, 0), ("b", 1, 2.0, 0)], "pool_id string, hour_ts int, v double, load_ts int")
    updates = spark.createDataFrame([("a", 1, 5.0, 2), ("a", 1, 4.0, 1), ("c", 1, 9.0, 1), ("c", 1, 9.0, 1)], target.schema)
    assert sorted(map(tuple, upsert(target, updates).collect())) == [("a", 1, 5.0, 2), ("b", 1, 2.0, 0), ("c", 1, 9.0, 1)]


def test_upserted_files_are_sorted_by_series(spark, tmp_shared):
    import glob

    import pyarrow.parquet as pq

    from tidemark.operators.maintenance import write_upsert

    rows = spark.range(400).select(F.concat(F.lit("p"), (F.col("id") * 37 % 100).cast("string")).alias("pool_id"),
                                   F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id % 4 as int))").alias("hour_ts"), F.rand(1).alias("v"))
    rows = rows.dropDuplicates(["pool_id", "hour_ts"])
    write_upsert(tmp_shared, rows)
    write_upsert(tmp_shared, rows.withColumn("v", F.lit(1.0)))
    files = glob.glob(f"{tmp_shared}/hour_date=*/*.parquet")
    assert len(files) <= 4
    for f in files:
        ids = pq.ParquetFile(f).read(columns=["pool_id"])["pool_id"].to_pylist()
        assert ids == sorted(ids)


def test_missing_records_come_back_and_are_rejected(spark, tmp_shared):
    from tidemark.sources.raw import enforce_required, read_raw_jsonl, write_landing

    rows = spark.sql("SELECT null AS raw, 'p' AS pool_id, 'uniswap_v3' AS dex_protocol, timestamp_ntz'2024-01-01 00:00:00' AS hour_ts, "
                     "timestamp_ntz'2024-01-01 00:00:00' AS load_ts")
    write_landing(rows.unionByName(rows.withColumn("raw", F.lit("{}"))), tmp_shared)
    good, rejected = enforce_required(read_raw_jsonl(spark, tmp_shared))
    assert good.count() == 1 and rejected.count() == 1


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    import pytest

    from tidemark.session import checkpoint_dir

    bare = SimpleNamespace(get=lambda *a: None)
    spark = SimpleNamespace(conf=bare, sparkContext=SimpleNamespace(getConf=lambda: bare, master="spark://host:7077"))
    with pytest.raises(ValueError):
        checkpoint_dir(spark)
