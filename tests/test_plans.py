"""Plan shapes the scale design relies on, read from ``explain("formatted")``."""

import contextlib
import io
import re

import pytest

from tests.conftest import SF001
from tidemark.plans.registry import QUERIES


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def shuffles(plan: str) -> int:
    """Hash/range shuffles in the physical tree (broadcasts not counted)."""
    return len(set(re.findall(r"(?<![A-Za-z])Exchange \((\d+)\)", plan)))


def read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


@pytest.mark.parametrize("name", ["pool_features", "pool_features_labeled", "anomaly_dashboard",
                                  "latest_status", "supplier_day_labeled"])
def test_windows_share_one_exchange_after_the_aggregation(spark, name):
    plan = plan_of(QUERIES[name](spark, SF001))
    # one shuffle for the pool-hour aggregation, one partitioning reused by every window
    assert shuffles(plan) == 2, plan
    assert "BroadcastExchange" not in plan and "SortMergeJoin" not in plan


def test_scan_reads_only_the_used_columns(spark):
    plan = plan_of(QUERIES["pool_features"](spark, SF001))
    (schema,) = read_schemas(plan)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == ["event_type", "props", "ts", "user_id",
                                                                   "value"]
    plan = plan_of(QUERIES["supplier_day_features"](spark, SF001))
    (schema,) = read_schemas(plan)
    assert len(schema.split(",")) == 6  # of lineitem's 12 columns


def test_top1_and_topk_are_limited_before_the_shuffle(spark):
    plan = plan_of(QUERIES["latest_status"](spark, SF001))
    assert "WindowGroupLimit" in plan
    plan = plan_of(QUERIES["anomaly_dashboard"](spark, SF001))
    assert shuffles(plan) == 2


def test_dedup_combines_copies_map_side(spark):
    plan = plan_of(QUERIES["dedup_latest"](spark, SF001))
    assert "partial_max_by" in plan
    # the parsed JSON is not what is shuffled: the raw text column is gone before the dedup exchange
    dedup_exchange = [line for line in plan.splitlines() if "partial_max_by" in line]
    assert dedup_exchange and "raw" not in " ".join(dedup_exchange)


def test_hourly_kpis_aggregate_before_the_global_lag(spark):
    plan = plan_of(QUERIES["anomaly_timeseries"](spark, SF001))
    # the un-partitioned window only sees the (date, hour) aggregate
    assert "SinglePartition" in plan
    assert plan.index("partial_count") > 0


def test_incremental_warmup_is_a_per_partition_top24(spark):
    plan = plan_of(QUERIES["incremental_features"](spark, SF001))
    assert "WindowGroupLimit" in plan


def test_lookups_filter_the_store_before_aggregating(spark):
    plan = plan_of(QUERIES["latest_features"](spark, SF001))
    tree = plan.split("\n\n")[0].splitlines()
    agg = next(i for i, line in enumerate(tree) if "SortAggregate" in line or "max_by" in line)
    semi = next(i for i, line in enumerate(tree) if "LeftSemi" in line)
    # printed trees list children below parents: the semi-join feeds the latest-value aggregation
    assert semi > agg, "\n".join(tree)


def test_forest_sample_drops_rows_before_the_window(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.iforest import _sample

    df = spark.range(60_000).select(F.xxhash64("id").alias("_key"), F.array(F.randn(1), F.randn(2)).alias("x"))
    sample = _sample(df, F.col("_key"), 60_000, 50, 64, 42)
    assert sample.count() == 50 * 64
    assert sample.groupBy("tree").count().filter("count = 64").count() == 50
