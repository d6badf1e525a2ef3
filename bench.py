"""Benchmark: wall time and shuffle volume of the headline registered queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and forces full evaluation with the ``noop`` sink (no
rows are brought to the driver).  Shuffle bytes per query come from Spark's
event log, written to a fresh scratch folder and read after the session
stops (jobs are tagged with the query name as their job group).  Prints one
JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.registry import QUERIES  # noqa: E402
from tidemark.session import get_spark  # noqa: E402

HEADLINE = [
    "stg_pool_hourly_all",
    "pool_features",
    "pool_features_labeled",
    "latest_status",
    "anomaly_dashboard",
    "anomaly_timeseries",
    "feature_export",
    "latest_features",
    "incremental_features",
    "dedup_latest",
    "upsert_labeled",
    "supplier_day_labeled",
    "raw_table_ingest",
    "labeled_table_upsert",
    "iforest_scores",
    "iforest_decisions",
    "predict_pools",
    "hourly_pipeline",
    "stream_hourly_stats",
    "stream_dedup_latest",
    "stream_features",
    "stream_labeled",
    "stream_alerts",
    "partial_rows_lookup",
    "last_hour_features",
    "stored_feature_export",
    "seek_page",
    "compacted_table",
]


def shuffle_bytes(log_dir: str) -> dict[str, dict[str, int]]:
    """Per job group: shuffle bytes written and read, summed over task-end events."""
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, int]] = {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not group or not m:
                        continue
                    w = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    r = m.get("Shuffle Read Metrics") or {}
                    rd = r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
                    acc = out.setdefault(group, {"write": 0, "read": 0})
                    acc["write"] += int(w)
                    acc["read"] += int(rd)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    shuffle_partitions = 2 * cpus
    log_dir = tempfile.mkdtemp(prefix="tidemark-bench-events-")
    os.environ["TIDEMARK_EVENT_LOG_DIR"] = log_dir
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=shuffle_partitions, app="tidemark-bench")
    sc = spark.sparkContext
    # warm-up: JVM class loading and code generation, not counted
    QUERIES["pool_features"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    try:
        shuffled = shuffle_bytes(log_dir)
    except (OSError, ValueError):  # the timing line is printed even without stage metrics
        shuffled = {}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_wall_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "shuffle_partitions": shuffle_partitions,
        "shuffle_bytes_written": {n: shuffled.get(n, {}).get("write", 0) for n in names},
        "shuffle_bytes_read": {n: shuffled.get(n, {}).get("read", 0) for n in names},
    }))


if __name__ == "__main__":
    main()
