from tidemark.streaming.streams import (
    features_batch,
    run_available_now,
    stage_stream,
    stream_dedup,
    stream_hourly_stats,
    stream_raw,
    upsert_latest_batch,
)

__all__ = [
    "features_batch",
    "run_available_now",
    "stage_stream",
    "stream_dedup",
    "stream_hourly_stats",
    "stream_raw",
    "upsert_latest_batch",
]
