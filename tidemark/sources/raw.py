"""Raw landing layer: envelope, JSONL scan, REQUIRED check, partitioned append."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import instant_to_ntz, seconds_to_ntz, ts_literal
from tidemark.schemas import ISO_MICROS, RAW_JSONL, RAW_REQUIRED


def to_raw(records: DataFrame, protocol: str | Column, load_ts: Column | str | None = None,
           record_col: str = "record") -> DataFrame:
    """Envelope of API records: whole record as JSON text, ``pool.id``, ``<protocol>_v3``, hour, load time (S-1).

    ``records`` holds one struct column ``record`` (the API record); ``protocol``
    is the short protocol name or a column of it.
    """
    rec = F.col(record_col)
    proto = F.lit(protocol) if isinstance(protocol, str) else protocol
    if load_ts is None:
        load = F.localtimestamp()
    elif isinstance(load_ts, str) and load_ts in records.columns:
        load = F.col(load_ts)
    elif isinstance(load_ts, str):
        load = ts_literal(load_ts)
    else:
        load = load_ts
    return records.select(
        F.to_json(rec).alias("raw"),
        rec.getField("pool").getField("id").alias("pool_id"),
        F.concat(proto, F.lit("_v3")).alias("dex_protocol"),
        seconds_to_ntz(rec.getField("periodStartUnix")).alias("hour_ts"),
        load.alias("load_ts"),
    )


def read_raw_jsonl(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scan JSONL drops with the pinned 5-column schema; unknown fields are ignored (S-2).

    The nested record stays JSON text; instants become UTC TIMESTAMP_NTZ.
    """
    df = spark.read.schema(RAW_JSONL).option("timestampFormat", ISO_MICROS).json(path)
    return df.select(
        "raw",
        "pool_id",
        "dex_protocol",
        instant_to_ntz("hour_ts").alias("hour_ts"),
        instant_to_ntz("load_ts").alias("load_ts"),
    )


def enforce_required(df: DataFrame, cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, rejected) by NOT NULL on ``cols`` (S-3)."""
    cols = cols or RAW_REQUIRED
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return df.filter(ok), df.filter(~ok)


def hour_slice(df: DataFrame, end: str | Column, col: str = "hour_ts", hours: int = 1) -> DataFrame:
    """Half-open interval ``[end - hours, end)`` (S-5, P-8)."""
    end_c = ts_literal(end) if isinstance(end, str) else end
    start = F.timestamp_add("HOUR", F.lit(-hours), end_c)
    return df.filter((F.col(col) >= start) & (F.col(col) < end_c))


def read_raw(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Per-protocol raw tables as one logical source (S-6): union by name."""
    frames = [spark.read.format(fmt).load(p) for p in paths.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_hour_date(df: DataFrame, col: str = "hour_ts") -> DataFrame:
    return df.withColumn("hour_date", F.to_date(F.col(col)))


def append_raw(df: DataFrame, path: str, files_per_day: int | None = None) -> None:
    """Append to the raw table, partitioned by day, clustered by (pool_id, dex_protocol) (S-4).

    By default the rows are rebalanced on ``hour_date`` (Spark's ``REBALANCE``
    hint): AQE splits a day holding a large share of the rows over several
    write tasks and packs small days together, so files come out near the
    advisory partition size without a hand-set count.  ``files_per_day``
    spreads every day over that many hash buckets of ``pool_id`` instead.
    Each file is sorted for row-group skipping on pool filters.
    """
    out = with_hour_date(df)
    if files_per_day:
        bucket = F.abs(F.xxhash64("pool_id")) % files_per_day
        out = out.repartition("hour_date", bucket)
    else:
        out = out.hint("rebalance", "hour_date")
    (
        out.sortWithinPartitions("hour_date", "pool_id", "dex_protocol", "hour_ts")
        .write.mode("append")
        .partitionBy("hour_date")
        .parquet(path)
    )


def write_landing(df: DataFrame, path: str, files_per_partition: int | None = None) -> None:
    """Landing layout ``<path>/protocol=<p>/date=<yyyy-mm-dd>/part-*`` of JSON lines (S-15).

    Each line is ``{"raw": <record>, "pool_id": .., "dex_protocol": .., "hour_ts": .., "load_ts": ..}``
    with the record spliced in as JSON (not re-parsed); a missing record is JSON null, so the
    row comes back and ``enforce_required`` can reject it.  Rows are rebalanced
    on (protocol, date) by default, so a folder gets few files instead of one
    per writing task and AQE splits a (protocol, date) that holds a large
    share of a run over several tasks; ``files_per_partition`` fixes the
    count per folder instead.  Files are gzipped (readers go by their ending):
    a record repeats its field names, so a drop takes a small part of its text.
    """
    rest = F.to_json(F.struct(
        "pool_id",
        "dex_protocol",
        F.date_format("hour_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("hour_ts"),
        F.date_format("load_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("load_ts"),
    ))
    line = F.concat(F.lit('{"raw":'), F.coalesce(F.col("raw"), F.lit("null")), F.lit(","), F.expr("substring(_rest, 2)"))
    out = df.select(
        F.regexp_replace("dex_protocol", "_v3$", "").alias("protocol"),
        F.to_date("hour_ts").alias("date"),
        F.col("raw"),
        rest.alias("_rest"),
        F.col("pool_id"),
    ).select("protocol", "date", "pool_id", line.alias("value"))
    if files_per_partition:
        spread = F.pmod(F.xxhash64("pool_id"), F.lit(files_per_partition))
        out = out.repartition("protocol", "date", spread)
    else:
        out = out.hint("rebalance", "protocol", "date")
    out.drop("pool_id").write.mode("append").partitionBy("protocol", "date").text(path, compression="gzip")
