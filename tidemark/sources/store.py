"""Feature-store style sinks and sources: hourly export, import, labelled table, guards (S-7 ... S-14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.maintenance import write_days
from tidemark.operators.lookup import to_feature_values
from tidemark.operators.staging import lookback_days
from tidemark.schemas import FEATURE_VALUES
from tidemark.sources.raw import hour_slice


def export_feature_values(labeled: DataFrame, as_of: Column | str, path: str | None = None,
                          run_time: str | None = None) -> DataFrame:
    """Last-hour slice ``[as_of - 1h, as_of)`` in store layout; written as Parquet
    under ``<path>/run_time=<run_time>`` when a path is given (S-7, M-7)."""
    out = to_feature_values(hour_slice(labeled, as_of))
    if path is not None:
        rt = run_time or (as_of if isinstance(as_of, str) else "now").replace(" ", "T").replace(":", "")
        out.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_time={rt}")
    return out


def has_files(spark: SparkSession, pattern: str) -> bool:
    """True when the glob matches at least one data file (S-9): an empty prefix makes the import a no-op.

    Lists through Spark's file index (``binaryFile`` source, only the ``path``
    column, so no file content is read); ``_``/``.`` files are ignored.
    """
    from pyspark.errors import AnalysisException

    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern)
        return len(files.select("path").limit(1).collect()) > 0
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def import_feature_values(spark: SparkSession, pattern: str) -> DataFrame | None:
    """Read exported Parquet with the explicit store schema (S-8); ``None`` when nothing is there."""
    if not has_files(spark, pattern):
        return None
    return spark.read.schema(FEATURE_VALUES).parquet(pattern)


def training_slice(labeled: DataFrame, as_of: Column | str, days: int = 30) -> DataFrame:
    """Training window: the last ``days`` days by instant (S-10)."""
    return lookback_days(labeled, as_of, days)


def write_labeled(df: DataFrame, path: str) -> None:
    """Day-partitioned labelled table; rewriting a day replaces only that day (S-12)."""
    write_days(df.withColumn("hour_date", F.to_date("hour_ts")), path, "overwrite")


def read_labeled(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_labeled_since(spark: SparkSession, path: str, as_of: str, hours: int) -> DataFrame:
    """The last ``hours`` hours of a labelled table before ``as_of``: its days as a partition filter, then the instants.

    ``latest_status``, ``anomaly_dashboard``, ``anomaly_timeseries`` and the
    hourly export read this and compute nothing older again.
    """
    import datetime as _dt

    since = _dt.datetime.fromisoformat(as_of) - _dt.timedelta(hours=hours)
    table = spark.read.parquet(path)
    return table.filter((F.col("hour_date") >= F.lit(since.date())) & (F.col("hour_ts") >= F.lit(since))).drop("hour_date")


def register_views(layers: dict[str, DataFrame]) -> list[str]:
    """Named views over each layer (S-13)."""
    for name, df in layers.items():
        df.createOrReplaceTempView(name)
    return list(layers)
