"""Incremental maintenance: dedup, upsert, retention, paging and data checks (V-*, S-14, O-4, P-15, A-12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.staging import lookback_days


def dedup_latest(df: DataFrame, keys: Sequence[str] = ("dex_protocol", "pool_id", "hour_ts"),
                 order: str = "load_ts") -> DataFrame:
    """One row per key, the newest ``order`` wins (V-3).

    Planned as an aggregation (``max_by`` over a struct of the row), so the
    copies of a key are combined map-side before the shuffle: a key with
    millions of copies costs one row per task, not one giant group.  Ties on
    ``order`` are broken by a hash of the row so the result is deterministic.
    """
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    rank = F.struct(F.col(order), F.xxhash64(*[F.col(c) for c in others]))
    out = df.groupBy(*keys).agg(F.max_by(row, rank).alias("_row"))
    return out.select(*keys, "_row.*").select(*df.columns)


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the newest ``load_ts`` if there is that column, ties by a hash of the row."""
    if "load_ts" in df.columns and "load_ts" not in keys:
        return dedup_latest(df, keys, "load_ts")
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    row = F.struct(*[F.col(c) for c in others])
    out = df.groupBy(*keys).agg(F.max_by(row, F.xxhash64(*[F.col(c) for c in others])).alias("_row"))
    return out.select(*keys, "_row.*").select(*df.columns)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str] = ("pool_id", "hour_ts")) -> DataFrame:
    """Merge on a unique key: matched rows are replaced, new ones inserted (V-2, V-5).  NULL key parts are equal.

    Updates that give a key more than once count once: the newest ``load_ts``
    wins if they have one, else the row with the largest hash.  An anti join plus a union; AQE broadcasts the update keys only when their
    measured size is under the broadcast threshold, else it sort-merges.
    """
    updates = one_per_key(updates, keys)
    kept = without_keys(target, updates, keys)
    return kept.unionByName(updates.select(*target.columns))


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``; NULL key parts are equal, so a keyless row replaces its like."""
    names = [f"_key_{i}" for i in range(len(keys))]
    given = other.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    same = None
    for k, n in zip(keys, names):
        equal = F.col(k).eqNullSafe(F.col(n))
        same = equal if same is None else same & equal
    return df.join(given, same, "left_anti")


def read_touched(spark, path: str, updates: DataFrame, partition_col: str = "hour_date") -> DataFrame:
    """The partitions of the table at ``path`` that ``updates`` touches.

    The touched days are a literal list (one entry per calendar day between the
    first and the last update), so the scan prunes partitions at planning time
    whatever the size estimate of ``updates``.
    """
    days = [r[0] for r in updates.select(partition_col).distinct().collect()]
    touched = F.col(partition_col).isin([d for d in days if d is not None])
    if None in days:  # rows without a day have a partition of their own, which is rewritten like any other
        touched = touched | F.col(partition_col).isNull()
    return spark.read.parquet(path).filter(touched)


def write_days(df: DataFrame, path: str, mode: str, partition_col: str = "hour_date") -> None:
    """Write a day-partitioned table: days balanced over tasks, files sorted by series so row groups can be skipped.

    ``overwrite`` replaces only the days that ``df`` holds (the option is the
    write's own; the session setting is left alone).
    """
    order = [c for c in ("pool_id", "dex_protocol", "hour_ts") if c in df.columns]
    (df.hint("rebalance", partition_col).sortWithinPartitions(partition_col, *order)
     .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))


def write_upsert(spark_path: str, updates: DataFrame, keys: Sequence[str] = ("pool_id", "hour_ts"),
                 partition_col: str = "hour_date", ts_col: str = "hour_ts", deletes: DataFrame | None = None) -> None:
    """Apply ``upsert`` to a day-partitioned Parquet table in place; rows with the keys of ``deletes`` go first.

    Only partitions touched by the updates or deletes are read and rewritten
    (dynamic partition overwrite).  The merged partitions are first written to
    a staging folder under the shared checkpoint dir, so the target is never
    read and overwritten by the same plan.  The updates are written there too
    and read for both uses: nothing is held in executor memory.  A day that
    loses its only rows to ``deletes`` has nothing to be overwritten with; its
    partition is deleted after the others are written.
    """
    from tidemark.session import scratch_path

    spark = updates.sparkSession
    dated = lambda df: df if partition_col in df.columns else df.withColumn(partition_col, F.to_date(ts_col))
    upd = one_per_key(dated(updates), keys)
    if not table_exists(spark, spark_path):
        write_days(upd, spark_path, "append", partition_col)
        return
    stage = scratch_path(spark, "upsert")
    write_days(upd, f"{stage}/updates", "append", partition_col)
    upd = spark.read.schema(upd.schema).parquet(f"{stage}/updates")
    gone = upd.select(partition_col, *keys)
    if deletes is not None:
        gone = gone.unionByName(dated(deletes).select(partition_col, *keys).distinct())
    current = read_touched(spark, spark_path, gone, partition_col)
    kept = without_keys(current, gone, keys)
    merged = kept.unionByName(upd.select(*current.columns))
    merged.write.parquet(f"{stage}/merged")
    staged = spark.read.schema(merged.schema).parquet(f"{stage}/merged")
    emptied = set()
    if deletes is not None:
        days = lambda df: {r[0] for r in df.select(partition_col).distinct().collect()}
        emptied = days(current) - days(staged)
    write_days(staged, spark_path, "overwrite", partition_col)
    for day in emptied:
        drop_partition(spark, f"{spark_path}/{partition_col}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}")


def drop_partition(spark, path: str) -> None:
    """Delete one partition's folder, on whatever file system it lies."""
    system, folder = _hadoop(spark, path)
    system.delete(folder, True)


def table_exists(spark, path: str) -> bool:
    """True when ``path`` holds a readable Parquet table; other errors than a missing or empty folder are raised."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def prune(df: DataFrame, as_of: Column | str, days: int, col: str = "hour_ts") -> DataFrame:
    """Retention: keep the last ``days`` calendar days (S-14); with ``hour_date`` partitions this prunes files."""
    return lookback_days(df, as_of, days, col=col, by_date=True)


def _hadoop(spark, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def written(spark, path: str) -> bool:
    """True when a write to ``path`` was completed: its success marker is there."""
    system, marker = _hadoop(spark, f"{path.rstrip('/')}/_SUCCESS")
    return bool(system.exists(marker))


def partitions(spark, path: str, partition_col: str = "hour_date") -> dict[str, tuple[int, int]]:
    """``{value: (files, bytes)}`` of a table's partitions, from the file system's own listing (no file is opened)."""
    system, folder = _hadoop(spark, path)
    found: dict[str, tuple[int, int]] = {}
    for entry in system.listStatus(folder):
        name = entry.getPath().getName()
        if entry.isDirectory() and name.startswith(f"{partition_col}="):
            files = [f for f in system.listStatus(entry.getPath()) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
            found[name.split("=", 1)[1]] = (len(files), sum(f.getLen() for f in files))
    return found


def prune_table(spark, path: str, as_of: str, days: int, partition_col: str = "hour_date") -> list[str]:
    """Retention on disk (S-14): delete the partitions older than the last ``days`` calendar days before ``as_of``.

    Partition values are dates, or instants that begin with one (an export's
    ``run_time``).  Only folders are listed and deleted; running it again
    changes nothing, and a run that was cut short is completed by the next.
    The partition of rows without a day, and values that are no date, stay.
    Returns the values deleted.
    """
    import datetime as _dt

    keep_from = _dt.date.fromisoformat(as_of[:10]) - _dt.timedelta(days=days)
    gone = []
    for value in sorted(partitions(spark, path, partition_col)):
        try:
            day = _dt.date.fromisoformat(value[:10])
        except ValueError:
            continue
        if day < keep_from:
            drop_partition(spark, f"{path.rstrip('/')}/{partition_col}={value}")
            gone.append(value)
    return gone


def compact(spark, path: str, most_files: int = 4, partition_col: str = "hour_date") -> list[str]:
    """Rewrite the days of an appended table that have more than ``most_files`` files (S-4).

    A table that gets a file from every hourly run ends up with many small
    ones.  The days concerned are read once, staged in the shared folder and
    written back as files near the advisory partition size, sorted by series,
    so that row groups can be skipped; the other days are not touched.  Rows
    do not change.  The rewrite replaces whole days: appends to the same days
    must not run beside it.  Returns the days rewritten.
    """
    from tidemark.session import scratch_path

    days = sorted(v for v, (files, _) in partitions(spark, path, partition_col).items() if files > most_files and v != "__HIVE_DEFAULT_PARTITION__")
    if not days:
        return []
    table = spark.read.parquet(path)
    some = table.filter(F.col(partition_col).cast("string").isin(days))
    stage = scratch_path(spark, "compact")
    some.write.parquet(stage)
    write_days(spark.read.schema(some.schema).parquet(stage), path, "overwrite", partition_col)
    spark.catalog.refreshByPath(path)
    return days


PAGE_ORDER = ("hour_ts", "pool_id", "dex_protocol")
PAGE_INDEX = "page_range_group int, page_range bigint, rows bigint, before bigint"
#: Rows of a paged table that one task writes into one partition.
PAGE_GROUP_ROWS = 100_000


def write_pages(df: DataFrame, path: str, order: Sequence[str] = PAGE_ORDER, rows_per_range: int = 100_000) -> None:
    """Write ``df`` in key ranges with an exact index, so that any page is read from its own ranges (O-4).

    One range exchange puts the rows in order over groups of about
    ``PAGE_GROUP_ROWS`` rows (or one range, if that is more); each is a
    partition of the table, and what the driver gets grows with the groups,
    not with the ranges.  In a group the ordered rows are cut into ranges of
    ``rows_per_range``, numbered in order over the whole table; the files'
    pages are as long, so their own statistics pick the ranges asked for.  The
    index counts the rows of every range and those before it: one row for each range.
    """
    spark = df.sparkSession
    n = df.count()
    groups = max(1, -(-n // max(rows_per_range, PAGE_GROUP_ROWS)))
    # the place of a row in the sorted group: the id's lower 33 bits, the group above them
    ordered = df.repartitionByRange(groups, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    group, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    placed = ordered.withColumns({"page_range_group": group.cast("int"), "page_range": F.shiftleft(group, 33) + F.floor(place / rows_per_range)})
    (placed.drop("_id").sortWithinPartitions("page_range_group", "page_range").write.option("parquet.page.row.count.limit", rows_per_range)
     .partitionBy("page_range_group").parquet(f"{path}/rows"))
    if not n:
        spark.createDataFrame([], PAGE_INDEX).write.parquet(f"{path}/index")
    else:
        sizes = spark.read.parquet(f"{path}/rows").groupBy("page_range_group", "page_range").agg(F.count(F.lit(1)).alias("rows"))
        # ranges are summed up in their group, and groups in one task: one row for each group
        earlier = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        sizes = sizes.withColumn("_within", earlier(Window.partitionBy("page_range_group").orderBy("page_range"), "rows"))
        totals = sizes.groupBy("page_range_group").agg(F.sum("rows").alias("_n"))
        totals = totals.select("page_range_group", earlier(Window.orderBy("page_range_group"), "_n").alias("_first"))
        index = sizes.join(totals, "page_range_group").select("page_range_group", "page_range", "rows", (F.col("_first") + F.col("_within")).alias("before"))
        index.hint("rebalance").write.parquet(f"{path}/index")
    df.limit(0).write.parquet(f"{path}/schema")


def read_page(spark, path: str, first: int, skip: int = 0, order: Sequence[str] = PAGE_ORDER) -> DataFrame:
    """Rows ``skip`` to ``skip + first`` of a table written by ``write_pages``; reads and sorts only the ranges they lie in."""
    schema = spark.read.parquet(f"{path}/schema").schema
    index = spark.read.schema(PAGE_INDEX).parquet(f"{path}/index")
    hit = index.filter((F.col("before") < skip + first) & (F.col("before") + F.col("rows") > skip)).agg(
        *[f(c).alias(f"{name}_{c}") for c in ("page_range_group", "page_range") for name, f in (("first", F.min), ("last", F.max))],
        F.min("before").alias("before")).first()
    if hit["before"] is None:
        return spark.createDataFrame([], schema)
    rows = spark.read.parquet(f"{path}/rows")
    for c in ("page_range_group", "page_range"):
        rows = rows.filter(F.col(c).between(hit[f"first_{c}"], hit[f"last_{c}"]))
    return rows.orderBy(*order).offset(skip - hit["before"]).limit(first).select(*schema.fieldNames())


def page(df: DataFrame, first: int, skip: int = 0, order: Sequence[str] = ("hour_ts", "pool_id", "dex_protocol")) -> DataFrame:
    """Ordered ``first``/``skip`` slice (O-4).  The order must be total (unique key) to page stably."""
    return df.orderBy(*order).offset(skip).limit(first)


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NOT NULL data test: one row per column with its NULL count, from a single scan (P-15)."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_n_{i}") for i, c in enumerate(cols)],
    )
    stacked = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n_{i}").alias("null_count"))
        for i, c in enumerate(cols)
    ]))
    out = counts.select(F.col("_rows").alias("row_count"), stacked)
    return out.select(
        "column_name",
        "null_count",
        "row_count",
        (F.col("null_count") == 0).alias("passed"),
    )


def import_stats(values: DataFrame, features: Sequence[str], entity: str = "entity_id") -> DataFrame:
    """Import counters: distinct entities and non-null feature values (A-12)."""
    return values.agg(
        F.count_distinct(entity).alias("imported_entity_count"),
        sum((F.count(F.col(c)) for c in features), F.lit(0)).cast("bigint").alias("imported_feature_value_count"),
    )


def materialize(df: DataFrame, how: str, name: str | None = None, path: str | None = None,
                keys: Sequence[str] = ("pool_id", "hour_ts")) -> DataFrame:
    """Full rebuild (``table``), ``view`` or ``incremental`` upsert of a layer (V-6)."""
    spark = df.sparkSession
    if how == "view":
        if name:
            df.createOrReplaceTempView(name)
        return df
    if how == "table":
        if path is None:
            raise ValueError("table materialization needs a path")
        out = df if "hour_date" in df.columns else df.withColumn("hour_date", F.to_date("hour_ts"))
        order = [c for c in ("pool_id", "dex_protocol", "hour_ts") if c in out.columns]
        (out.hint("rebalance", "hour_date").sortWithinPartitions("hour_date", *order)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("hour_date").parquet(path))
        return spark.read.parquet(path)
    if how == "incremental":
        if path is None:
            raise ValueError("incremental materialization needs a path")
        write_upsert(path, df, keys)
        return spark.read.parquet(path)
    raise ValueError(f"unknown materialization {how!r}")
