"""Sharding by histogram sort.

Rows are ordered by (key, row number of a stored copy).  Splitters are found
by refinement: each round counts, exactly and over all rows, the bytes below a
few candidate boundaries inside every splitter's interval, and keeps the
sub-interval that holds the target.  When all splitters meet the tolerance the
rows move once, to their shard's part, and are numbered there.

Only DataFrame functions run; the driver sees one number per candidate.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Candidates counted inside one splitter's interval per round.
PROBES = 7
#: Key ranges inside each shard, cut by the same splitters.
RANGES = 4
#: Weight that one part of a range may hold; heavier ranges are salted by row number into several parts.
PART_WEIGHT = 64 << 20

KEY, TIE, SIZE, SHARD, PART, SLOT = (f"__tm_{x}" for x in ("key", "tie", "size", "shard", "part", "slot"))

Bound = tuple[int, int]


def _place(bounds: list[Bound]) -> Column:
    """How many of the sorted bounds are at or below the row: its cell, found by comparing with an array literal."""
    if not bounds:
        return F.lit(0)
    cells = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(t).cast("long").alias("t")) for k, t in bounds])
    row = F.struct(F.col(KEY).alias("k"), F.col(TIE).alias("t"))
    return F.size(F.filter(cells, lambda c: c <= row))


def _inside(low: Bound, high: Bound, ties: int) -> list[Bound]:
    """Up to PROBES bounds strictly between two, evenly spaced in the key, or in the tie (below ``ties``) when one key is left."""
    steps = [(i + 1, PROBES + 1) for i in range(PROBES)]
    if (gap := high[0] - low[0]) > 1:
        found = {(low[0] + gap * i // n, 0) for i, n in steps}
    elif gap == 1 and high[1] > 0:
        found = {(high[0], 0)}
    else:
        gap = (ties if high[0] > low[0] else high[1]) - low[1]
        found = {(low[0], low[1] + gap * i // n) for i, n in steps}
    return sorted(x for x in found if low < x < high)


def _measure(digest: DataFrame, bounds: list[Bound]) -> list[int]:
    """Exact weight below each bound: one aggregation with as many groups as bounds plus one."""
    cells = digest.groupBy(_place(bounds).alias("cell")).agg(F.sum(SIZE).alias("w")).collect()
    weight = {r["cell"]: r["w"] for r in cells}
    return list(accumulate(weight.get(i, 0) for i in range(len(bounds))))


def splitters(digest: DataFrame, shards: int, tolerance: float) -> tuple[list[Bound], int]:
    """``shards - 1`` bounds whose weight below misses its target by at most ``tolerance`` of a shard, or the nearest
    there is between two rows; and the whole weight."""
    top = digest.agg(F.sum(SIZE).alias("w"), F.min(KEY).alias("lo"), F.max(KEY).alias("hi"), F.max(TIE).alias("t")).head()
    if not top or top["lo"] is None:
        return [(0, 0)] * (shards - 1), 0
    total, last = top["w"], (top["hi"], top["t"] + 1)
    targets = [total * (i + 1) / shards for i in range(shards - 1)]
    allowed = tolerance * total / shards
    low = [((top["lo"], 0), 0)] * (shards - 1)
    high = [(last, total)] * (shards - 1)
    while True:
        probes = [_inside(lo[0], hi[0], last[1]) if min(t - lo[1], hi[1] - t) > allowed else [] for t, lo, hi in zip(targets, low, high)]
        bounds = sorted({p for ps in probes for p in ps})
        if not bounds:
            return [lo[0] if t - lo[1] <= hi[1] - t else hi[0] for t, lo, hi in zip(targets, low, high)], total
        counted = list(zip(bounds, _measure(digest, bounds)))
        for i, t in enumerate(targets):
            low[i] = max([low[i], *(c for c in counted if c[1] <= t and low[i][0] <= c[0] <= high[i][0])])
            high[i] = min([high[i], *(c for c in counted if c[1] > t and low[i][0] <= c[0] <= high[i][0])])


def shard(df: DataFrame, key: str = "doc_id", weight: Column | None = None, shards: int = 16, tolerance: float = 0.004,
          part_weight: int = PART_WEIGHT) -> DataFrame:
    """``df`` with ``__tm_shard`` (0 .. shards - 1) and ``__tm_slot`` (gapless from 0 in each shard).

    ``weight``: a positive whole number per row; every shard gets nearly the
    same sum (rows are never split, and the miss at each splitter is at most
    ``tolerance`` of a shard plus one row).  Shards are contiguous ranges of
    the integer ``key``, null keys first; inside a shard the slots follow the
    key, but for ranges over ``part_weight``, whose rows are dealt over sorted
    parts.  A key with many rows is cut between its rows, by their number in
    the stored copy.  An empty table gives an empty result.  Further columns
    are kept as they are; a null weight counts as 0.
    """
    weight = F.lit(1) if weight is None else weight
    rows = stored(
        df.withColumns({
            KEY: F.col(key).cast("long"),
            TIE: F.monotonically_increasing_id(),
            SIZE: F.coalesce(weight.cast("long"), F.lit(0)),
        }), "shard-rows")
    least = rows.agg(F.min(KEY)).head()[0]
    rows = rows.withColumn(KEY, F.coalesce(KEY, F.lit(max((least or 0) - 1, -(1 << 63))).cast("long")))  # nulls first
    digest = rows.select(KEY, TIE, SIZE)
    cuts, total = splitters(digest, shards * RANGES, tolerance / RANGES)
    salts = max(1, -(-total // (shards * RANGES * part_weight)))
    rows = rows.withColumn(PART, _place(cuts) * salts + F.pmod(F.col(TIE), F.lit(salts)))
    ahead = Window.partitionBy(SHARD).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(PART).agg(F.count("*").alias("__tm_n"))  # one row for each part
              .withColumn(SHARD, F.floor(F.col(PART) / F.lit(salts * RANGES)).cast("int"))
              .select(PART, SHARD, F.coalesce(F.sum("__tm_n").over(ahead), F.lit(0)).alias("__tm_before")))
    inside = Window.partitionBy(PART).orderBy(KEY, TIE)
    return (rows.repartition(shards * RANGES * salts, PART)
            .withColumn("__tm_row", F.row_number().over(inside) - 1)
            .join(F.broadcast(starts), PART)
            .withColumn(SLOT, (F.col("__tm_before") + F.col("__tm_row")).cast("long"))
            .drop(KEY, TIE, SIZE, PART, "__tm_row", "__tm_before"))


def op7(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near-equal bytes, law ``bytes``."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = shard(docs, "doc_id", size)
    return out.select(
        "doc_id", size.alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col(SHARD).cast("int").alias("shard"), F.col(SLOT).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
