"""Per-pool percentile labels (M-3) and score write-back (J-6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import LABELED

LABEL_P = 0.9


def _pct(col: str, p: float, approx: bool, accuracy: int) -> Column:
    return F.percentile_approx(col, p, accuracy) if approx else F.percentile(col, F.lit(p))


def pool_percentile(df: DataFrame, p: float = LABEL_P, col: str = "volume_usd", approx: bool = False,
                    accuracy: int = 10000, by: str = "pool_id") -> DataFrame:
    """``pct_90`` per pool: exact interpolated percentile (A-7) or approximate (A-8)."""
    return df.groupBy(by).agg(_pct(col, p, approx, accuracy).alias("pct_90"))


def label(
    features: DataFrame,
    p: float = LABEL_P,
    approx: bool = False,
    strategy: str = "window",
    accuracy: int = 10000,
) -> DataFrame:
    """Labelled features: ``is_anomaly = volume_usd >= pct_90`` (NULL -> FALSE), empty score (M-3).

    ``strategy='window'`` evaluates the percentile over the pool partition the
    feature windows already produced (no second exchange, nothing broadcast);
    ``'join'`` is the reference's aggregate + ``JOIN ... USING (pool_id)`` (J-1).
    """
    if strategy == "window":
        pct = _pct("volume_usd", p, approx, accuracy).over(Window.partitionBy("pool_id"))
        with_pct = features.withColumn("pct_90", pct)
    elif strategy == "join":
        with_pct = features.join(pool_percentile(features, p, approx=approx, accuracy=accuracy), "pool_id")
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    is_anom = F.when(F.col("volume_usd") >= F.col("pct_90"), F.lit(True)).otherwise(F.lit(False))
    out = with_pct.withColumn("is_anomaly", is_anom).withColumn("anomaly_score", F.lit(None).cast("double"))
    return out.select(*LABELED.fieldNames())


def with_score(labeled: DataFrame, score: Column) -> DataFrame:
    """Fill ``anomaly_score`` from a column expression of the same row."""
    return labeled.withColumn("anomaly_score", score)


def apply_scores(labeled: DataFrame, scores: DataFrame, keys: tuple[str, ...] = ("pool_id", "hour_ts")) -> DataFrame:
    """Write scores back onto labelled rows: left join, new score wins, old kept otherwise (J-6).

    A key scored more than once takes its largest score, so no row is multiplied.
    """
    s = scores.groupBy(*keys).agg(F.max("anomaly_score").alias("_new_score"))
    out = labeled.join(s, list(keys), "left")
    out = out.withColumn("anomaly_score", F.coalesce("_new_score", "anomaly_score")).drop("_new_score")
    return out.select(*labeled.columns)
