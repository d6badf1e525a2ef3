"""Feature look-ups: latest value per entity, defaults, vectors (M-8, J-4, J-5, P-16, I-9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import as_double, fill_default
from tidemark.operators.maintenance import one_per_key
from tidemark.schemas import FEATURES


def to_feature_values(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Rename to the store layout: ``entity_id``, ``feature_timestamp`` + features (P-9)."""
    return df.select(F.col("pool_id").alias("entity_id"), F.col("hour_ts").alias("feature_timestamp"),
                     *[F.col(c) for c in features])


def latest_values(values: DataFrame, entity: str = "entity_id", ts: str = "feature_timestamp") -> DataFrame:
    """Newest row per entity (O-2) as an aggregation, so a busy entity is combined map-side; ties go by a hash of the row."""
    others = [c for c in values.columns if c not in (entity,)]
    out = values.groupBy(entity).agg(F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(F.col(ts), F.xxhash64(*others))).alias("_r"))
    return out.select(entity, "_r.*")


def latest_per_feature(values: DataFrame, features: Sequence[str] = FEATURES, entity: str = "entity_id",
                       ts: str = "feature_timestamp") -> DataFrame:
    """Newest value of each feature of each entity (M-8), with the time of the entity's newest row.

    A feature that the newest row leaves empty keeps its last written value,
    as a store that holds one cell per entity and feature does.  One
    aggregation with a partial step: a busy entity costs one row per task.  Of
    two values at the same time the larger counts; rows without a time are
    older than all others.
    """
    def newest(c: str):
        when = F.coalesce(ts, F.lit("0001-01-01").cast("timestamp_ntz"))
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(when, F.col(c).alias("v")))).alias(c)

    return values.groupBy(entity).agg(F.max(ts).alias(ts), *[newest(c) for c in features])


def read_features(
    values: DataFrame,
    ids: DataFrame,
    features: Sequence[str] = FEATURES,
    default: float | None = 0.0,
    id_col: str = "pool_id",
) -> DataFrame:
    """Online read as a join: every requested id gets the latest value of each feature (J-4, J-5), each feature
    from the newest row that holds it.

    Ints are served as doubles (F-17).  ``features_used`` counts values present
    before defaults are filled; absent ids keep the default, or NULL when no
    default is given (F-18).
    """
    # only the requested entities are aggregated (a request is small next to the store)
    wanted = ids.select(F.col(id_col).alias("entity_id")).distinct()
    latest = latest_per_feature(values.join(wanted, "entity_id", "left_semi"), features).select(
        F.col("entity_id").alias(id_col), *features)
    joined = ids.select(id_col).join(latest, id_col, "left")
    used = sum((F.col(c).isNotNull().cast("int") for c in features), F.lit(0))
    return joined.select(
        id_col,
        *[fill_default(as_double(c), default).alias(c) for c in features],
        used.cast("bigint").alias("features_used"),
        (F.lit(len(features)) - used).cast("bigint").alias("features_missing"),
    )


def feature_vector(df: DataFrame, features: Sequence[str] = FEATURES, default: float = 0.0,
                   name: str = "features") -> DataFrame:
    """13 named columns in the contract order as one ``array<double>`` (P-16); NULL -> ``default``."""
    return df.withColumn(name, F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float(default)))
                                         for c in features]))


def predict_ids(requests: DataFrame, scores: DataFrame, ids_col: str = "pool_ids",
                request_col: str = "request_id") -> DataFrame:
    """Gateway shape: each request's ``pool_ids`` -> one row per id in request order with its
    ``anomaly_score`` (0 when unknown) and ``is_anomaly`` (I-9)."""
    exploded = requests.select(request_col, F.posexplode(ids_col).alias("position", "pool_id"))
    s = one_per_key(scores.select("pool_id", "anomaly_score", "is_anomaly"), ("pool_id",))
    out = exploded.join(s, "pool_id", "left")
    return out.select(
        request_col,
        "position",
        "pool_id",
        F.coalesce(F.col("anomaly_score"), F.lit(0.0)).alias("anomaly_score"),
        F.coalesce(F.col("is_anomaly"), F.lit(False)).alias("is_anomaly"),
    )
