"""The hourly job: export -> import -> batch prediction -> score write-back (M-9, S-11, X-3).

Every step is a DataFrame transform; files are written only when paths are
given (the reference hands Parquet files between services, Spark does not
need to).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.iforest import IForestModel, decide, fit_iforest, predict_class, score
from tidemark.operators.labels import apply_scores
from tidemark.operators.lookup import latest_per_feature
from tidemark.operators.maintenance import upsert
from tidemark.schemas import FEATURES
from tidemark.sources.store import export_feature_values, import_feature_values, training_slice


def train_model(labeled: DataFrame, as_of: Column | str, days: int = 30, **kw) -> IForestModel:
    """Fit on the last ``days`` of the labelled table (S-10 + I-1); vectors to 6 decimals unless ``digits`` says otherwise."""
    return fit_iforest(training_slice(labeled, as_of, days), key_cols=["pool_id", "hour_ts"], **{"digits": 6, **kw})


def batch_predict(inputs: DataFrame, model: IForestModel, threshold: float = 3.0) -> DataFrame:
    """Batch prediction of a feature table (S-11): score, decision, class."""
    return predict_class(decide(score(inputs, model), threshold), model)


@dataclass
class HourlyResult:
    exported: DataFrame
    store: DataFrame
    predictions: DataFrame
    labeled: DataFrame


def hourly_pipeline(
    labeled: DataFrame,
    store: DataFrame | None,
    model: IForestModel,
    as_of: Column | str,
    export_path: str | None = None,
    threshold: float = 3.0,
) -> HourlyResult:
    """Export the last hour, upsert it into the store, predict the exported entities
    from their latest stored values (feature by feature), and write the scores back onto the labelled rows."""
    exported = export_feature_values(labeled, as_of, path=export_path)
    if export_path is not None:
        imported = import_feature_values(labeled.sparkSession, f"{export_path.rstrip('/')}/*")
        exported = imported if imported is not None else exported
    store = exported if store is None else upsert(store, exported, ("entity_id", "feature_timestamp"))
    # restrict the store to the exported entities before the per-entity aggregation
    # (Catalyst does not push this semi-join below the aggregate by itself)
    wanted = exported.select("entity_id").distinct()
    latest = latest_per_feature(store.join(wanted, "entity_id", "left_semi"))
    preds = batch_predict(latest, model, threshold)
    scores = preds.select(F.col("entity_id").alias("pool_id"), F.col("feature_timestamp").alias("hour_ts"),
                          "anomaly_score")
    return HourlyResult(exported=exported, store=store, predictions=preds,
                        labeled=apply_scores(labeled, scores))


__all__ = ["FEATURES", "HourlyResult", "batch_predict", "hourly_pipeline", "train_model"]
