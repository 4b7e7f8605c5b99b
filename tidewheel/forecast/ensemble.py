"""Ensembles over forecast rows: average, median, weighted, rank loadings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.windows import min_rank


def average(forecast: DataFrame, kind: str = "mean", model_id: str = "ensemble") -> DataFrame:
    """Mean or median over models per (id, stamp); a cell holds one value per model."""
    fn = F.avg if kind == "mean" else F.median
    return forecast.groupBy("id", "k", "ts").agg(fn("prediction").alias("prediction")).withColumn(
        "model_id", F.lit(model_id))


def weighted(forecast: DataFrame, loadings: dict[str, float] | DataFrame, model_id: str = "weighted") -> DataFrame:
    """``sum(w p) / sum(w)``; loadings are a dict or a table ``model_id, loading``."""
    if isinstance(loadings, dict):
        m = F.create_map(*[F.lit(x) for kv in loadings.items() for x in (kv[0], float(kv[1]))])
        d = forecast.withColumn("loading", m[F.col("model_id")]).where(F.col("loading").isNotNull())
    else:
        on = [c for c in ("model_id", "id") if c in loadings.columns]
        d = forecast.join(loadings, on)
    return d.groupBy("id", "k", "ts").agg(
        F.try_divide(F.sum(F.col("loading") * F.col("prediction")), F.sum("loading")).alias("prediction")).withColumn(
        "model_id", F.lit(model_id))


def rank_loadings(acc: DataFrame, metric: str = "rmse", by: Sequence[str] = ()) -> DataFrame:
    """Best model gets the highest loading (rank of the descending metric)."""
    return min_rank(acc, metric, by=by, descending=metric != "rsq", name="loading").select(
        *by, "model_id", F.col("loading").cast("double").alias("loading"))
