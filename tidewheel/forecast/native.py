"""Forecasters that are plain aggregates: ``f(train, future) -> id, k, ts, prediction``.

Every future row comes back; the prediction of a series (or phase) without training rows is NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.core import join_params

_OUT = ("id", "k", "ts", "prediction")


def naive(train: DataFrame, future: DataFrame, y: str = "y", keys: Sequence[str] = ("id",)) -> DataFrame:
    """Last observed value."""
    p = train.where(F.col(y).isNotNull()).groupBy(*keys).agg(F.max_by(y, "k").cast("double").alias("prediction"))
    return future.select(*keys, "k", "ts").join(p, list(keys), "left").select(*keys, "k", "ts", "prediction")


def last_cells(train: DataFrame, n: int, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Rows of the last ``n`` cells of every series, by comparing ``k`` with the last one."""
    last = train.groupBy(*keys).agg(F.max("k").alias("_last"))
    return join_params(train, last, keys).where(F.col("k") > F.col("_last") - n)


def seasonal_naive(train: DataFrame, future: DataFrame, period: int, y: str = "y",
                   keys: Sequence[str] = ("id",)) -> DataFrame:
    """Value of the same phase in the last full cycle."""
    phase = F.pmod("k", F.lit(period))
    cyc = last_cells(train, period, keys).select(*keys, phase.alias("_p"), F.col(y).cast("double").alias("prediction"))
    return (future.select(*keys, "k", "ts", phase.alias("_p")).join(cyc, [*keys, "_p"], "left")
                  .select(*keys, "k", "ts", "prediction"))


def window(train: DataFrame, future: DataFrame, size: int = 7, fn: Callable[[Column], Column] = F.avg,
           y: str = "y", keys: Sequence[str] = ("id",)) -> DataFrame:
    """Any aggregate of the last ``size`` values."""
    p = last_cells(train, size, keys).groupBy(*keys).agg(fn(F.col(y)).cast("double").alias("prediction"))
    return future.select(*keys, "k", "ts").join(p, list(keys), "left").select(*keys, "k", "ts", "prediction")


def window_weighted(train: DataFrame, future: DataFrame, weights: Sequence[float] = (.1, .3, .6), y: str = "y",
                    keys: Sequence[str] = ("id",)) -> DataFrame:
    """Weighted sum of the last values, the last weight on the newest."""
    n = len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("k") - F.col("_last") + n).cast("int"))
    p = last_cells(train, n, keys).groupBy(*keys).agg(F.sum(F.col(y) * w).alias("prediction"))
    return future.select(*keys, "k", "ts").join(p, list(keys), "left").select(*keys, "k", "ts", "prediction")
