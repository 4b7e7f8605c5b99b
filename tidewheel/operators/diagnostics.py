"""Autocorrelation, cross-correlation, seasonal tables and box statistics."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidewheel.core import at_lag, exact_quantiles, halo_select, join_params, step_index, step_start
from tidewheel.operators.features import signature


def acf(df: DataFrame, y: str = "y", max_lag: int = 28, *, keys: Sequence[str] = ("id",)) -> DataFrame:
    """``keys, lag, acf, bar`` for lags 0..max_lag; bar = 1.96 / sqrt(n).

    All lags come from one window pass and one aggregate with map-side partial sums.
    """
    return _cross(df, y, [y], range(0, max_lag + 1), keys).select(*keys, "lag", F.col("ccf").alias("acf"), "bar")


def ccf(df: DataFrame, y: str, others: Sequence[str], max_lag: int, *,
        keys: Sequence[str] = ("id",)) -> DataFrame:
    """``keys, series, lag, ccf, bar``: correlation of y(t) with x(t - lag), lags -L..L."""
    return _cross(df, y, list(others), range(-max_lag, max_lag + 1), keys)


def _cross(df, y, others, lags, keys):
    names = sorted({y, *others})
    m = df.groupBy(*keys).agg(*[F.avg(c).alias(f"_m_{c}") for c in names])
    d = join_params(df.select(*keys, "k", *names), m, keys)
    d = d.select(*keys, "k", *[(F.col(c) - F.col(f"_m_{c}")).alias(c) for c in names])
    hi, lo = max(max(lags), 0), max(-min(lags), 0)
    d = halo_select(d, lambda w: {f"_{i}_{j}": at_lag(x, l, w)
                                  for i, x in enumerate(others) for j, l in enumerate(lags)},
                    hi, lo, keys=keys)
    sums = [F.sum(F.col(y) * F.col(f"_{i}_{j}")).alias(f"_s{i}_{j}")
            for i in range(len(others)) for j in range(len(lags))]
    a = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *sums,
                             *[F.sum(F.col(c) * F.col(c)).alias(f"_q_{c}") for c in names])
    rows = [F.struct(F.lit(x).alias("series"), F.lit(l).alias("lag"),
                     F.try_divide(F.col(f"_s{i}_{j}"), F.sqrt(F.col(f"_q_{y}") * F.col(f"_q_{x}"))).alias("ccf"))
            for i, x in enumerate(others) for j, l in enumerate(lags)]
    return a.select(*keys, (1.96 / F.sqrt("_n")).alias("bar"), F.inline(F.array(*rows))).select(
        *keys, "series", "lag", "ccf", "bar")


@F.pandas_udf(ArrayType(DoubleType()))
def _durbin_levinson(r: pd.Series) -> pd.Series:
    def one(rho):
        rho = np.asarray(rho, dtype=float)
        if not np.isfinite(rho).all():  # constant series
            return [None] * (len(rho) - 1)
        phi, out = np.zeros(0), []
        for k in range(1, len(rho)):
            num = rho[k] - phi @ rho[k - 1:0:-1] if k > 1 else rho[1]
            den = 1.0 - phi @ rho[1:k] if k > 1 else 1.0
            a = num / den
            phi = np.append(phi - a * phi[::-1], a)
            out.append(a)
        return out
    return r.map(one)


def pacf(df: DataFrame, y: str = "y", max_lag: int = 28, *, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Partial autocorrelations 1..max_lag, solved from the short acf array of each key."""
    a = acf(df, y, max_lag, keys=keys)
    arr = a.groupBy(*keys, "bar").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda s: s["acf"]).alias("_r"))
    return (arr.select(*keys, "bar", F.posexplode(_durbin_levinson("_r")).alias("lag", "pacf"))
               .select(*keys, (F.col("lag") + 1).alias("lag"), "pacf", "bar"))


def seasonal_diagnostics(df: DataFrame, y: str = "y", ts: str = "ts", *, keys: Sequence[str] = ("id",),
                         parts: Sequence[str] = ("hour", "wday", "week", "month", "quarter", "year")) -> DataFrame:
    """Distribution of the value by calendar part: count, mean and quartiles."""
    s = signature(ts)
    rows = F.array(*[F.struct(F.lit(p).alias("part"), s[p].cast("int").alias("level")) for p in parts])
    d = df.select(*keys, F.col(y).cast("double").alias("_y"), F.inline(rows))
    g = [*keys, "part", "level"]
    base = d.groupBy(*g).agg(F.count("_y").alias("n"), F.avg("_y").alias("mean"))
    q = exact_quantiles(d, "_y", {"q1": .25, "median": .5, "q3": .75}, keys=g)
    return base.join(q, g)


def box_stats(df: DataFrame, by: str, y: str = "y", ts: str = "ts", *,
              keys: Sequence[str] = ("id",)) -> tuple[DataFrame, DataFrame]:
    """Box-plot table per period (quartiles, whiskers at the last value inside 1.5 IQR, mean) and
    the rows outside the whiskers."""
    d = df.withColumn("period", step_start(step_index(ts, by), by))
    g = [*keys, "period"]
    q = exact_quantiles(d, y, {"q1": .25, "median": .5, "q3": .75}, keys=g)
    j = d.join(q, g).withColumn("_iqr", F.col("q3") - F.col("q1"))
    inside = F.col(y).between(F.col("q1") - 1.5 * F.col("_iqr"), F.col("q3") + 1.5 * F.col("_iqr"))
    stats = j.groupBy(*g, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(y))).alias("lower"), F.max(F.when(inside, F.col(y))).alias("upper"),
        F.avg(y).alias("mean"), F.count(y).alias("n"), F.count(F.when(~inside, 1)).alias("n_out"))
    return stats, j.where(~inside).select(*keys, ts, "period", y)


def period_smoother(stats: DataFrame, what: str = "median", *, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Change of the period mean/median against the period before (one row per period)."""
    w = Window.partitionBy(*keys).orderBy("period")
    return stats.select(*keys, "period", what, (F.col(what) - F.lag(what).over(w)).alias("change"))
