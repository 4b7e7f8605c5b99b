"""How often to difference: a stationarity statistic and the strength of the season, per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.core import CHUNK, at_lag, chunk_of, halo_select, join_params
from tidewheel.operators.decompose import stl
from tidewheel.operators.windows import augment, diff
from tidewheel.session import cut_lineage

# 5 % critical value of the level-stationarity statistic, and the seasonal strength from which a seasonal difference is taken.
CRITICAL, STRONG = 0.463, 0.64


def kpss(df: DataFrame, y: str = "y", *, keys: Sequence[str] = ("id",), size: int = CHUNK) -> DataFrame:
    """``keys, n, lags, stat``: sum of squared partial sums over n**2 times the long-run variance (Bartlett weights).

    ``lags = floor(4 (n / 100) ** 0.25)``.  Partial sums of a chunk come from one window; a chunk that starts at total o adds
    ``m o**2 + 2 o sum(s) + sum(s**2)``, so only three numbers a chunk are chained and a series of any length is many tasks' work.
    NULLs are left out of the sums; ``stat`` is NULL for constant and empty series.  Rows should be one per grid cell.
    """
    keys = list(keys)
    known = df.where(F.col(y).isNotNull()).select(*keys, "k", F.col(y).cast("double").alias("_y"))
    m = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("_m"))
    m = cut_lineage(m.withColumn("lags", F.floor(4 * F.pow(F.col("n") / 100, F.lit(0.25))).cast("int")))
    most = m.agg(F.max("lags")).first()[0] or 0
    d = join_params(known, m, keys).select(*keys, "k", (F.col("_y") - F.col("_m")).alias("_e"))
    if most:
        d = halo_select(d, lambda w: {f"_g{j}": F.col("_e") * at_lag("_e", j, w) for j in range(1, most + 1)}, most, keys=keys, size=size)
    d = d.withColumn("_chunk", chunk_of("k", size))
    past = Window.partitionBy(*keys, "_chunk").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    per = d.withColumn("_s", F.sum("_e").over(past)).groupBy(*keys, "_chunk").agg(
        F.count(F.lit(1)).alias("_c"), F.sum("_e").alias("_t"), F.sum("_s").alias("_a"), F.sum(F.col("_s") * F.col("_s")).alias("_b"), F.sum(F.col("_e") * F.col("_e")).alias("_g0"),
        *[F.sum(f"_g{j}").alias(f"_g{j}") for j in range(1, most + 1)])
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    o = F.coalesce(F.sum("_t").over(before), F.lit(0.0))
    per = per.withColumn("_o", o).withColumn("_q", F.col("_c") * F.col("_o") * F.col("_o") + 2 * F.col("_o") * F.col("_a") + F.col("_b"))
    one = per.groupBy(*keys).agg(F.sum("_q").alias("_q"), *[F.coalesce(F.sum(f"_g{j}"), F.lit(0.0)).alias(f"_g{j}") for j in range(most + 1)])
    j = one.join(m, keys)
    long_run = F.col("_g0")
    for i in range(1, most + 1):
        long_run = long_run + F.when(F.col("lags") >= i, 2 * (1 - F.lit(i) / (F.col("lags") + 1)) * F.col(f"_g{i}")).otherwise(0.0)
    n = F.col("n").cast("double")
    flat = F.col("_g0") <= 1e-18 * n * (1 + F.col("_m") * F.col("_m"))
    return j.select(*keys, "n", "lags", F.when(~flat & (long_run > 0), F.col("_q") / (n * long_run)).alias("stat"))


def seasonal_strength(df: DataFrame, y: str = "y", period: int = 7, *, keys: Sequence[str] = ("id",)) -> DataFrame:
    """``keys, strength``: 1 - var(remainder) / var(season + remainder), at least 0."""
    d = stl(df.select(*keys, "k", "ts", F.col(y).cast("double").alias("y")), "y", period, keys=keys)
    a = d.groupBy(*keys).agg(F.var_pop("remainder").alias("_r"), F.var_pop(F.col("y") - F.col("trend")).alias("_d"))
    return a.select(*keys, F.when(F.col("_d") > 0, F.greatest(F.lit(0.0), 1 - F.col("_r") / F.col("_d"))).alias("strength"))


def choose(df: DataFrame, y: str = "y", period: int = 7, *, keys: Sequence[str] = ("id",), max_d: int = 2, critical: float = CRITICAL,
           strong: float = STRONG) -> DataFrame:
    """``keys, d, seasonal_d, strength, stat``: one seasonal difference where the season is strong, then as many plain ones as stationarity asks for.

    ``stat`` is the statistic before plain differencing.  Series too short or constant for a statistic are taken as stationary.
    """
    keys = list(keys)
    base = df.select(*keys, "k", "ts", F.col(y).cast("double").alias("_y"))
    season = seasonal_strength(base, "_y", period, keys=keys) if period > 1 else base.select(*keys).distinct().withColumn("strength", F.lit(None).cast("double"))
    span = base.groupBy(*keys).agg((F.max("k") - F.min("k") + 1).alias("_span"))
    season = cut_lineage(season.join(span, keys).select(*keys, "strength", F.coalesce((F.col("strength") > strong) & (F.col("_span") > 2 * period), F.lit(False)).cast("int").alias("seasonal_d")))
    w = join_params(augment(base, keys=keys, _s=diff("_y", period)), season, keys).select(*keys, "k", F.when(F.col("seasonal_d") == 1, F.col("_s")).otherwise(F.col("_y")).alias("_w0"))
    w = cut_lineage(augment(w, keys=keys, **{f"_w{i}": diff("_w0", 1, i) for i in range(1, max_d)}) if max_d > 1 else w)
    out = season
    for i in range(max_d):
        out = out.join(kpss(w, f"_w{i}", keys=keys).select(*keys, F.col("stat").alias(f"_k{i}")), keys, "left")
    need = F.lit(max_d)
    for i in reversed(range(max_d)):
        need = F.when(F.coalesce(F.col(f"_k{i}") <= critical, F.lit(True)), F.lit(i)).otherwise(need)
    return out.select(*keys, need.cast("int").alias("d"), "seasonal_d", "strength", F.col("_k0").alias("stat") if max_d else F.lit(None).cast("double").alias("stat"))

