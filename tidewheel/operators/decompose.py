"""Seasonal-trend decomposition, imputation and cleaning on padded panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.core import exact_quantiles, join_params, running, with_neighbours
from tidewheel.operators.windows import augment, loess, rolling_median, slide
from tidewheel.session import cut_lineage


def season_means(df: DataFrame, value: Column, period: int, keys: Sequence[str]) -> DataFrame:
    """Mean of ``value`` per phase, centred to mean zero over the phases of a key."""
    m = (df.groupBy(*keys, F.pmod("k", F.lit(period)).alias("_phase")).agg(F.avg(value).alias("_s")))
    # At most ``period`` rows per key here.
    return m.withColumn("_s", F.col("_s") - F.avg("_s").over(Window.partitionBy(*keys)))


def stl(df: DataFrame, y: str = "y", period: int = 7, *, keys: Sequence[str] = ("id",),
        trend: str = "mean", trend_period: int | None = None) -> DataFrame:
    """Add ``season, trend, remainder, seasadj``: two passes of (trend, phase means).

    ``trend`` is a centred rolling mean over one period, or ``"loess"``/``"median"`` over
    ``trend_period`` for the final pass.  The season is periodic.  The lineage is cut between the
    passes: both read the first pass twice, and callers stack decompositions.
    """
    d = df.withColumn("_phase", F.pmod("k", F.lit(period)))
    d = augment(d, keys=keys, _t=slide(y, period, F.avg, "center", partial=True))
    s1 = season_means(d, F.col(y) - F.col("_t"), period, keys)
    d = d.drop("_t").join(s1, [*keys, "_phase"]).withColumn("_sa", F.col(y) - F.col("_s")).drop("_s")
    d = cut_lineage(d)
    width = trend_period or period
    final = {"mean": lambda: slide("_sa", width, F.avg, "center", partial=True),
             "median": lambda: slide("_sa", width, rolling_median, "center", partial=True),
             "loess": lambda: loess("_sa", width, 1)}[trend]()
    d = augment(d, keys=keys, trend=final)
    s2 = season_means(d, F.col(y) - F.col("trend"), period, keys)
    return (d.join(s2, [*keys, "_phase"]).withColumnRenamed("_s", "season")
             .withColumn("remainder", F.col(y) - F.col("season") - F.col("trend"))
             .withColumn("seasadj", F.col(y) - F.col("season")).drop("_phase", "_sa"))


def multi_stl(df: DataFrame, y: str = "y", periods: Sequence[int] = (7, 30, 182), *, keys: Sequence[str] = ("id",),
              passes: int = 2) -> DataFrame:
    """Add ``season_<p>`` for every period, ``trend, remainder, seasadj``: seasons found together by backfitting.

    Each pass goes through the periods from the shortest on and takes a period's season from the series without the other
    seasons as they stand; trend and remainder come from the last fit, so all components add up to the series.  Periods that a series does not
    cover twice get a season of zeros for it.  Rows should be one per grid cell.
    """
    keys, periods = list(keys), sorted(set(periods))
    names = [f"season_{p}" for p in periods]
    span = df.groupBy(*keys).agg((F.max("k") - F.min("k") + 1).alias("_span"))
    d = join_params(df.withColumns({n: F.lit(0.0) for n in names}), span, keys)
    turns = [(p, n) for _ in range(passes) for p, n in zip(periods, names)]
    for turn, (p, n) in enumerate(turns, 1):
        rest = F.col(y).cast("double")
        for other in names:
            rest = rest - F.col(other) if other != n else rest
        d = stl(d.withColumn("_rest", rest), "_rest", p, keys=keys)
        covered = F.col("_span") >= 2 * p
        d = d.withColumns({n: F.when(covered, F.col("season")).otherwise(0.0), "remainder": F.col("remainder") + F.when(covered, 0.0).otherwise(F.col("season"))})
        d = cut_lineage(d.drop("season", "seasadj", "_rest", *(["trend", "remainder"] if turn < len(turns) else [])))
    adjusted = F.col(y).cast("double")
    for n in names:
        adjusted = adjusted - F.col(n)
    return d.withColumn("seasadj", adjusted).drop("_span")


def _between(prev: Column, nxt: Column) -> Column:
    """Value at ``k`` on the line between two known points; the nearest one at the ends."""
    t = (F.col("k") - prev["k"]) / (nxt["k"] - prev["k"])
    return (F.when(prev.isNull(), nxt["y"]).when(nxt.isNull() | (nxt["k"] == prev["k"]), prev["y"])
             .otherwise(prev["y"] + t * (nxt["y"] - prev["y"])))


def impute(df: DataFrame, y: str = "y", period: int = 1, out: str | None = None, *,
           keys: Sequence[str] = ("id",)) -> DataFrame:
    """Fill NULLs: linear for ``period=1``, else linear on the seasonally adjusted series."""
    out = out or y
    d = with_neighbours(df, y, keys=keys).withColumn("_lin", _between(F.col("_prev"), F.col("_next")))
    d = d.drop("_prev", "_next")
    if period <= 1:
        return d.withColumn(out, F.coalesce(F.col(y), F.col("_lin"))).drop("_lin")
    d = stl(d, "_lin", period, keys=keys).withColumn("_adj", F.col(y) - F.col("season"))
    d = with_neighbours(d, "_adj", keys=keys)
    filled = F.coalesce(F.col(y), _between(F.col("_prev"), F.col("_next")) + F.col("season"))
    return d.withColumn(out, filled).drop("_prev", "_next", "_adj", "_lin", "season", "trend",
                                          "remainder", "seasadj")


def remainder_limits(d: DataFrame, width: float, keys: Sequence[str]) -> DataFrame:
    """Per key ``[q1 - width * iqr, q3 + width * iqr]`` of the remainder."""
    q = exact_quantiles(d, "remainder", {"q1": .25, "q3": .75}, keys=keys)
    iqr = F.col("q3") - F.col("q1")
    return q.select(*keys, (F.col("q1") - width * iqr).alias("rem_l1"),
                    (F.col("q3") + width * iqr).alias("rem_l2"))


def outlier_flags(df: DataFrame, y: str = "y", period: int = 7, width: float = 3.0, *,
                  keys: Sequence[str] = ("id",), trend: str = "mean") -> DataFrame:
    """``stl`` columns plus ``outlier`` (0/1): remainder beyond ``width`` IQRs."""
    d = stl(df, y, period, keys=keys, trend=trend)
    return join_params(d, remainder_limits(d, width, keys), keys).withColumn(
        "outlier", F.when(F.col("remainder").between(F.col("rem_l1"), F.col("rem_l2")), 0).otherwise(1))


def clean(df: DataFrame, y: str = "y", period: int = 7, out: str | None = None, *,
          keys: Sequence[str] = ("id",)) -> DataFrame:
    """Replace remainder outliers by interpolation; fill NULLs first."""
    out = out or y
    d = cut_lineage(impute(df, y, period, "_full", keys=keys))
    f = cut_lineage(outlier_flags(d, "_full", period, 3.0, keys=keys))
    f = f.withColumn("_keep", F.when(F.col("outlier") == 0, F.col("_full")))
    f = f.drop("season", "trend", "remainder", "seasadj", "rem_l1", "rem_l2", "outlier")
    return impute(f, "_keep", period, "_clean", keys=keys).withColumn(out, F.col("_clean")).drop(
        "_full", "_keep", "_clean")


def anomaly_diagnostics(df: DataFrame, y: str = "y", period: int = 7, alpha: float = 0.05,
                        max_anomalies: float = 0.2, *, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Remainder limits at ``0.15 / alpha`` IQRs, flag, recomposed bands.

    At most ``max_anomalies`` of a series' points are flagged, the farthest outside first.
    """
    d = cut_lineage(stl(df, y, period, keys=keys))
    d = join_params(d, remainder_limits(d, 0.15 / alpha, keys), keys)
    excess = F.greatest(F.col("rem_l1") - F.col("remainder"), F.col("remainder") - F.col("rem_l2"))
    d = d.withColumn("_x", excess)
    n = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col("_x") > 0, 1)).alias("_f"))
    # Only ids with more flags than allowed need a ranking, and only of their flagged rows.
    over = n.where(F.col("_f") > F.floor(F.col("_n") * max_anomalies))
    flagged = cut_lineage(d.where(F.col("_x") > 0).join(over, list(keys)).select(*keys, "k", "_n", (-F.col("_x")).alias("_d")))
    dropped = (running(flagged, "_d", rank="_r", keys=keys)
               .where(F.col("_r") > F.floor(F.col("_n") * max_anomalies)).select(*keys, "k", F.lit(1).alias("_cap")))
    j = d.join(dropped, [*keys, "k"], "left")
    return (j.withColumn("anomaly", F.when((F.col("_x") > 0) & F.col("_cap").isNull(), 1).otherwise(0))
             .withColumn("band_lower", F.col("season") + F.col("trend") + F.col("rem_l1"))
             .withColumn("band_upper", F.col("season") + F.col("trend") + F.col("rem_l2"))
             .withColumn("cleaned", F.when(F.col("anomaly") == 1, F.col("season") + F.col("trend")).otherwise(F.col(y)))
             .drop("_x", "_cap"))
