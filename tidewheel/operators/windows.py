"""Lags, differences, rolling functions and local regression over chunk windows.

Everything looks along the positions, not the rows: a missing cell is a NULL for lags and an absent value for windows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.core import CHUNK, at_lag, halo_select


@dataclass(frozen=True)
class Feature:
    """A windowed column: how far it looks back and ahead, and how to build it over a window."""

    before: int
    after: int
    build: Callable


def lag(y: str, k: int) -> Feature:
    """Value ``k`` cells back; a negative ``k`` looks ahead."""
    return Feature(max(k, 0), max(-k, 0), lambda w: at_lag(y, k, w))


def diff(y: str, k: int = 1, order: int = 1) -> Feature:
    def build(w):
        out = F.col(y)
        for i in range(1, order + 1):
            out = out + float((-1) ** i * comb(order, i)) * at_lag(y, i * k, w)
        return out
    return Feature(k * order, 0, build)


def reach(period: int, align: str = "right") -> tuple[int, int]:
    """Rows before and after the current one; an even centred window leans ahead."""
    if align == "right":
        return period - 1, 0
    if align == "left":
        return 0, period - 1
    return (period - 1) // 2, period // 2


def rolling_median(c: Column) -> Column:
    """Median that is allowed over a row frame."""
    return F.percentile(c, F.lit(0.5))


def slide(y: str, period: int, fn: Callable[[Column], Column] = F.avg, align: str = "right",
          partial: bool = False) -> Feature:
    """Rolling ``fn`` over ``period`` cells; ``partial=False`` gives NULL where the window is cut or has a gap."""
    b, a = reach(period, align)

    def build(w):
        frame = w.rangeBetween(-b, a)
        value = fn(F.col(y)).over(frame)
        return value if partial else F.when(F.count(F.lit(1)).over(frame) == period, value)
    return Feature(b, a, build)


def weighted_tail(y: str, weights: Sequence[float]) -> Feature:
    """Weighted sum of the last ``len(weights)`` values, the last weight on the current row."""
    n = len(weights)

    def build(w):
        out = F.col(y) * weights[-1]
        for i in range(1, n):
            out = out + at_lag(y, i, w) * weights[n - 1 - i]
        return out
    return Feature(n - 1, 0, build)


def loess(y: str, period: int, degree: int = 1) -> Feature:
    """Local polynomial fit (tricube weights, degree 0, 1 or 2) on the ``period // 2`` cells each side.

    On a regular grid the weights depend on the offset alone, so each point needs only a few sums.
    """
    half = max(1, period // 2)

    def build(w):
        near = F.collect_list(F.when(F.col(y).isNotNull(), F.struct(
            F.col("k").cast("double").alias("k"), F.col(y).cast("double").alias("y")))
        ).over(w.rangeBetween(-half, half))
        zero = F.struct(*[F.lit(0.0).alias(n) for n in ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2")])
        k = F.col("k").cast("double")

        def add(acc, p):
            d = p["k"] - k
            u = F.abs(d) / (half + 1.0)
            v = 1 - u * u * u
            wt = F.when(u < 1, v * v * v).otherwise(0.0)
            d2 = d * d
            high = degree == 2
            return F.struct(
                (acc["s0"] + wt).alias("s0"), (acc["s1"] + wt * d).alias("s1"),
                (acc["s2"] + wt * d2).alias("s2"),
                (acc["s3"] + wt * d2 * d if high else acc["s3"]).alias("s3"),
                (acc["s4"] + wt * d2 * d2 if high else acc["s4"]).alias("s4"),
                (acc["t0"] + wt * p["y"]).alias("t0"), (acc["t1"] + wt * d * p["y"]).alias("t1"),
                (acc["t2"] + wt * d2 * p["y"] if high else acc["t2"]).alias("t2"))

        def finish(a):
            flat = a["t0"] / a["s0"]
            if degree == 0:
                return flat
            det1 = a["s0"] * a["s2"] - a["s1"] * a["s1"]
            line = F.when(det1 > 1e-9, (a["s2"] * a["t0"] - a["s1"] * a["t1"]) / det1).otherwise(flat)
            if degree == 1:
                return line
            c0 = a["s2"] * a["s4"] - a["s3"] * a["s3"]
            c1 = a["s1"] * a["s4"] - a["s2"] * a["s3"]
            c2 = a["s1"] * a["s3"] - a["s2"] * a["s2"]
            det2 = a["s0"] * c0 - a["s1"] * c1 + a["s2"] * c2
            return F.when(F.abs(det2) > 1e-9, (a["t0"] * c0 - a["t1"] * c1 + a["t2"] * c2) / det2
                          ).otherwise(line)

        return F.when(F.size(near) > 0, F.aggregate(near, zero, add, finish))
    return Feature(half, half, build)


def augment(df: DataFrame, /, *, keys: Sequence[str] = ("id",), pos: str = "k", size: int = CHUNK,
            **features: Feature) -> DataFrame:
    """Add all ``features`` in one pass: one shuffle, one sort, whatever their number."""
    before = max(f.before for f in features.values())
    after = max(f.after for f in features.values())
    return halo_select(df, lambda w: {n: f.build(w) for n, f in features.items()}, before, after,
                       keys=keys, pos=pos, size=size)


def augment_lags(df: DataFrame, cols: Sequence[str], lags: Sequence[int], **kw) -> DataFrame:
    return augment(df, **kw, **{f"{c}_lag{k}" if k >= 0 else f"{c}_lead{-k}": lag(c, k)
                                for c in cols for k in lags})


def augment_slidify(df: DataFrame, y: str, periods: Sequence[int], fn=F.avg, align: str = "right",
                    partial: bool = True, **kw) -> DataFrame:
    return augment(df, **kw, **{f"{y}_roll_{p}": slide(y, p, fn, align, partial) for p in periods})


def min_rank(df: DataFrame, metric: str, *, by: Sequence[str] = (), descending: bool = False,
             name: str = "rank") -> DataFrame:
    """Rank with ties on a metric table (one row per model and id)."""
    w = Window.partitionBy(*by).orderBy(F.desc(metric) if descending else F.asc(metric))
    return df.withColumn(name, F.rank().over(w))
