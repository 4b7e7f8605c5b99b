"""Additive exponential smoothing (level, damped trend, season) for all series and parameter sets.

One step of the recursion is affine in the state, so a stretch of the series is an affine map of
the state at its start and its squared error a quadratic form of it.  Chunks are therefore worked
off independently and only their small maps are chained per series: exact for series of any length.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.core import CHUNK, chunk_of, join_params

Params = tuple[float, float, float, float, int]  # alpha, beta, gamma, phi, number of parameters


def ses_grid(alphas: Sequence[float] = tuple(i / 10 for i in range(1, 10))) -> list[Params]:
    return [(a, 0.0, 0.0, 0.0, 2) for a in alphas]


def holt_grid(alphas=(.1, .3, .5, .8), betas=(.01, .1, .3), phis=(1.0,)) -> list[Params]:
    return [(a, a * b, 0.0, p, 4 + (p < 1)) for a, b, p in itertools.product(alphas, betas, phis)]


def winters_grid(alphas=(.05, .2, .5), betas=(0.0, .05, .2), gammas=(.05, .2), period: int = 7) -> list[Params]:
    return [(a, a * b, g * (1 - a), 1.0 if b else 0.0, 2 + 2 * (b > 0) + 1 + period)
            for a, b, g in itertools.product(alphas, betas, gammas)]


def auto_grid(period: int = 7) -> list[Params]:
    out = ses_grid((.05, .2, .5, .8)) + holt_grid((.1, .4, .8), (.05, .2), (1.0, .9))
    return out + (winters_grid(period=period) if period > 1 else [])


def _run(y, phase, m, par, counts=None):
    """Advance the affine state ``m`` (params, states, start-state coefficients + constant); errors of cells that do not
    count stay out of the sum."""
    a, b, g, phi = (par[:, [i]] for i in range(4))
    q = np.zeros((m.shape[0], m.shape[2], m.shape[2]))
    for yt, ph, count in zip(y, phase, np.ones(len(y), bool) if counts is None else counts):
        trend = phi * m[:, 1]
        base, s = m[:, 0] + trend, m[:, 2 + ph].copy()
        if np.isnan(yt):
            m[:, 0], m[:, 1] = base, trend
            continue
        e = -(base + s)
        e[:, -1] += yt
        if count:
            q += e[:, :, None] * e[:, None, :]
        m[:, 0], m[:, 1], m[:, 2 + ph] = base + a * e, trend + b * e, s + g * e
    return m, q


def _start(y, phase, period, par):
    """Start state from the first two cycles: mean level, slope between cycles, phase means."""
    s = np.zeros(period)
    if not np.isfinite(y).any():
        # Nothing is known at the start: from zero, the recursion adapts once values come.
        return np.zeros((len(par), 2 + period, 1))
    if period > 1:
        mean = np.nanmean(y)
        for p in range(period):
            v = y[phase == p]
            s[p] = np.nanmean(v) - mean if np.isfinite(v).any() else 0.0
        first, second = y[:period], y[period:2 * period]
        known = [np.nanmean(v) if np.isfinite(v).any() else None for v in (first, second)]
        slope = (known[1] - known[0]) / period if len(second) == period and None not in known else 0.0
        level = (mean if known[0] is None else known[0]) - slope * (period + 1) / 2
    else:
        known = y[np.isfinite(y)]
        slope = known[1] - known[0] if len(known) > 1 else 0.0
        level = known[0] - slope
    m = np.zeros((len(par), 2 + period, 1))
    m[:, 0, 0] = level
    m[:, 1, 0] = np.where(par[:, 3] > 0, slope, 0.0)
    seasonal = par[:, 2] > 0
    m[seasonal, 2:, 0] = s
    # A seasonless model starts on the plain first-cycle mean, a trendless one without a slope.
    m[par[:, 3] == 0, 0, 0] = np.nanmean(y[:period] if np.isfinite(y[:period]).any() else y)
    return m


def fit(train: DataFrame, y: str = "y", period: int = 1, grid: Sequence[Params] | None = None, *,
        keys: Sequence[str] = ("id",), size: int = CHUNK, skip: int = 0) -> DataFrame:
    """All parameter sets for all series: ``keys, p, n, sse, state, last_k``.

    ``n`` and ``sse`` leave out the first ``skip`` cells of a series, which only move the state (unless nothing is known after them).
    """
    par = np.array([g[:4] for g in (grid or auto_grid(period))], dtype=float)
    d = train.select(*keys, "k", F.col(y).cast("double").alias("_y"))
    b = d.groupBy(*keys).agg(F.min("k").alias("_k0"), F.max("k").alias("last_k"), F.count("_y").alias("n"))
    if skip:
        counted = join_params(d, b, keys).where(F.col("k") >= F.col("_k0") + skip).groupBy(*keys).agg(F.count("_y").alias("_counted"))
        b = b.join(counted, list(keys), "left").withColumn("_from", F.col("_k0") + F.when(F.col("_counted") > 0, skip).otherwise(0)).withColumn(
            "n", F.when(F.col("_counted") > 0, F.col("_counted")).otherwise(F.col("n"))).drop("_counted")
    head = join_params(d, b, keys).where(F.col("k") < F.col("_k0") + 2 * period)
    starts = head.groupBy(*keys, "_k0").agg(F.array_sort(F.collect_list(F.struct("k", "_y"))).alias("_h")).select(
        *[F.col(k).alias(f"_s_{k}") for k in keys], chunk_of("_k0", size).alias("_s_chunk"), F.transform("_h", lambda s: s["k"]).alias("_hk"),
        F.transform("_h", lambda s: F.coalesce(s["_y"], F.lit(float("nan")))).alias("_hy"))
    fields = ", ".join(f"`{k}` {train.schema[k].dataType.simpleString()}" for k in keys)
    names = list(keys)

    def piece(key, left, right):
        left = left.sort_values("k")
        phase = (left["k"].to_numpy() % period).astype(int)
        yv = left["_y"].to_numpy(dtype=float)
        if len(right):
            m = _start(np.asarray(right["_hy"].iloc[0], dtype=float), np.asarray(right["_hk"].iloc[0]) % period, period, par)
        else:
            m = np.broadcast_to(np.eye(2 + period, 3 + period), (len(par), 2 + period, 3 + period)).copy()
        m, q = _run(yv, phase, m, par, left["_counts"].to_numpy() if skip else None)
        return pd.DataFrame([(*key, i, m[i].ravel(), q[i].ravel()) for i in range(len(par))],
                            columns=[*names, "_chunk", "p", "m", "q"])

    left = d.withColumn("_chunk", chunk_of("k", size))
    if skip:
        left = join_params(left, b.select(*keys, "_from"), keys).withColumn("_counts", F.col("k") >= F.col("_from")).drop("_from")
    pieces = left.groupBy(*keys, "_chunk").cogroup(
        starts.groupBy(*[f"_s_{k}" for k in keys], "_s_chunk")).applyInPandas(
        piece, f"{fields}, _chunk bigint, p int, m array<double>, q array<double>")

    def chain(key, pdf):
        pdf = pdf.sort_values("_chunk")
        x, sse = None, 0.0
        for m, q in zip(pdf["m"], pdf["q"]):
            m, q = np.asarray(m), np.asarray(q)
            if x is None:
                x, sse = m, float(q[0])
            else:
                z = np.append(x, 1.0)
                sse += float(z @ q.reshape(len(z), len(z)) @ z)
                x = m.reshape(-1, len(z)) @ z
        return pd.DataFrame([(*key, sse, x)], columns=[*names, "p", "sse", "state"])

    done = pieces.groupBy(*keys, "p").applyInPandas(chain, f"{fields}, p int, sse double, state array<double>")
    return done.join(b.select(*keys, "n", "last_k"), list(keys))


def best(fits: DataFrame, grid: Sequence[Params], keys: Sequence[str] = ("id",), by: str = "aicc") -> DataFrame:
    """Lowest SSE or AICc per series, with the chosen parameters."""
    cols = F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(("alpha", "beta", "gamma", "phi", "npar"), g)])
                     for g in grid])
    # A series without a known value has no model.
    d = fits.where("n > 0").withColumn("_g", F.element_at(cols, F.col("p") + 1))
    kp = F.col("_g.npar") + 1
    aicc = (F.col("n") * F.log(F.greatest(F.col("sse"), F.lit(1e-12)) / F.col("n")) + 2 * kp
            + F.when(F.col("n") > kp + 1, 2 * kp * (kp + 1) / (F.col("n") - kp - 1)).otherwise(F.lit(1e9)))
    score = aicc if by == "aicc" else F.col("sse")
    one = d.groupBy(*keys).agg(F.min(F.struct(score.alias("score"), "p", "sse", "n", "last_k", "state", "_g")).alias("_b"))
    return one.select(*keys, "_b.score", "_b.p", "_b.sse", "_b.n", "_b.last_k", "_b.state", "_b._g.alpha",
                      "_b._g.beta", "_b._g.gamma", "_b._g.phi")


def project(model: DataFrame, future: DataFrame, period: int = 1, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Level + damped trend + season for every future stamp, NULL for a series without a model; plain expressions."""
    h = F.col("k") - F.col("last_k")
    steps = F.when(F.col("phi") == 1, h.cast("double")).when(F.col("phi") == 0, 0.0).otherwise(
        F.col("phi") * (1 - F.pow("phi", h)) / (1 - F.col("phi")))
    season = F.element_at("state", (F.pmod("k", F.lit(period)) + 3).cast("int"))
    value = F.col("state")[0] + steps * F.col("state")[1] + season
    m = model.select(*keys, "last_k", "state", "phi")
    return future.select(*keys, "k", "ts").join(m, list(keys), "left").select(*keys, "k", "ts", value.alias("prediction"))


def ets(train: DataFrame, future: DataFrame, period: int = 7, grid: Sequence[Params] | None = None,
        y: str = "y", by: str = "aicc", keys: Sequence[str] = ("id",)) -> DataFrame:
    g = list(grid or auto_grid(period))
    return project(best(fit(train, y, period, g, keys=keys), g, keys, by), future, period, keys)


def theta(train: DataFrame, future: DataFrame, y: str = "y", alphas: Sequence[float] = tuple(i / 10 for i in range(1, 10)),
          keys: Sequence[str] = ("id",)) -> DataFrame:
    """Half the linear trend, half the smoothed line of doubled curvature."""
    t = F.col("k").cast("double")
    line = train.groupBy(*keys).agg(F.regr_slope(F.col(y), t).alias("_b"), F.regr_intercept(F.col(y), t).alias("_a"))
    z = join_params(train, line, keys).select(*keys, "k", (2 * F.col(y) - F.col("_a") - F.col("_b") * t).alias("_z"))
    s = ets(z, future, 1, ses_grid(alphas), "_z", "sse", keys)
    return s.join(line, list(keys), "left").select(
        *keys, "k", "ts", (0.5 * F.col("prediction") + 0.5 * (F.col("_a") + F.col("_b") * t)).alias("prediction"))
