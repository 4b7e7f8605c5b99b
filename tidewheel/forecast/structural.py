"""Forecasters built from regressors plus smoothing: xreg models, multi-season, additive
changepoint model, decomposition + smoothing, temporal hierarchy."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.core import join_params, step_start
from tidewheel.forecast import arima as A
from tidewheel.forecast import linear as L
from tidewheel.forecast import smoothing as S
from tidewheel.forecast.native import seasonal_naive
from tidewheel.functions import scalars as SC
from tidewheel.operators import decompose as DC
from tidewheel.operators import transforms as X
from tidewheel.operators.features import fourier_terms
from tidewheel.session import cut_lineage

Base = Callable[[DataFrame, DataFrame], DataFrame]  # forecasts column ``y``


def with_regressors(train: DataFrame, future: DataFrame, xs: Sequence[str], base: Base, y: str = "y",
                    ridge: Sequence[float] | float = 1e-6, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Regress on ``xs`` (present in both frames), forecast the residual with ``base``, add up."""
    model = cut_lineage(L.fit(train, y, xs, keys=keys, ridge=ridge))
    # An unknown residual stays as a NULL cell: later lags go by position.
    res = train.join(model.select(*keys, F.col("coef").alias("_coef"), F.col("intercept").alias("_b0")), list(keys), "left")
    res = res.select(*keys, "k", "ts", (F.col(y) - L.value_of("_coef", "_b0", xs)).alias("y"))
    rest = base(cut_lineage(res), future)
    lin = L.predict(future, model, xs, keys=keys, out="_p").select(*keys, "k", "_p")
    # Rows are matched by stamp, not by position: a regressor may be unknown, then the prediction is NULL.
    return (future.select(*keys, "k", "ts").join(rest.select(*keys, "k", "prediction"), [*keys, "k"], "left").join(lin, [*keys, "k"], "left")
            .select(*keys, "k", "ts", (F.col("prediction") + F.col("_p")).alias("prediction")))


def smoothing_or_arima(train: DataFrame, future: DataFrame, period: int = 7, y: str = "y", orders: Sequence[A.Order] | None = None,
                       horizon: int | None = None, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Per series the better of automatic smoothing and automatic ARIMA (or the given ``orders``).

    Both are scored by AICc on the same cells: those after the longest burn-in that any order needs.  (With gaps ARIMA lacks
    some more; scores are per observation.)  Where only one of them has a model, it is taken; without either, the stamps stay with
    a NULL prediction.
    """
    grid = S.auto_grid(period)
    every = orders or [o for d in range(3) for D in range(2) for o in A.candidates(d, D, seasonal=period > 1)]
    skip = A.burn_in(every, period)
    ets = cut_lineage(S.best(S.fit(train, y, period, grid, keys=keys, skip=skip), grid, keys))
    ari = A.auto_search(train, future, period, y, keys, horizon, skip) if orders is None else A.search(train, future, orders, period, y, keys, horizon, skip)
    ari = cut_lineage(ari)
    pick = ets.select(*keys, (F.col("score") / F.col("n")).alias("_s")).join(ari.select(*keys, F.col("score").alias("_a")), list(keys), "full")
    by_ets = pick.where("_s IS NOT NULL AND (_a IS NULL OR _s <= _a)").select(*keys)
    one = S.project(ets, future, period, keys).join(by_ets, list(keys), "left_semi")
    two = A.along(ari, future, keys).join(by_ets, list(keys), "left_anti")
    return one.unionByName(two)


def multi_season(train: DataFrame, future: DataFrame, periods: Sequence[float] = (7, 30, 365), order: int = 3, y: str = "y",
                 box_cox: bool = False, horizon: int | None = None) -> DataFrame:
    """(Box-Cox,) trend and Fourier terms per period, autoregression on what is left."""
    cols = {**fourier_terms(periods, order), "_trend": F.col("k") / 1000.0}
    d = train
    if box_cox:
        lam = X.box_cox_lambda(train, y)
        d = join_params(train, lam.select("id", "lambda")).withColumn(y, SC.box_cox(y, "lambda")).drop("lambda")
    base = lambda t, f: A.forecast(t, f, [A.Order(2, 0, 0)], 7, horizon=horizon)
    fc = with_regressors(d.withColumns(cols), future.withColumns(cols), list(cols), base, y)
    if box_cox:
        fc = join_params(fc, lam.select("id", "lambda")).withColumn("prediction", SC.box_cox_inv("prediction", "lambda")).drop("lambda")
    return fc


def additive_terms(bounds: DataFrame, df: DataFrame, n_change: int, change_range: float, seasons: dict[float, int],
                   keys: Sequence[str] = ("id",)) -> tuple[DataFrame, list[str], list[float]]:
    """Piecewise-linear trend hinges on the training range plus Fourier terms."""
    u = F.coalesce(F.try_divide(F.col("k") - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0))
    cols = {"_u": u}
    for i in range(1, n_change + 1):
        cols[f"_c{i}"] = F.greatest(u - change_range * i / (n_change + 1), F.lit(0.0))
    for p, order in seasons.items():
        cols.update({f"_{n}": c for n, c in fourier_terms([p], order).items()})
    penalty = [0.05 if n.startswith("_c") and n[2:].isdigit() else 1e-6 for n in cols]
    return join_params(df, bounds, keys).withColumns(cols).drop("_lo", "_hi"), list(cols), penalty


def additive(train: DataFrame, future: DataFrame, *, n_change: int = 25, change_range: float = 0.8,
             seasons: dict[float, int] | None = None, xs: Sequence[str] = (), y: str = "y",
             keys: Sequence[str] = ("id",), with_fitted: bool = False):
    """Ridge-penalised changepoint trend + seasons (+ event regressors)."""
    seasons = {7: 3, 365.25: 6} if seasons is None else seasons
    bounds = train.groupBy(*keys).agg(F.min("k").alias("_lo"), F.max("k").alias("_hi"))
    t, cols, pen = additive_terms(bounds, train, n_change, change_range, seasons, keys)
    f, _, _ = additive_terms(bounds, future, n_change, change_range, seasons, keys)
    names, pen = [*cols, *xs], [*pen, *[1e-6] * len(xs)]
    model = cut_lineage(L.fit(t, y, names, keys=keys, ridge=pen))
    fc = L.predict(f, model, names, keys=keys).select(*keys, "k", "ts", "prediction")
    if not with_fitted:
        return fc
    return fc, L.predict(t, model, names, keys=keys, out="fitted").select(*train.columns, "fitted")


def stl_forecast(train: DataFrame, future: DataFrame, base: Base, periods: Sequence[int] = (7,), y: str = "y",
                 keys: Sequence[str] = ("id",), xs: Sequence[str] = ()) -> DataFrame:
    """Take out the seasons of all ``periods`` (found together), forecast the rest with ``base``, add the last cycles back.

    ``base`` is any forecaster of a column ``y``: automatic smoothing, automatic ARIMA ...; with ``xs`` (in both frames) the rest
    is first regressed on them.
    """
    dec = cut_lineage(DC.multi_stl(train.select(*keys, "k", "ts", F.col(y).cast("double").alias("y"), *xs), "y", periods, keys=keys))
    season = None
    for p in sorted(set(periods)):
        s = seasonal_naive(dec, future, p, f"season_{p}", keys).select(*keys, "k", "prediction")
        season = s if season is None else season.unionByName(s)
    total = season.groupBy(*keys, "k").agg(F.sum("prediction").alias("_s"), F.count("prediction").alias("_n")).where(F.col("_n") == len(set(periods)))
    rest = dec.select(*keys, "k", "ts", F.col("seasadj").alias("y"), *xs)
    fc = with_regressors(rest, future, xs, base, keys=keys) if xs else base(rest, future)
    return fc.join(total, [*keys, "k"], "left").select(*keys, "k", "ts", (F.col("prediction") + F.col("_s")).alias("prediction"))


def hierarchy_weights(period: int) -> tuple[list[int], np.ndarray]:
    """Block sizes dividing ``period`` and the matrix from all node forecasts to the finest level."""
    sizes = [s for s in range(1, period + 1) if period % s == 0]
    rows = [np.eye(period)[i * s:(i + 1) * s].sum(axis=0) for s in sizes for i in range(period // s)]
    s_mat = np.array(rows)
    w = 1.0 / s_mat.sum(axis=1)  # structural scaling: variance grows with the block
    g = np.linalg.solve((s_mat * w[:, None]).T @ s_mat, (s_mat * w[:, None]).T)
    return sizes, g


def temporal_hierarchy(train: DataFrame, step: str, horizon_cycles: int, base: Callable[[DataFrame, DataFrame, int], DataFrame],
                       period: int = 7, y: str = "y", keys: Sequence[str] = ("id",)) -> DataFrame:
    """Forecast every block size of the cycle, then reconcile to the finest level.

    Only whole cycles that end with the last observation are used.
    """
    sizes, g = hierarchy_weights(period)
    last = train.groupBy(*keys).agg(F.max("k").alias("_last"), F.min("k").alias("_first"))
    d = join_params(train.select(*keys, "k", F.col(y).alias("y")), last, keys)
    # Re-number so that the last cell ends a block of every size; cell 0 is the first forecast cell.
    back = F.col("_last") - F.col("k")
    whole = F.floor((F.col("_last") - F.col("_first") + 1) / period) * period
    d = cut_lineage(d.where(back < whole).withColumn("_i", -(back + 1)))
    nodes = None
    offset = 0
    for s in sizes:
        block = d.groupBy(*keys, F.floor(F.col("_i") / s).alias("k")).agg(F.sum("y").alias("y"))
        block = block.withColumn("ts", F.lit(None).cast("timestamp_ntz"))
        n = period // s
        fut = last.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(horizon_cycles * n - 1))).alias("k")).withColumn("k", F.col("k").cast("bigint"))
        fc = base(block, fut.withColumn("ts", F.lit(None).cast("timestamp_ntz")), n)
        part = fc.select(*keys, F.floor(F.col("k") / n).alias("_cycle"),
                         (F.pmod("k", F.lit(n)) + offset).alias("_node"), "prediction")
        nodes = part if nodes is None else nodes.unionByName(part)
        offset += n
    vec = nodes.groupBy(*keys, "_cycle").agg(F.transform(F.array_sort(F.collect_list(F.struct("_node", "prediction"))),
                                                         lambda s: s["prediction"]).alias("_v"))
    cells = F.array(*[F.aggregate(F.zip_with("_v", F.array(*[F.lit(float(x)) for x in row]), lambda a, b: a * b),
                                  F.lit(0.0), lambda a, b: a + b) for row in g])
    out = vec.select(*keys, "_cycle", F.posexplode(cells).alias("_pos", "prediction"))
    return (join_params(out, last, keys).withColumn("k", F.col("_last") + 1 + F.col("_cycle") * period + F.col("_pos"))
            .select(*keys, "k", step_start("k", step).alias("ts"), "prediction"))
