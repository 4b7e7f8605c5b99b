"""Seasonal ARIMA by two least-squares stages (Hannan-Rissanen), all series and candidates at once.

Spark differences, lags and sums one cross-product matrix over the union of all candidate lags;
each candidate is then a sub-block of that small matrix, so searching orders costs no extra pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.core import join_params
from tidewheel.forecast import linear as L
from tidewheel.forecast.native import last_cells
from tidewheel.operators.windows import augment, lag
from tidewheel.session import cut_lineage


@dataclass(frozen=True)
class Order:
    p: int = 1
    d: int = 1
    q: int = 1
    P: int = 0
    D: int = 0
    Q: int = 0

    def lags(self, period: int) -> tuple[list[int], list[int]]:
        def terms(a, b):
            return sorted({i + j * period for i in range(a + 1) for j in range(b + 1)} - {0})
        return terms(self.p, self.P), terms(self.q, self.Q)


def candidates(d: int, D: int, max_p: int = 2, max_q: int = 2, seasonal: bool = True) -> list[Order]:
    """All orders up to the limits that share one differencing."""
    PQ = [(P, Q) for P in (0, 1) for Q in (0, 1)] if seasonal else [(0, 0)]
    return [Order(p, d, q, P, D, Q) for p in range(max_p + 1) for q in range(max_q + 1) for P, Q in PQ if p + q + P + Q > 0]


def _diff_poly(d: int, D: int, period: int) -> np.ndarray:
    """Coefficients of (1 - B)^d (1 - B^period)^D."""
    c = np.array([1.0])
    for _ in range(d):
        c = np.convolve(c, [1.0, -1.0])
    for _ in range(D):
        s = np.zeros(period + 1)
        s[0], s[-1] = 1.0, -1.0
        c = np.convolve(c, s)
    return c


def _subset_solver(cands: list[list[int]], k: int):
    @F.pandas_udf("struct<coef:array<double>,intercept:double,aicc:double,cand:int>")
    def udf(n: pd.Series, means: pd.Series, cov: pd.Series) -> pd.DataFrame:
        out = []
        for nn, mm, cc in zip(n, means, cov):
            c = np.asarray(cc, dtype=float).reshape(k + 1, k + 1)
            m = np.asarray(mm, dtype=float)
            top = None
            for i, idx in enumerate(cands):
                a = c[np.ix_(idx, idx)]
                # A touch of ridge keeps near-collinear lag sets solvable.
                try:
                    b = np.linalg.solve(a + 1e-8 * np.trace(a) / len(idx) * np.eye(len(idx)) + 1e-12 * np.eye(len(idx)), c[idx, k])
                except np.linalg.LinAlgError:
                    continue
                s2 = max(c[k, k] - b @ c[idx, k], 1e-12)
                kp = len(idx) + 2
                score = nn * np.log(s2) + 2 * kp + (2 * kp * (kp + 1) / (nn - kp - 1) if nn > kp + 1 else 1e9)
                if top is None or score < top[2]:
                    beta = np.zeros(k)
                    beta[idx] = b
                    top = (beta.tolist(), m[k] - beta @ m[:k], score, i)
            # No order can be solved: the series stays without a model, the others go on.
            out.append(top or (None, None, None, None))
        return pd.DataFrame(out, columns=["coef", "intercept", "aicc", "cand"]).astype({"cand": "Int32"})
    return udf


def fit(train: DataFrame, orders: Sequence[Order], period: int = 7, y: str = "y",
        keys: Sequence[str] = ("id",)) -> tuple[DataFrame, DataFrame, list[int], list[int]]:
    """Fit orders that share (d, D).

    Returns (model rows, training rows with ``_w, _e, fitted, _res``, AR lags, MA lags).
    """
    d0, D0 = orders[0].d, orders[0].D
    poly = _diff_poly(d0, D0, period)
    ar = sorted({l for o in orders for l in o.lags(period)[0]})
    ma = sorted({l for o in orders for l in o.lags(period)[1]})
    long = list(range(1, _long(period) + 1))
    base = train.select(*keys, "k", "ts", F.col(y).cast("double").alias("_y"))
    steps = {f"_p{i}": lag("_y", i) for i in range(1, len(poly)) if poly[i]}
    w = F.col("_y")
    for i in range(1, len(poly)):
        if poly[i]:
            w = w + float(poly[i]) * F.col(f"_p{i}")
    d = augment(base, keys=keys, **steps) if steps else base
    d = d.withColumn("_w", w).drop(*steps)
    need = sorted(set(long) | set(ar))
    d = augment(d, keys=keys, **{f"_w{i}": lag("_w", i) for i in need})
    d = cut_lineage(d)
    m1 = cut_lineage(L.fit(d, "_w", [f"_w{i}" for i in long], keys=keys, ridge=1e-6))
    d = L.predict(d, m1, [f"_w{i}" for i in long], keys=keys, out="_h")
    d = d.withColumn("_e", F.col("_w") - F.col("_h")).drop("_h", *[f"_w{i}" for i in need if i not in ar])
    d = augment(d, keys=keys, **{f"_e{i}": lag("_e", i) for i in ma}) if ma else d
    d = cut_lineage(d)
    xs = [f"_w{i}" for i in ar] + [f"_e{i}" for i in ma]
    cands = [[xs.index(f"_w{i}") for i in o.lags(period)[0]] + [xs.index(f"_e{i}") for i in o.lags(period)[1]] for o in orders]
    g = L.gram(d, "_w", xs, list(keys))
    model = cut_lineage(g.select(*keys, "n", _subset_solver(cands, len(xs))("n", "means", "cov").alias("_f"))
                        .select(*keys, "n", "_f.*"))
    d = L.predict(d, model, xs, keys=keys, out="_p")
    d = d.withColumn("_res", F.coalesce(F.col("_w") - F.col("_p"), F.lit(0.0))).withColumn(
        "fitted", F.col("_y") - (F.col("_w") - F.col("_p"))).drop(*xs, "_p")
    return model, d, ar, ma


def _extend(poly: np.ndarray, ar: list[int], ma: list[int]):
    back = max([len(poly) - 1, *ar, *ma, 1])

    @F.pandas_udf("array<double>")
    def udf(tail: pd.Series, coef: pd.Series, intercept: pd.Series, cells: pd.Series) -> pd.Series:
        out = []
        for t, c, b0, h in zip(tail, coef, intercept, cells):
            if c is None or h <= 0:
                out.append(None if c is None else [])
                continue
            t, h = list(t), int(h)
            yv, wv, ev = [x["y"] for x in t], [x["w"] for x in t], [x["e"] for x in t]
            # An unknown value is carried over from the known one before it; at the head, from the series' last known one.
            known = next((v for v in yv if v is not None), t[-1]["known"])
            for i, v in enumerate(yv):
                known = yv[i] = known if v is None else v
            for _ in range(h):
                v = b0
                for j, l in enumerate(ar):
                    v += c[j] * (wv[-l] if len(wv) >= l and wv[-l] is not None else 0.0)
                for j, l in enumerate(ma):
                    v += c[len(ar) + j] * (ev[-l] if len(ev) >= l else 0.0)
                wv.append(v)
                ev.append(0.0)
                yv.append(v - sum(poly[i] * yv[-i] for i in range(1, len(poly)) if poly[i]))
            out.append([float(x) for x in yv[-h:]])
        return pd.Series(out)
    return udf, back


def _long(period: int) -> int:
    """Lags of the first, long autoregression."""
    return min(14, max(2 * period, 10))


def burn_in(orders: Sequence[Order], period: int) -> int:
    """Cells at the head of a series that some order of the set cannot be judged on."""
    return max(len(_diff_poly(o.d, o.D, period)) - 1 + max([_long(period), *o.lags(period)[0]]) + max([0, *o.lags(period)[1]]) for o in orders)


def search(train: DataFrame, future: DataFrame, orders: Sequence[Order], period: int = 7, y: str = "y",
           keys: Sequence[str] = ("id",), horizon: int | None = None, skip: int | None = None) -> DataFrame:
    """``keys, last_k, path, score, n_scored, order``: the best of ``orders`` per series and its path.

    Orders of one differencing are compared by AICc on the rows they share.  Differencings are then compared on equal rows too:
    ``score`` is AICc per observation over the ``n_scored`` cells after the first ``skip`` ones (by default what no order of the set can
    judge).  A path reaches the last stamp that ``future`` asks of its series, or has ``horizon`` cells where that is given.
    Series that no order can be fitted to are missing here; ``along`` returns their stamps without a prediction.
    """
    ends = future.groupBy(*keys).agg(F.max("k").alias("_end"))
    skip = burn_in(orders, period) if skip is None else skip
    groups: dict[tuple[int, int], list[Order]] = {}
    for o in orders:
        groups.setdefault((o.d, o.D), []).append(o)
    first = train.groupBy(*keys).agg(F.min("k").alias("_k0"))
    parts = None
    for (d0, D0), os in groups.items():
        model, rows, ar, ma = fit(train, os, period, y, keys)
        udf, back = _extend(_diff_poly(d0, D0, period), ar, ma)
        ends_known = rows.where("_y IS NOT NULL").groupBy(*keys).agg(F.max_by("_y", "k").alias("known"))
        tail = join_params(last_cells(rows, back, keys), ends_known, keys).groupBy(*keys).agg(
            F.array_sort(F.collect_list(F.struct("k", F.col("_y").alias("y"), F.col("_w").alias("w"), F.col("_res").alias("e"), "known"))).alias("_t"),
            F.max("k").alias("last_k"))
        judged = join_params(rows, first, keys).where(F.col("fitted").isNotNull() & (F.col("k") >= F.col("_k0") + skip))
        judged = judged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_scored"), F.sum(F.col("_res") * F.col("_res")).alias("_sse"))
        cells = F.col("_end") - F.col("last_k") if horizon is None else F.lit(horizon).cast("bigint")
        kp = F.element_at(F.array(*[F.lit(len(o.lags(period)[0]) + len(o.lags(period)[1]) + 2) for o in os]), F.col("cand") + 1)
        label = F.element_at(F.array(*[F.lit(f"({o.p},{o.d},{o.q})({o.P},{o.D},{o.Q})") for o in os]), F.col("cand") + 1)
        n = F.col("n_scored")
        score = (n * F.log(F.greatest(F.col("_sse"), F.lit(1e-12)) / n) + 2 * kp + F.when(n > kp + 1, 2 * kp * (kp + 1) / (n - kp - 1)).otherwise(F.lit(1e9))) / n
        # Too short to be judged on common rows: by its own score, after all that are.
        score = F.coalesce(F.when(n > 0, score), 1e9 + F.col("aicc") / F.col("n"))
        p = tail.join(model.where("coef IS NOT NULL"), list(keys)).join(ends, list(keys)).join(judged, list(keys), "left").select(
            *keys, "last_k", score.alias("score"), F.coalesce(n, F.lit(0)).alias("n_scored"), label.alias("order"), udf("_t", "coef", "intercept", cells).alias("path"))
        parts = p if parts is None else parts.unionByName(p)
    return parts.groupBy(*keys).agg(F.min_by(F.struct("last_k", "path", "n_scored", "order"), "score").alias("_b"),
                                    F.min("score").alias("score")).select(*keys, "_b.last_k", "_b.path", "score", "_b.n_scored", "_b.order")


def auto_search(train: DataFrame, future: DataFrame, period: int = 7, y: str = "y", keys: Sequence[str] = ("id",),
                horizon: int | None = None, skip: int | None = None, max_p: int = 2, max_q: int = 2) -> DataFrame:
    """``search`` where every series has its own differencing (``differencing.choose``) and all orders up to the limits.

    Series of one differencing are fitted together; at most six differencings occur.
    """
    from tidewheel.forecast import differencing as DF

    choice = cut_lineage(DF.choose(train, y, period, keys=keys))
    found = choice.select("d", "seasonal_d").distinct().orderBy("d", "seasonal_d").collect()
    parts = [search(train.join(choice.where((F.col("d") == r.d) & (F.col("seasonal_d") == r.seasonal_d)).select(*keys), list(keys), "left_semi"), future,
                    candidates(r.d, r.seasonal_d, max_p, max_q, period > 1), period, y, keys, horizon, skip) for r in found]
    if not parts:
        return search(train, future, [Order()], period, y, keys, horizon, skip)
    return reduce(DataFrame.unionByName, parts)


def forecast(train: DataFrame, future: DataFrame, orders: Sequence[Order] = (Order(1, 1, 1, 1, 1, 1),), period: int = 7,
             y: str = "y", keys: Sequence[str] = ("id",), horizon: int | None = None) -> DataFrame:
    """Best of ``orders`` per series, extended to the last stamp asked (or by ``horizon`` cells)."""
    return along(search(train, future, orders, period, y, keys, horizon), future, keys)


def along(top: DataFrame, future: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Read the predictions for the future stamps off the paths; every stamp stays, NULL where there is no path."""
    h = (F.col("k") - F.col("last_k")).cast("int")
    value = F.when(h > 0, F.try_element_at("path", h))
    return future.select(*keys, "k", "ts").join(top, list(keys), "left").select(*keys, "k", "ts", value.alias("prediction"))


def auto(train: DataFrame, future: DataFrame, period: int = 7, y: str = "y", keys: Sequence[str] = ("id",),
         horizon: int | None = None) -> DataFrame:
    """Differencing by stationarity and seasonal strength, order by AICc, per series."""
    return along(auto_search(train, future, period, y, keys, horizon), future, keys)
