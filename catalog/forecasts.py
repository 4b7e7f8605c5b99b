"""Queries for per-series forecasters."""

from __future__ import annotations

from math import pi

from pyspark.sql import functions as F

from catalog import query
from catalog import panels as P
from catalog.features import _BASE
from catalog.panels import r
from tidewheel.forecast import arima as A
from tidewheel.forecast import differencing as DF
from tidewheel.forecast import smoothing as S
from tidewheel.forecast import structural as ST
from tidewheel.operators import decompose as DC
from tidewheel.operators import features as FT
from tidewheel.operators import timeverbs as T
from tidewheel.plans import evaluate as E
from tidewheel.plans import resample as R


def _ev(spark, sf):
    return P.event_days(spark, sf).select("id", "k", "ts", F.col("v").alias("y"))


def smoothing_sql(grid, period, where="ev", y="v"):
    """The smoothing recursion as a recursive query over the positions of each series."""
    m = period
    g = ", ".join(f"({i}, {a}, {b}, {c}, {p})" for i, (a, b, c, p, _) in enumerate(grid))
    ph = f"CAST((k % {m}) + 1 AS INTEGER)"
    if m > 1:
        start = (f"st AS (SELECT id, avg(y) AS mu, avg(CASE WHEN i <= {m} THEN y END) AS f1, avg(CASE WHEN i > {m} THEN y END) AS f2 FROM b WHERE i <= {2 * m} GROUP BY 1), "
                 f"ss AS (SELECT id, list(s ORDER BY ph) AS s FROM (SELECT b.id, k % {m} AS ph, avg(y) - max(mu) AS s FROM b JOIN st USING (id) WHERE i <= {2 * m} GROUP BY 1, 2) GROUP BY 1), ")
        level = f"CASE WHEN phi > 0 THEN f1 - (f2 - f1) / {m} * {(m + 1) / 2} ELSE f1 END"
        slope, season = f"CASE WHEN phi > 0 THEN (f2 - f1) / {m} ELSE 0 END", "s"
    else:
        start = ("st AS (SELECT id, max(CASE WHEN i = 1 THEN y END) AS f1, max(CASE WHEN i = 2 THEN y END) AS f2 FROM b WHERE i <= 2 GROUP BY 1), "
                 "ss AS (SELECT DISTINCT id, [0.0] AS s FROM b), ")
        level, slope, season = "CASE WHEN phi > 0 THEN f1 - (f2 - f1) ELSE f1 END", "CASE WHEN phi > 0 THEN f2 - f1 ELSE 0 END", "s"
    upd = (f"list_transform(range(1, {m + 1}), lambda j: CASE WHEN j = CAST((b.k % {m}) + 1 AS INTEGER) THEN r.s[j] + gam * (b.y - (l + phi * t + r.s[j])) ELSE r.s[j] END)")
    e = f"(b.y - (l + phi * t + r.s[CAST((b.k % {m}) + 1 AS INTEGER)]))"
    return (f"WITH RECURSIVE {P.EVENT_DAYS}, b AS (SELECT id, k, {y} AS y, row_number() OVER (PARTITION BY id ORDER BY k) AS i FROM {where}), g(p, alpha, beta, gam, phi) AS (VALUES {g}), {start}"
            f"rr AS (SELECT st.id, p, CAST(alpha AS DOUBLE) AS alpha, CAST(beta AS DOUBLE) AS beta, CAST(gam AS DOUBLE) AS gam, CAST(phi AS DOUBLE) AS phi, CAST(0 AS BIGINT) AS i, CAST({level} AS DOUBLE) AS l, CAST({slope} AS DOUBLE) AS t, "
            f"CAST({season} AS DOUBLE[]) AS s, CAST(0 AS DOUBLE) AS sse FROM st JOIN ss USING (id), g UNION ALL "
            f"SELECT r.id, p, alpha, beta, gam, phi, r.i + 1, l + phi * t + alpha * {e}, phi * t + beta * {e}, {upd}, sse + {e} * {e} FROM rr r JOIN b ON b.id = r.id AND b.i = r.i + 1), "
            "n AS (SELECT id, max(i) AS n, max(k) AS last_k FROM b GROUP BY 1), fin AS (SELECT rr.* FROM rr JOIN n ON n.id = rr.id AND rr.i = n.n)")


_SES = S.ses_grid()
_HOLT = S.holt_grid()
_HW = S.winters_grid((.1, .3), (.1,), (.1, .3))


@query("ses_grid_sse", smoothing_sql(_SES, 1) + " SELECT id, p, round(sse, 2) AS sse, round(l, 4) AS level FROM fin")
def _(spark, sf):
    return S.fit(_ev(spark, sf), period=1, grid=_SES).select("id", "p", r("sse", 2), r(F.col("state")[0], 4, "level"))


_PICK = ", bst AS (SELECT id, arg_min(p, sse) AS p FROM fin GROUP BY 1), h AS (SELECT unnest(range(1, 15)) AS h)"
_TS = "CAST(TIMESTAMP '1970-01-01' + CAST(last_k + h AS INTEGER) * INTERVAL 1 DAY AS TIMESTAMP) AS ts"


@query("ses_forecast", smoothing_sql(_SES, 1) + _PICK + f" SELECT id, {_TS}, round(l, 4) AS prediction FROM fin JOIN bst USING (id, p) JOIN n USING (id), h")
def _(spark, sf):
    d = _ev(spark, sf)
    return S.ets(d, T.future_frame(d, "day", 14), 1, _SES, by="sse").select("id", "ts", r("prediction"))


@query("holt_forecast", smoothing_sql(_HOLT, 1) + _PICK + f" SELECT id, {_TS}, round(l + h * t, 3) AS prediction FROM fin JOIN bst USING (id, p) JOIN n USING (id), h")
def _(spark, sf):
    d = _ev(spark, sf)
    return S.ets(d, T.future_frame(d, "day", 14), 1, _HOLT, by="sse").select("id", "ts", r("prediction", 3))


@query("holt_winters_forecast", smoothing_sql(_HW, 7) + _PICK + f" SELECT id, {_TS}, round(l + h * t + s[CAST((last_k + h) % 7 + 1 AS INTEGER)], 3) AS prediction FROM fin JOIN bst USING (id, p) JOIN n USING (id), h")
def _(spark, sf):
    d = _ev(spark, sf)
    return S.ets(d, T.future_frame(d, "day", 14), 7, _HW, by="sse").select("id", "ts", r("prediction", 3))


@query("theta_forecast", smoothing_sql(_SES, 1, "(SELECT ev.id, k, 2 * v - a - b * k AS v FROM ev JOIN (SELECT id, regr_slope(v, k) AS b, regr_intercept(v, k) AS a FROM ev GROUP BY 1) USING (id))") + _PICK +
       f", li AS (SELECT id, regr_slope(v, k) AS b, regr_intercept(v, k) AS a FROM ev GROUP BY 1) SELECT id, {_TS}, round(0.5 * l + 0.5 * (a + b * (last_k + h)), 3) AS prediction FROM fin JOIN bst USING (id, p) JOIN n USING (id) JOIN li USING (id), h")
def _(spark, sf):
    d = _ev(spark, sf)
    return S.theta(d, T.future_frame(d, "day", 14)).select("id", "ts", r("prediction", 3))


def _orders(spark, sf):
    return P.order_days(spark, sf).drop("n")


def _out(fc, digits=2):
    return fc.select("id", "ts", r("prediction", digits))


@query("auto_ets_forecast")
def _(spark, sf):
    d = _orders(spark, sf)
    return _out(S.ets(d, T.future_frame(d, "day", 56), 7))


@query("sarima_forecast")
def _(spark, sf):
    d = _orders(spark, sf)
    return _out(A.forecast(d, T.future_frame(d, "day", 56)))


@query("auto_sarima_forecast")
def _(spark, sf):
    d = _orders(spark, sf)
    return _out(A.auto(d, T.future_frame(d, "day", 56)))


def _with_x(d):
    return d.withColumns({**FT.fourier_terms([7, 365.25], 2), "month_start": F.when(F.dayofmonth("ts") == 1, 1.0).otherwise(0.0)})


_XS = [*(f"{k}{p}_k{j}" for p in ("7", "365_25") for j in (1, 2) for k in ("sin", "cos")), "month_start"]


@query("sarimax_forecast")
def _(spark, sf):
    d = _orders(spark, sf)
    f = T.future_frame(d, "day", 56)
    return _out(ST.with_regressors(_with_x(d), _with_x(f), _XS, lambda t, u: A.forecast(t, u, [A.Order(1, 0, 1), A.Order(2, 0, 1)])))


@query("ets_with_regressors")
def _(spark, sf):
    d = _orders(spark, sf)
    f = T.future_frame(d, "day", 56)
    return _out(ST.with_regressors(_with_x(d), _with_x(f), _XS, lambda t, u: S.ets(t, u, 7)))


@query("multi_season_forecast")
def _(spark, sf):
    d = _orders(spark, sf)
    return _out(ST.multi_season(d, T.future_frame(d, "day", 56)))


def _with_month(d):
    return d.withColumn("month_start", F.when(F.dayofmonth("ts") == 1, 1.0).otherwise(0.0))


@query("stl_ets_forecast")
def _(spark, sf):
    d = _orders(spark, sf)
    return _out(ST.stl_forecast(d, T.future_frame(d, "day", 56), lambda t, u: S.ets(t, u, 1), (7, 30, 182)))


@query("stl_arima_forecast")
def _(spark, sf):
    d = _orders(spark, sf)
    """Three seasons at once, calendar regressors, automatic ARIMA without a season for the rest."""
    return _out(ST.stl_forecast(_with_month(d), _with_month(T.future_frame(d, "day", 56)), lambda t, u: A.auto(t, u, 1), (7, 30, 182), xs=["month_start"]))


@query("multi_season_decomposition")
def _(spark, sf):
    """Weekly, monthly and half-yearly season of every series; the components add up to it."""
    d = DC.multi_stl(_orders(spark, sf).withColumn("y", F.col("y") / 1e5))
    parts = ["season_7", "season_30", "season_182", "trend", "remainder"]
    return d.select("id", "ts", *[r(c, 5) for c in parts], (F.abs(F.col("y") - sum((F.col(c) for c in parts), F.lit(0.0))) < 1e-9).alias("adds_up"))


@query("additive_changepoint_forecast")
def _(spark, sf):
    d = _orders(spark, sf).withColumn("month_start", F.when(F.dayofmonth("ts") == 1, 1.0).otherwise(0.0))
    f = T.future_frame(d, "day", 56).withColumn("month_start", F.when(F.dayofmonth("ts") == 1, 1.0).otherwise(0.0))
    return _out(ST.additive(d, f, xs=["month_start"]))


@query("temporal_hierarchy_forecast")
def _(spark, sf):
    d = _orders(spark, sf)
    base = lambda t, f, n: S.ets(t, f, max(n, 1), S.ses_grid() if n == 1 else S.winters_grid(period=n))
    return _out(ST.temporal_hierarchy(d, "day", 8, base))


@query("panel_hold_out_accuracy")
def _(spark, sf):
    """Smoothing, ARIMA and the additive model on the last eight weeks of every series."""
    s = R.time_series_split(_orders(spark, sf), "day", "8 weeks")
    train, test = R.training(s), R.testing(s)
    tag = lambda f, m: f.select("id", "k", "ts", F.lit(m).alias("model_id"), "prediction")
    fc = tag(S.ets(train, test, 7), "ets").unionByName(tag(A.forecast(train, test), "sarima")).unionByName(tag(ST.additive(train, test), "additive"))
    return E.accuracy(E.calibrate(fc, test)).select("model_id", "id", "n", *[r(m, 3) for m in E.METRICS])


@query("smoothing_or_arima_forecast")
def _(spark, sf):
    d = _orders(spark, sf)
    return _out(ST.smoothing_or_arima(d, T.future_frame(d, "day", 56)))


_KPSS = (f"WITH {P.ORDER_DAYS}, m AS (SELECT id, k, y - avg(y) OVER (PARTITION BY id) AS e, count(*) OVER (PARTITION BY id) AS n FROM od), "
         "l AS (SELECT *, CAST(floor(4 * pow(n / 100.0, 0.25)) AS INTEGER) AS lags, sum(e) OVER (PARTITION BY id ORDER BY k) AS s FROM m), "
         "g AS (SELECT a.id, j, sum(a.e * b.e) * CASE WHEN j = 0 THEN 1 ELSE 2 * (1 - j / (max(a.lags) + 1.0)) END AS g FROM l a, (SELECT unnest(range(0, 40)) AS j) JOIN l b ON b.id = a.id AND b.k = a.k - j WHERE j <= a.lags GROUP BY 1, 2), "
         "v AS (SELECT id, sum(g) AS v FROM g GROUP BY 1) ")


@query("stationarity_statistic", f"{_KPSS} SELECT id, any_value(n) AS n, any_value(lags) AS lags, round(sum(s * s) / (any_value(n) * any_value(v)), 6) AS stat FROM l JOIN v USING (id) GROUP BY 1")
def _(spark, sf):
    return DF.kpss(_orders(spark, sf)).select("id", "n", "lags", r("stat", 6))


@query("differencing_choice", f"{_BASE}, f AS (SELECT id, greatest(0, 1 - var_pop(remainder) / var_pop(y - trend)) AS strength FROM stl GROUP BY 1) SELECT id, CASE WHEN strength > 0.64 THEN 1 ELSE 0 END AS seasonal_d, round(strength, 5) AS strength FROM f")
def _(spark, sf):
    """Strength of the weekly season and whether it asks for a seasonal difference."""
    return DF.choose(_orders(spark, sf)).select("id", "seasonal_d", r("strength", 5))


@query("auto_sarima_orders")
def _(spark, sf):
    """Differencing and order of every series: weekly totals, then daily ones with a season added."""
    d = _orders(spark, sf)
    wave = d.withColumn("y", F.col("y") * (1 + 0.5 * F.sin(F.col("k") * (2 * pi / 7)))).withColumn("id", F.concat("id", F.lit(" wave")))
    both = d.unionByName(wave)
    return A.auto_search(both, T.future_frame(both, "day", 7)).select("id", "order", "n_scored", r("score", 4))
