"""Queries for features, recipes, regression and diagnostics."""

from __future__ import annotations

from math import pi

from pyspark.sql import functions as F

from catalog import query
from catalog import panels as P
from catalog.panels import r, table
from tidewheel.core import exact_quantiles, join_params, step_index, step_start
from tidewheel.forecast import linear as L
from tidewheel.operators import decompose as DC
from tidewheel.operators import diagnostics as D
from tidewheel.operators import features as FT
from tidewheel.operators import timeverbs as T
from tidewheel.operators import transforms as X
from tidewheel.operators import windows as W
from tidewheel.plans.recipes import Recipe


@query("timeseries_signature", "SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS index_num, year(ts) AS year, isoyear(ts) AS year_iso, CASE WHEN month(ts) <= 6 THEN 1 ELSE 2 END AS half, "
       "quarter(ts) AS quarter, month(ts) AS month, monthname(ts) AS month_lbl, day(ts) AS day, hour(ts) AS hour, minute(ts) AS minute, second(ts) AS second, hour(ts) % 12 AS hour12, "
       "CASE WHEN hour(ts) < 12 THEN 1 ELSE 2 END AS am_pm, dayofweek(ts) + 1 AS wday, dayname(ts) AS wday_lbl, day(ts) AS mday, date_diff('day', date_trunc('quarter', ts), ts) + 1 AS qday, dayofyear(ts) AS yday, "
       "(day(ts) - 1) // 7 + 1 AS mweek, (dayofyear(ts) - 1) // 7 + 1 AS week, week(ts) AS week_iso, ((dayofyear(ts) - 1) // 7 + 1) % 2 AS week2, ((dayofyear(ts) - 1) // 7 + 1) % 3 AS week3, "
       "((dayofyear(ts) - 1) // 7 + 1) % 4 AS week4, (day(ts) - 1) // 7 + 1 AS mday7 FROM events")
def _(spark, sf):
    d = FT.augment_signature(table(spark, sf, "events").select("event_id", "ts"))
    return d.drop("ts")


@query("fourier_terms", f"WITH {P.ORDER_DAYS} SELECT id, ts, " + ", ".join(
    f"round({k}(k * {2 * pi * j / p!r}), 6) AS {k}{p}_k{j}" for p in (7, 365) for j in (1, 2) for k in ("sin", "cos")) + " FROM od")
def _(spark, sf):
    t = FT.fourier_terms([7, 365], 2)
    return P.order_days(spark, sf).select("id", "ts", *[r(c, 6, n) for n, c in t.items()])


@query("b_spline_basis", f"WITH {P.ORDER_DAYS}, u AS (SELECT id, ts, (k - min(k) OVER w) / CAST(max(k) OVER w - min(k) OVER w AS DOUBLE) AS u FROM od WINDOW w AS (PARTITION BY id)) "
       "SELECT id, ts, round(3 * u * (1 - u) * (1 - u), 6) AS b1, round(3 * u * u * (1 - u), 6) AS b2, round(u * u * u, 6) AS b3 FROM u")
def _(spark, sf):
    d = P.order_days(spark, sf)
    d = join_params(d, d.groupBy("id").agg(F.min("k").alias("lo"), F.max("k").alias("hi")))
    b = FT.b_spline(FT.unit_range("k", "lo", "hi"))
    return d.select("id", "ts", *[r(c, 6, f"b{i + 1}") for i, c in enumerate(b)])


@query("natural_spline_basis", f"WITH {P.ORDER_DAYS}, b AS (SELECT id, min(k) AS lo, max(k) AS hi, quantile_cont(k, 1 / 3.0) AS q1, quantile_cont(k, 2 / 3.0) AS q2 FROM od GROUP BY 1), "
       "u AS (SELECT od.id, ts, (k - lo) / CAST(hi - lo AS DOUBLE) AS x, (q1 - lo) / (hi - lo) AS a, (q2 - lo) / (hi - lo) AS b FROM od JOIN b USING (id)), "
       "c AS (SELECT *, (pow(x, 3) - 0) / 1 AS d0, pow(greatest(x - a, 0), 3) / (1 - a) AS d1, pow(greatest(x - b, 0), 3) / (1 - b) AS d2 FROM u) "
       "SELECT id, ts, round(x, 6) AS n1, round(d0 - d2, 6) AS n2, round(d1 - d2, 6) AS n3 FROM c")
def _(spark, sf):
    d = P.order_days(spark, sf).withColumn("kd", F.col("k").cast("double"))
    q = exact_quantiles(d, "kd", {"q1": 1 / 3, "q2": 2 / 3}, keys=["id"])
    b = d.groupBy("id").agg(F.min("kd").alias("lo"), F.max("kd").alias("hi")).join(q, "id")
    d = join_params(d, b)
    u = lambda c: FT.unit_range(c, "lo", "hi")
    return d.select("id", "ts", *[r(c, 6, f"n{i + 1}") for i, c in enumerate(FT.natural_spline(u("kd"), [u("q1"), u("q2")]))])


@query("interaction_and_dummies", f"WITH {P.ORDER_DAYS}, s AS (SELECT id, ts, ((dayofyear(ts) - 1) // 7 + 1) % 2 AS w2, dayofweek(ts) + 1 AS wd FROM od) "
       "SELECT id, ts, " + ", ".join(f"CASE WHEN wd = {i} THEN 1.0 ELSE 0.0 END AS wday_{i}, CAST(CASE WHEN wd = {i} THEN w2 ELSE 0 END AS DOUBLE) AS week2_x_wday_{i}" for i in range(1, 8)) + " FROM s")
def _(spark, sf):
    d = FT.augment_signature(P.order_days(spark, sf), parts=["week2", "wday"])
    dm = FT.dummies("wday", range(1, 8))
    return d.select("id", "ts", *[c.alias(n) for n, c in dm.items()], *[c.alias(n) for n, c in FT.interaction({"week2": F.col("week2")}, dm).items()])


@query("event_regressors", f"WITH {P.ORDER_DAYS}, h AS (SELECT CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS ts, CAST(count(*) AS DOUBLE) AS event FROM lineitem WHERE l_discount > 0.09 AND l_quantity > 45 GROUP BY 1) "
       "SELECT id, od.ts, n, coalesce(event, 0) AS event FROM od LEFT JOIN h ON h.ts = od.ts")
def _(spark, sf):
    ev = table(spark, sf, "lineitem").where("l_discount > 0.09 AND l_quantity > 45").groupBy(
        step_start(step_index("l_shipdate", "day"), "day").alias("ts")).agg(F.count(F.lit(1)).alias("event"))
    return FT.join_events(P.order_days(spark, sf), ev, ["ts"], ["event"]).select("id", "ts", "n", "event")


@query("external_regressor_lags", f"WITH {P.ORDER_DAYS}, {P.SHIP_TOTAL}, j AS (SELECT id, od.ts, k, coalesce(st.x, 0) AS x FROM od LEFT JOIN st ON st.ts = od.ts) "
       "SELECT id, ts, round(x, 3) AS x, round(lag(x, 7) OVER w, 3) AS x_lag7, round(lag(x, 42) OVER w, 3) AS x_lag42 FROM j WINDOW w AS (PARTITION BY id ORDER BY ts)")
def _(spark, sf):
    d = P.order_days(spark, sf).join(P.ship_total_days(spark, sf).drop("k"), "ts", "left").withColumn("x", F.coalesce("x", F.lit(0.0)))
    return W.augment_lags(d, ["x"], [7, 42]).select("id", "ts", r("x", 3), r("x_lag7", 3), r("x_lag42", 3))


_TRAIN = "ts < TIMESTAMP '2001-01-01'"


@query("recipe_fit_transform", f"WITH {P.ORDER_DAYS}, t AS (SELECT *, k AS trend, dayofweek(ts) + 1 AS wday FROM od), p AS (SELECT avg(trend) AS m, stddev_samp(trend) AS s FROM t WHERE {_TRAIN} AND n > 0) "
       "SELECT id, ts, round(n, 4) AS n, round((trend - m) / s, 6) AS trend, " + ", ".join(f"CASE WHEN wday = {i} THEN 1.0 ELSE 0.0 END AS wday_{i}" for i in range(1, 8)) +
       ", round(sin(k * 0.8975979010256552), 6) AS sin7_k1, round(cos(k * 0.8975979010256552), 6) AS cos7_k1 FROM t, p")
def _(spark, sf):
    rec = (Recipe(outcome="n", roles={"id": "id", "ts": "index", "k": "index"})
           .step_filter(F.col("n") > 0).step_mutate(trend=F.col("k").cast("double")).step_signature("ts", ["wday"])
           .step_normalize(r"^trend$").step_dummy("wday").step_fourier([7], 1).step_rm("^y$"))
    d = P.order_days(spark, sf)
    out = rec.fit(d.where(_TRAIN)).transform(d)
    return out.select("id", "ts", F.col("n").cast("double").alias("n"), r("trend", 6), *[f"wday_{i}" for i in range(1, 8)], r("sin7_k1", 6), r("cos7_k1", 6))


@query("regression_trend_per_id", f"WITH {P.ORDER_DAYS} SELECT id, count(*) AS n, round(regr_slope(y, k), 5) AS slope, round(regr_intercept(y, k), 2) AS intercept, round(regr_r2(y, k), 8) AS r2 FROM od GROUP BY 1")
def _(spark, sf):
    m = L.fit(P.order_days(spark, sf), "y", ["k"])
    return m.select("id", "n", r(F.col("coef")[0], 5, "slope"), r("intercept", 2), r("r2", 8))


@query("regression_two_regressors", f"WITH {P.SHIP_DAYS}, f AS (SELECT id, x AS y, q AS a, sin(k * {2 * pi / 7!r}) AS b FROM sd), c AS (SELECT id, covar_pop(a, a) AS aa, covar_pop(a, b) AS ab, covar_pop(b, b) AS bb, "
       "covar_pop(a, y) AS ay, covar_pop(b, y) AS bby, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(y) AS vy FROM f GROUP BY 1), s AS (SELECT *, (ay * bb - bby * ab) / (aa * bb - ab * ab) AS ca, (bby * aa - ay * ab) / (aa * bb - ab * ab) AS cb FROM c) "
       "SELECT id, round(my - ca * ma - cb * mb, 2) AS intercept, round(ca, 4) AS c_a, round(cb, 2) AS c_b, round((ca * ay + cb * bby) / vy, 7) AS r2 FROM s")
def _(spark, sf):
    d = P.ship_days(spark, sf).withColumn("s7", FT.fourier(7, 1))
    m = L.fit(d, "x", ["q", "s7"])
    return m.select("id", r("intercept", 2), r(F.col("coef")[0], 4, "c_a"), r(F.col("coef")[1], 2, "c_b"), r("r2", 7))


@query("regression_calendar_wide")
def _(spark, sf):
    """Weekday x parity, yearly Fourier and lag terms per series; long coefficient table."""
    d = FT.augment_signature(P.order_days(spark, sf), parts=["wday", "week2"])
    dm = FT.dummies("wday", range(2, 8))
    cols = {**dm, **FT.interaction({"week2": F.col("week2").cast("double")}, dm), **FT.fourier_terms([365.25], 4), "trend": F.col("k").cast("double")}
    d = W.augment_lags(d.withColumns(cols), ["y"], [56])
    xs = [*cols, "y_lag56"]
    return L.coefficients(L.fit(d, "y", xs), xs).withColumn("estimate", F.round("estimate", 3))


def _acf_sql(panel, y, max_lag):
    return (f"WITH {panel[0]}, c AS (SELECT id, k, {y} - avg({y}) OVER (PARTITION BY id) AS x FROM {panel[1]}), q AS (SELECT id, sum(x * x) AS q, count(*) AS n FROM c GROUP BY 1), l AS (SELECT unnest(range(0, {max_lag + 1})) AS lag) "
            f"SELECT a.id, CAST(lag AS INTEGER) AS lag, round(sum(a.x * b.x) / max(q), 6) AS acf, round(1.96 / sqrt(max(n)), 6) AS bar FROM c a CROSS JOIN l JOIN c b ON b.id = a.id AND b.k = a.k - lag JOIN q ON q.id = a.id GROUP BY 1, 2")


@query("acf_55", _acf_sql((P.ORDER_DAYS, "od"), "n", 55))
def _(spark, sf):
    return D.acf(P.order_days(spark, sf), "n", 55).select("id", "lag", r("acf", 6), r("bar", 6))


@query("pacf_2", "WITH a AS (" + _acf_sql((P.ORDER_DAYS, "od"), "n", 2).replace("round(sum(a.x * b.x) / max(q), 6)", "sum(a.x * b.x) / max(q)") + "), w AS (SELECT id, max(CASE WHEN lag = 1 THEN acf END) AS r1, max(CASE WHEN lag = 2 THEN acf END) AS r2 FROM a GROUP BY 1) "
       "SELECT id, 1 AS lag, round(r1, 6) AS pacf FROM w UNION ALL SELECT id, 2, round((r2 - r1 * r1) / (1 - r1 * r1), 6) FROM w")
def _(spark, sf):
    return D.pacf(P.order_days(spark, sf), "n", 2).select("id", "lag", r("pacf", 6))


@query("pacf_55")
def _(spark, sf):
    return D.pacf(P.order_days(spark, sf), "n", 55).select("id", "lag", r("pacf", 6), r("bar", 6))


@query("ccf_14", f"WITH {P.SHIP_DAYS}, c AS (SELECT id, k, x - avg(x) OVER (PARTITION BY id) AS y, q - avg(q) OVER (PARTITION BY id) AS z FROM sd), q AS (SELECT id, sqrt(sum(y * y) * sum(z * z)) AS q FROM c GROUP BY 1), l AS (SELECT unnest(range(-14, 15)) AS lag) "
       "SELECT a.id, 'q' AS series, CAST(lag AS INTEGER) AS lag, round(sum(a.y * b.z) / max(q), 6) AS ccf FROM c a CROSS JOIN l JOIN c b ON b.id = a.id AND b.k = a.k - lag JOIN q ON q.id = a.id GROUP BY 1, 3")
def _(spark, sf):
    return D.ccf(P.ship_days(spark, sf), "x", ["q"], 14).select("id", "series", "lag", r("ccf", 6))


@query("seasonal_diagnostics", f"WITH {P.ORDER_DAYS}, p AS (SELECT id, 'wday' AS part, dayofweek(ts) + 1 AS level, y FROM od UNION ALL SELECT id, 'month', month(ts), y FROM od UNION ALL SELECT id, 'quarter', quarter(ts), y FROM od UNION ALL SELECT id, 'year', year(ts), y FROM od) "
       "SELECT id, part, CAST(level AS INTEGER) AS level, count(*) AS n, round(avg(y), 2) AS mean, round(quantile_cont(y, 0.25), 4) AS q1, round(median(y), 4) AS median, round(quantile_cont(y, 0.75), 4) AS q3 FROM p GROUP BY 1, 2, 3")
def _(spark, sf):
    d = D.seasonal_diagnostics(P.order_days(spark, sf), parts=["wday", "month", "quarter", "year"])
    return d.select("id", "part", "level", "n", r("mean", 2), r("q1", 4), r("median", 4), r("q3", 4))


@query("box_stats_by_quarter", f"WITH {P.ORDER_DAYS}, q AS (SELECT id, CAST(date_trunc('quarter', ts) AS TIMESTAMP) AS period, quantile_cont(y, 0.25) AS q1, median(y) AS median, quantile_cont(y, 0.75) AS q3 FROM od GROUP BY 1, 2), "
       "j AS (SELECT q.*, y, y BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM od JOIN q ON q.id = od.id AND q.period = date_trunc('quarter', ts)) "
       "SELECT id, period, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(min(CASE WHEN inside THEN y END), 4) AS lower, round(max(CASE WHEN inside THEN y END), 4) AS upper, count(CASE WHEN NOT inside THEN 1 END) AS n_out FROM j GROUP BY 1, 2, j.q1, j.median, j.q3")
def _(spark, sf):
    s, _ = D.box_stats(P.order_days(spark, sf), "quarter")
    return s.select("id", "period", r("q1", 4), r("median", 4), r("q3", 4), r("lower", 4), r("upper", 4), "n_out")


STL = (", t0 AS (SELECT *, avg(y) OVER (PARTITION BY id ORDER BY k ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS t FROM base), s0 AS (SELECT id, k % 7 AS ph, avg(y - t) AS s FROM t0 GROUP BY 1, 2), "
       "s1 AS (SELECT id, ph, s - avg(s) OVER (PARTITION BY id) AS s FROM s0), t1 AS (SELECT b.id, b.ts, b.k, b.y, avg(b.y - s) OVER (PARTITION BY b.id ORDER BY b.k ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS trend FROM base b JOIN s1 ON s1.id = b.id AND s1.ph = b.k % 7), "
       "s2 AS (SELECT id, k % 7 AS ph, avg(y - trend) AS s FROM t1 GROUP BY 1, 2), s3 AS (SELECT id, ph, s - avg(s) OVER (PARTITION BY id) AS season FROM s2), "
       "stl AS (SELECT t1.*, season, y - season - trend AS remainder, y - season AS seasadj FROM t1 JOIN s3 ON s3.id = t1.id AND s3.ph = t1.k % 7)")
_BASE = f"WITH {P.ORDER_DAYS}, base AS (SELECT id, ts, k, y FROM od)" + STL


@query("stl_decomposition", f"{_BASE} SELECT id, ts, round(season, 2) AS season, round(trend, 2) AS trend, round(remainder, 2) AS remainder, round(seasadj, 2) AS seasadj FROM stl")
def _(spark, sf):
    return DC.stl(P.order_days(spark, sf)).select("id", "ts", r("season", 2), r("trend", 2), r("remainder", 2), r("seasadj", 2))


@query("impute_linear", f"WITH {P.ORDER_DAYS_SPARSE}, i AS (SELECT *, last_value(CASE WHEN y IS NOT NULL THEN k END IGNORE NULLS) OVER b AS pk, last_value(y IGNORE NULLS) OVER b AS py, first_value(CASE WHEN y IS NOT NULL THEN k END IGNORE NULLS) OVER a AS nk, first_value(y IGNORE NULLS) OVER a AS ny FROM od "
       "WINDOW b AS (PARTITION BY id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY id ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) "
       "SELECT id, ts, round(CASE WHEN y IS NOT NULL THEN y ELSE py + (k - pk) / CAST(nk - pk AS DOUBLE) * (ny - py) END, 6) AS y FROM i")
def _(spark, sf):
    return DC.impute(P.order_days_sparse(spark, sf)).select("id", "ts", r("y", 6))


@query("impute_seasonal")
def _(spark, sf):
    return DC.impute(P.order_days_sparse(spark, sf), period=7).select("id", "ts", r("y", 3))


_LIM = ", lim AS (SELECT id, quantile_cont(remainder, 0.25) AS q1, quantile_cont(remainder, 0.75) AS q3 FROM stl GROUP BY 1)"


@query("clean_series", f"{_BASE}{_LIM}, f AS (SELECT stl.*, remainder BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1) AS ok FROM stl JOIN lim USING (id)) "
       "SELECT id, count(*) AS n, count(CASE WHEN NOT ok THEN 1 END) AS n_out FROM f GROUP BY 1")
def _(spark, sf):
    d = P.order_days(spark, sf)
    c = DC.clean(d, out="yc")
    return c.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.abs(F.col("y") - F.col("yc")) > 1e-9, 1)).alias("n_out"))


@query("anomaly_diagnostics", f"{_BASE}{_LIM}, f AS (SELECT stl.*, q1 - 3 * (q3 - q1) AS l1, q3 + 3 * (q3 - q1) AS l2 FROM stl JOIN lim USING (id)), "
       "g AS (SELECT *, greatest(l1 - remainder, remainder - l2) AS x, count(*) OVER (PARTITION BY id) AS n FROM f), h AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY x DESC, k) AS rn FROM g) "
       "SELECT id, ts, CASE WHEN x > 0 AND rn <= floor(n * 0.2) THEN 1 ELSE 0 END AS anomaly, round(season + trend + l1, 2) AS band_lower, round(season + trend + l2, 2) AS band_upper FROM h")
def _(spark, sf):
    return DC.anomaly_diagnostics(P.order_days(spark, sf), alpha=0.05).select("id", "ts", "anomaly", r("band_lower", 2), r("band_upper", 2))


@query("period_smoother_quarterly", f"WITH {P.ORDER_DAYS}, q AS (SELECT id, CAST(date_trunc('quarter', ts) AS TIMESTAMP) AS period, avg(y) AS mean FROM od GROUP BY 1, 2) "
       "SELECT id, period, round(mean, 2) AS mean, round(mean - lag(mean) OVER (PARTITION BY id ORDER BY period), 2) AS change FROM q")
def _(spark, sf):
    s, _ = D.box_stats(P.order_days(spark, sf), "quarter")
    return D.period_smoother(s, "mean").select("id", "period", r("mean", 2), r("change", 2))
