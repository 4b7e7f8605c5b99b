"""Queries for splits, accuracy, intervals, selection and ensembles."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog import panels as P
from catalog.panels import r, table
from tidewheel.forecast import ensemble as EN
from tidewheel.forecast import native as N
from tidewheel.operators import diagnostics as D
from tidewheel.operators import timeverbs as T
from tidewheel.operators import verbs as V
from tidewheel.plans import evaluate as E
from tidewheel.plans import resample as R
from tidewheel.plans.registry import ModelTable, calibrate_evaluate, refit
from tidewheel.session import cut_lineage
from tidewheel.sources import competition as C


def simple_models():
    return (ModelTable().add(N.naive, "naive").add(lambda t, f: N.seasonal_naive(t, f, 7), "snaive")
            .add(lambda t, f: N.window(t, f, 7), "mean7").add(lambda t, f: N.window(t, f, 7, F.median), "median7")
            .add(N.window_weighted, "wmean3"))


def _ev(spark, sf):
    return P.event_days(spark, sf).withColumn("y", F.col("n").cast("double")).drop("n", "v")


def _split(spark, sf):
    return R.time_series_split(_ev(spark, sf), "day", 7)


def _fc(spark, sf):
    s = cut_lineage(_split(spark, sf))  # five models and the calibration read it
    return cut_lineage(simple_models().forecast(R.training(s), R.testing(s))), s


def _cal(spark, sf):
    f, s = _fc(spark, sf)
    return E.calibrate(f, R.testing(s))


# SQL: split of the daily event counts by date, five simple forecasters, calibration.
SPLIT = f"{P.EVENT_DAYS}, sp AS (SELECT id, ts, k, CAST(n AS DOUBLE) AS y, CASE WHEN k > max(k) OVER () - 7 THEN 'test' ELSE 'train' END AS segment FROM ev)"
MODELS = (SPLIT + ", tr AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k DESC) AS back FROM sp WHERE segment = 'train'), te AS (SELECT * FROM sp WHERE segment = 'test'), "
          "ag AS (SELECT id, max(CASE WHEN back = 1 THEN y END) AS p1, avg(CASE WHEN back <= 7 THEN y END) AS p3, median(CASE WHEN back <= 7 THEN y END) AS p4, "
          "sum(CASE back WHEN 1 THEN 0.6 * y WHEN 2 THEN 0.3 * y WHEN 3 THEN 0.1 * y END) AS p5 FROM tr GROUP BY id), "
          "fc AS (SELECT te.id, k, ts, '1' AS model_id, p1 AS prediction FROM te JOIN ag USING (id) UNION ALL "
          "SELECT te.id, te.k, te.ts, '2', tr.y FROM te JOIN tr ON tr.id = te.id AND tr.back <= 7 AND tr.k % 7 = te.k % 7 UNION ALL "
          "SELECT te.id, k, ts, '3', p3 FROM te JOIN ag USING (id) UNION ALL SELECT te.id, k, ts, '4', p4 FROM te JOIN ag USING (id) UNION ALL SELECT te.id, k, ts, '5', p5 FROM te JOIN ag USING (id))")
CAL = MODELS + ", cal AS (SELECT fc.*, te.y AS actual, te.y - prediction AS residual FROM fc JOIN te USING (id, k))"
STEP = CAL + ", st AS (SELECT *, abs(actual - lag(actual) OVER (PARTITION BY model_id, id ORDER BY k)) AS step FROM cal)"
_M = ("count(*) AS n, round(avg(abs(residual)), 6) AS mae, round(100 * avg(CASE WHEN actual <> 0 THEN abs(residual) / abs(actual) END), 6) AS mape, "
      "round(avg(abs(residual)) / nullif(avg(step), 0), 6) AS mase, round(100 * avg(CASE WHEN abs(actual) + abs(prediction) > 0 THEN 2 * abs(residual) / (abs(actual) + abs(prediction)) END), 6) AS smape, "
      "round(sqrt(avg(residual * residual)), 6) AS rmse, round(CASE WHEN var_pop(actual) > 1e-18 AND var_pop(prediction) > 1e-18 * (1 + var_pop(actual)) "
      "THEN pow(covar_pop(actual, prediction), 2) / (var_pop(actual) * var_pop(prediction)) END, 6) AS rsq, count(CASE WHEN actual = 0 THEN 1 END) AS n_zero")
ACC = STEP + ", acc AS (SELECT model_id, id, " + _M + " FROM st GROUP BY 1, 2)"


@query("split_by_date", f"WITH {SPLIT} SELECT id, ts, y, segment FROM sp")
def _(spark, sf):
    return _split(spark, sf).select("id", "ts", "y", "segment")


@query("split_nested_by_id", f"WITH {P.ORDER_DAYS} SELECT id, segment, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM "
       "(SELECT id, ts, CASE WHEN row_number() OVER (PARTITION BY id ORDER BY k DESC) <= 56 THEN 'test' ELSE 'train' END AS segment FROM od) GROUP BY 1, 2")
def _(spark, sf):
    return R.nested_split(P.order_days(spark, sf), 56).groupBy("id", "segment").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def _cv_sql(cum):
    first = "lo" if cum else "hi - i * 28 - 55 - 365"
    return (f"WITH {P.ORDER_DAYS}, b AS (SELECT min(k) AS lo, max(k) AS hi FROM od), s AS (SELECT unnest(range(0, 3)) AS i), "
            f"t AS (SELECT i + 1 AS slice, {first} AS a, hi - i * 28 - 55 AS m, hi - i * 28 AS z FROM s, b WHERE hi - i * 28 - 55 - 365 >= lo) "
            "SELECT CAST(slice AS INTEGER) AS slice, CASE WHEN k >= m THEN 'test' ELSE 'train' END AS role, min(ts) AS start, max(ts) AS \"end\", count(*) AS n FROM od JOIN t ON k BETWEEN a AND z GROUP BY 1, 2")


@query("cv_plan_sliding", _cv_sql(False))
def _(spark, sf):
    return R.cv_plan(R.time_series_cv(P.order_days(spark, sf), "day", initial=365, assess="8 weeks", skip="4 weeks"))


@query("cv_plan_expanding", _cv_sql(True))
def _(spark, sf):
    return R.cv_plan(R.time_series_cv(P.order_days(spark, sf), "day", initial=365, assess=56, skip=28, cumulative=True))


@query("vfold_assignment", f"WITH {P.ORDER_DAYS} SELECT id, ts, CAST(('0x' || substr(md5(concat_ws('|', id, CAST(k AS VARCHAR), '123')), 1, 8))::BIGINT % 10 AS BIGINT) AS fold FROM od")
def _(spark, sf):
    return R.vfold(P.order_days(spark, sf), 10, 123).select("id", "ts", "fold")


@query("forecast_simple_models", f"WITH {MODELS} SELECT model_id, id, ts, round(prediction, 6) AS prediction FROM fc")
def _(spark, sf):
    return _fc(spark, sf)[0].select("model_id", "id", "ts", r("prediction", 6))


@query("calibrate_residuals", f"WITH {CAL} SELECT model_id, id, ts, actual, round(prediction, 6) AS prediction, round(residual, 6) AS residual FROM cal")
def _(spark, sf):
    return _cal(spark, sf).select("model_id", "id", "ts", "actual", r("prediction", 6), r("residual", 6))


def _round_acc(d):
    return d.withColumns({c: F.round(c, 6) for c in E.METRICS})


@query("accuracy_by_id", f"WITH {ACC} SELECT * FROM acc")
def _(spark, sf):
    return _round_acc(E.accuracy(_cal(spark, sf)))


@query("accuracy_global", f"WITH {STEP} SELECT model_id, {_M} FROM st GROUP BY 1")
def _(spark, sf):
    return _round_acc(E.accuracy(_cal(spark, sf), ["model_id"]))


@query("accuracy_in_sample", f"WITH {P.ORDER_DAYS}, f AS (SELECT id, k, y AS actual, lag(y, 7) OVER (PARTITION BY id ORDER BY k) AS prediction FROM od) "
       "SELECT id, 'snaive' AS model_id, count(*) AS n, round(avg(abs(actual - prediction)), 3) AS mae, round(sqrt(avg(pow(actual - prediction, 2))), 3) AS rmse FROM f WHERE prediction IS NOT NULL GROUP BY 1")
def _(spark, sf):
    from tidewheel.operators.windows import augment, lag
    d = augment(P.order_days(spark, sf), prediction=lag("y", 7)).where("prediction IS NOT NULL")
    cal = d.select("id", "k", F.lit("snaive").alias("model_id"), F.col("y").alias("actual"), "prediction", (F.col("y") - F.col("prediction")).alias("residual"))
    return E.accuracy(cal).select("id", "model_id", "n", r("mae", 3), r("rmse", 3))


@query("rmsse_average", f"WITH {CAL}, q AS (SELECT id, avg(d * d) AS q FROM (SELECT id, y - lag(y) OVER (PARTITION BY id ORDER BY k) AS d FROM tr) GROUP BY 1), "
       "m AS (SELECT model_id, id, avg(residual * residual) AS m FROM cal GROUP BY 1, 2) SELECT model_id, round(avg(sqrt(m / q)), 6) AS rmsse, count(*) AS n_series FROM m JOIN q USING (id) GROUP BY 1")
def _(spark, sf):
    s = _split(spark, sf)
    return E.average_scores(E.rmsse(_cal(spark, sf), R.training(s)), ["rmsse"]).withColumn("rmsse", F.round("rmsse", 6))


_SERIES = ["click", "error", "purchase", "signup", "view"]


@query("submission_root_sum_sq", f"WITH {CAL}, e AS (SELECT id, round(sqrt(sum(residual * residual)), 2) AS s FROM cal WHERE model_id = '2' GROUP BY 1) "
       "SELECT " + ", ".join(f"max(CASE WHEN id = '{s}' THEN s END) AS {s}" for s in _SERIES) + ", round(avg(s), 6) AS score FROM e")
def _(spark, sf):
    c = _cal(spark, sf).where("model_id = '2'")
    wide = lambda col: V.pivot_wider(c, ["ts"], "id", col, _SERIES)
    return E.root_sum_sq(wide("actual"), wide("prediction"), _SERIES).withColumn("score", F.round("score", 6))


@query("residual_acf", f"WITH {CAL}, c AS (SELECT model_id, id, k, residual - avg(residual) OVER (PARTITION BY model_id, id) AS x FROM cal), l AS (SELECT unnest(range(0, 4)) AS lag) "
       "SELECT a.model_id, a.id, CAST(lag AS INTEGER) AS lag, round(coalesce(sum(a.x * b.x), 0) / max(q), 6) AS acf FROM (SELECT *, sum(x * x) OVER (PARTITION BY model_id, id) AS q FROM c) a, l LEFT JOIN c b ON b.model_id = a.model_id AND b.id = a.id AND b.k = a.k - lag GROUP BY 1, 2, 3")
def _(spark, sf):
    return D.acf(_cal(spark, sf), "residual", 3, keys=("model_id", "id")).select("model_id", "id", "lag", r("acf", 6))


@query("select_best_overall", f"WITH {STEP}, g AS (SELECT model_id, round(sqrt(avg(residual * residual)), 6) AS rmse FROM st GROUP BY 1) SELECT model_id, rmse FROM (SELECT *, rank() OVER (ORDER BY rmse) AS rk FROM g) WHERE rk <= 2")
def _(spark, sf):
    return E.select_best(_round_acc(E.accuracy(_cal(spark, sf), ["model_id"])), "rmse", 2)


@query("select_best_rsq_by_id", f"WITH {ACC} SELECT id, model_id, rsq FROM (SELECT *, rank() OVER (PARTITION BY id ORDER BY rsq DESC NULLS LAST) AS rk FROM acc) WHERE rk = 1")
def _(spark, sf):
    return E.select_best(_round_acc(E.accuracy(_cal(spark, sf))), "rsq", 1, by_id=True, id_var="id")


@query("best_model_per_id", f"WITH {ACC} SELECT id, model_id, rmse FROM (SELECT *, rank() OVER (PARTITION BY id ORDER BY rmse) AS rk FROM acc) WHERE rk = 1")
def _(spark, sf):
    return E.select_best(_round_acc(E.accuracy(_cal(spark, sf))), "rmse", 1, by_id=True, id_var="id")


@query("forecast_from_best_model", f"WITH {ACC}, b AS (SELECT id, model_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rmse, model_id) AS rk FROM acc) WHERE rk = 1) "
       "SELECT id, model_id, ts, round(prediction, 6) AS prediction FROM fc JOIN b USING (id, model_id)")
def _(spark, sf):
    f, s = _fc(spark, sf)
    acc = _round_acc(E.accuracy(E.calibrate(f, R.testing(s))))
    return E.best_forecast(f, E.select_best(acc, "rmse", 1, True, "id")).select("id", "model_id", "ts", r("prediction", 6))


@query("interval_normal", f"WITH {CAL}, s AS (SELECT model_id, stddev_samp(residual) AS sd FROM cal GROUP BY 1), l(level, z) AS (VALUES (80, {E.Z[80]}), (95, {E.Z[95]})) "
       "SELECT model_id, id, ts, level, round(prediction - z * sd, 5) AS lo, round(prediction + z * sd, 5) AS hi FROM fc JOIN s USING (model_id), l")
def _(spark, sf):
    f, s = _fc(spark, sf)
    return E.interval_normal(f, E.calibrate(f, R.testing(s)), [80, 95]).select("model_id", "id", "ts", "level", r("lo", 5), r("hi", 5))


def _conf_sql(by):
    keys = ", ".join(by)
    return (f"WITH {CAL}, q AS (SELECT {keys}, abs(residual) AS a, row_number() OVER (PARTITION BY {keys} ORDER BY abs(residual)) AS rn, count(*) OVER (PARTITION BY {keys}) AS n FROM cal), "
            f"l(level) AS (VALUES (80), (90)), c AS (SELECT {keys}, level, a FROM q, l WHERE rn = least(n, CAST(ceil((n + 1) * level / 100) AS BIGINT))) "
            f"SELECT model_id, id, ts, level, round(prediction - a, 5) AS lo, round(prediction + a, 5) AS hi FROM fc JOIN c USING ({keys})")


@query("interval_conformal_split", _conf_sql(["model_id"]))
def _(spark, sf):
    f, s = _fc(spark, sf)
    return E.interval_conformal(f, E.calibrate(f, R.testing(s)), [80, 90]).select("model_id", "id", "ts", "level", r("lo", 5), r("hi", 5))


@query("interval_conformal_by_id", _conf_sql(["model_id", "id"]))
def _(spark, sf):
    f, s = _fc(spark, sf)
    d = E.interval_conformal(f, E.calibrate(f, R.testing(s)), [80, 90], ["model_id", "id"])
    return d.select("model_id", "id", "ts", "level", r("lo", 5), r("hi", 5))


@query("forecast_table", f"WITH {MODELS} SELECT 'actual' AS key, NULL AS model_id, id, ts, y AS value FROM sp UNION ALL SELECT 'prediction', model_id, id, ts, round(prediction, 6) FROM fc")
def _(spark, sf):
    f, s = _fc(spark, sf)
    return E.forecast_table(s, f).withColumn("value", F.round("value", 6))


@query("calibrate_evaluate_helper", f"WITH {STEP} SELECT model_id, model_desc, rmse FROM (SELECT model_id, round(sqrt(avg(residual * residual)), 6) AS rmse FROM st GROUP BY 1) "
       "JOIN (VALUES ('1', 'naive'), ('2', 'snaive'), ('3', 'mean of the last week'), ('4', 'median7'), ('5', 'wmean3')) d(model_id, model_desc) USING (model_id)")
def _(spark, sf):
    m = ModelTable().add(N.naive, "naive").combine(ModelTable(dict(list(simple_models().models.items())[1:]))).describe("3", "mean of the last week")
    _, acc, _ = calibrate_evaluate(m, _split(spark, sf), by_id=False)
    return acc.join(m.table(spark), "model_id").select("model_id", "model_desc", r("rmse", 6))


@query("refit_and_forecast_future", f"WITH {P.EVENT_DAYS}, b AS (SELECT id, k, ts, CAST(n AS DOUBLE) AS y, row_number() OVER (PARTITION BY id ORDER BY k DESC) AS back, max(ts) OVER (PARTITION BY id) AS hi FROM ev), "
       "f AS (SELECT DISTINCT id, hi, unnest(range(1, 15)) AS h FROM b) "
       "SELECT f.id, '2' AS model_id, f.hi + CAST(h AS INTEGER) * INTERVAL 1 DAY AS ts, b.y AS prediction FROM f JOIN b ON b.id = f.id AND b.back = 7 - (h - 1) % 7")
def _(spark, sf):
    d = _ev(spark, sf)
    f = refit(simple_models(), d, T.future_frame(d, "day", 14))
    return f.where("model_id = '2'").select("id", "model_id", "ts", "prediction")


@query("expedited_forecast_mean", f"WITH {P.ORDER_DAYS}, l AS (SELECT id, max(ts) AS hi, avg(CASE WHEN back <= 7 THEN y END) AS p FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k DESC) AS back FROM od) GROUP BY 1) "
       "SELECT id, CAST(unnest(generate_series(hi + INTERVAL 1 DAY, hi + INTERVAL 56 DAY, INTERVAL 1 DAY)) AS TIMESTAMP) AS ts, round(p, 3) AS prediction FROM l")
def _(spark, sf):
    d = P.order_days(spark, sf)
    return N.window(d, T.future_frame(d, "day", "8 weeks"), 7).select("id", "ts", r("prediction", 3))


@query("periodic_hold_out_mask", f"WITH {P.EVENT_HOURS}, h AS (SELECT id, ts, date_diff('hour', TIMESTAMP '2024-01-04 01:00:00', ts) AS h FROM eh) "
       "SELECT id, ts, CASE WHEN h >= 0 AND (h % 168 BETWEEN 0 AND 47 OR h % 168 BETWEEN 84 AND 131) THEN 'test' ELSE 'train' END AS segment FROM h")
def _(spark, sf):
    return P.event_hours(spark, sf).select("id", "ts", C.hold_out_mask("ts", "2024-01-04 01:00:00", [(0, 47), (84, 131)]).alias("segment"))


@query("ensemble_mean_median", f"WITH {MODELS} SELECT 'mean' AS model_id, id, ts, round(avg(prediction), 5) AS prediction FROM fc GROUP BY 2, 3 UNION ALL SELECT 'median', id, ts, round(median(prediction), 5) FROM fc GROUP BY 2, 3")
def _(spark, sf):
    f, _ = _fc(spark, sf)
    d = EN.average(f, "mean", "mean").unionByName(EN.average(f, "median", "median"))
    return d.select("model_id", "id", "ts", r("prediction", 5))


@query("ensemble_fixed_weights", f"WITH {MODELS} SELECT id, ts, round(sum(w * prediction) / sum(w), 5) AS prediction FROM fc JOIN (VALUES ('1', 5), ('2', 3), ('3', 1)) l(model_id, w) USING (model_id) GROUP BY 1, 2")
def _(spark, sf):
    return EN.weighted(_fc(spark, sf)[0], {"1": 5, "2": 3, "3": 1}).select("id", "ts", r("prediction", 5))


@query("ensemble_rank_loadings", f"WITH {STEP}, g AS (SELECT model_id, rank() OVER (ORDER BY round(sqrt(avg(residual * residual)), 6) DESC) AS w FROM st GROUP BY 1) "
       "SELECT id, ts, round(sum(w * prediction) / sum(w), 5) AS prediction FROM fc JOIN g USING (model_id) GROUP BY 1, 2")
def _(spark, sf):
    f, s = _fc(spark, sf)
    acc = _round_acc(E.accuracy(E.calibrate(f, R.testing(s)), ["model_id"]))
    return EN.weighted(f, EN.rank_loadings(acc)).select("id", "ts", r("prediction", 5))


@query("resample_native_forecaster", f"WITH {P.EVENT_DAYS}, m AS (SELECT id, ts, k, CAST(n AS DOUBLE) AS y, max(k) OVER () AS hi, min(k) OVER () AS lo FROM ev), s AS (SELECT unnest(range(0, 3)) AS i), "
       "t AS (SELECT m.*, CAST(i + 1 AS INTEGER) AS slice, hi - i * 5 - 4 AS a FROM m, s WHERE k <= hi - i * 5 AND k >= hi - i * 5 - 4 - 14 AND hi - i * 5 - 4 - 14 >= lo), "
       "f AS (SELECT te.slice, te.id, te.ts, te.y, tr.y AS p FROM t te JOIN t tr ON tr.slice = te.slice AND tr.id = te.id AND tr.k < tr.a AND tr.k >= tr.a - 7 AND te.k >= te.a AND tr.k % 7 = te.k % 7) "
       "SELECT slice, id, count(*) AS n, round(sqrt(avg(pow(y - p, 2))), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae FROM f GROUP BY 1, 2")
def _(spark, sf):
    """Every slice of every series in one job: (slice, id) is the key."""
    cv = R.time_series_cv(_ev(spark, sf), "day", initial=14, assess=5, skip=5)
    part = lambda r_: cv.where(F.col("role") == r_).drop("role")
    fc = N.seasonal_naive(part("train"), part("test"), 7, keys=("slice", "id"))
    d = fc.join(part("test").select("slice", "id", "k", "y"), ["slice", "id", "k"]).withColumn("e", F.col("y") - F.col("prediction"))
    return d.groupBy("slice", "id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg(F.col("e") * F.col("e"))), 6).alias("rmse"),
                                        F.round(F.avg(F.abs("e")), 6).alias("mae"))


@query("fit_status_report", "SELECT 'trend + doubled trend' AS model_id, o_orderpriority AS id, 'rank deficient' AS status FROM orders GROUP BY 2")
def _(spark, sf):
    from tidewheel.forecast import linear as L
    d = P.order_days(spark, sf).withColumn("t", F.col("k").cast("double")).withColumn("t2", F.col("t") * 2)
    good = L.fit(d, "y", ["t"]).select(F.lit("trend").alias("model_id"), "id", "status")
    bad = L.fit(d, "y", ["t", "t2"]).select(F.lit("trend + doubled trend").alias("model_id"), "id", "status")
    return E.status_report(good.unionByName(bad))


@query("fit_failure_report", f"WITH {P.ORDER_DAYS}, n AS (SELECT id, CASE id WHEN '2-HIGH' THEN 5 WHEN '3-MEDIUM' THEN 0 ELSE count(*) END AS n_known FROM od GROUP BY 1), "
       "m AS (SELECT n.*, model_id, CASE WHEN model_id = 'broken' THEN 'ValueError: no such engine' WHEN model_id = 'boosted' THEN NULL WHEN n_known = 0 THEN 'no known value' "
       "WHEN model_id = 'arima' AND n_known < 30 THEN n_known || ' known values, needs 30' END AS error FROM n, (VALUES ('smoothing'), ('arima'), ('line'), ('boosted'), ('broken')) v(model_id)) "
       "SELECT model_id, id, CASE WHEN error IS NULL THEN 'ok' ELSE 'failed' END AS status, error, n_known, 14 AS n_asked, CASE WHEN error IS NULL THEN 14 ELSE 0 END AS n_predicted FROM m")
def _(spark, sf):
    """Smoothing, ARIMA, a line per series, one global learner and a broken engine; a constant, a short and an all-NULL series."""
    from tidewheel.forecast import arima as A
    from tidewheel.forecast import learners as M
    from tidewheel.forecast import linear as L
    from tidewheel.forecast import smoothing as S

    d = P.order_days(spark, sf).select("id", "k", "ts", (F.col("y") / 1e5).alias("y"), (F.col("k") / 1000.0).alias("t"))
    fut = T.future_frame(d, "day", 14).withColumn("t", F.col("k") / 1000.0)
    ends = d.groupBy("id").agg(F.max("k").alias("_e"))
    d = d.join(ends, "id").where((F.col("id") != "2-HIGH") | (F.col("k") > F.col("_e") - 5)).withColumn(
        "y", F.when(F.col("id") == "1-URGENT", 5.0).when(F.col("id") != "3-MEDIUM", F.col("y"))).drop("_e")

    def broken(train, future):
        raise ValueError("no such engine")

    models = {"smoothing": lambda a, b: S.ets(a, b, 1), "arima": lambda a, b: A.forecast(a, b, [A.Order(1, 1, 1)]), "line": lambda a, b: L.predict(b, L.fit(a, "y", ["t"]), ["t"]),
              "boosted": lambda a, b: M.boosted(["t"], trees=3).fit(a).transform(b), "broken": broken}
    return E.nested_forecast(models, d, fut, needs={"arima": 30})[1]
