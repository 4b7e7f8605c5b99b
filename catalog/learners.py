"""Queries for global learners, recursion, boosted residuals, stacking and tuning."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog import panels as P
from catalog.panels import r
from tidewheel.forecast import arima as A
from tidewheel.forecast import ensemble as EN
from tidewheel.forecast import learners as M
from tidewheel.forecast import resampling as RS
from tidewheel.forecast import structural as ST
from tidewheel.forecast import walk as WK
from tidewheel.operators import features as FT
from tidewheel.operators import timeverbs as T
from tidewheel.operators import windows as W
from tidewheel.plans import resample as R
from tidewheel.plans.recipes import Recipe
from tidewheel.session import cut_lineage

_SEAS = ["sin7_k1", "cos7_k1", "sin365_k1", "cos365_k1"]
_IDS = [f"id_{i}" for i in range(1, 6)]
XS = ["trend", *_SEAS, *_IDS, "y_lag56", "y_roll"]


def calendar(d):
    ids = {f"id_{i}": F.when(F.substring("id", 1, 1) == str(i), 1.0).otherwise(0.0) for i in range(1, 6)}
    return d.withColumns({"trend": F.col("k") / 1000.0, **FT.fourier_terms([7, 365], 1), **ids})


def prepared(spark, sf):
    """Training rows and the future frame with calendar, id and lag-56 features."""
    d = P.order_days(spark, sf).select("id", "k", "ts", (F.col("y") / 1e5).alias("y"))
    full = T.future_frame(d, "day", 56, bind=True)
    full = W.augment(full, y_lag56=W.lag("y", 56))
    full = W.augment(full, y_roll=W.slide("y_lag56", 30, partial=True))
    full = cut_lineage(calendar(full))
    return full.where("y IS NOT NULL AND y_lag56 IS NOT NULL"), full.where("y IS NULL")


def _out(d, name="prediction"):
    return d.select("id", "ts", r(name, 4, "prediction"))


def _register(name, build):
    @query(name)
    def _(spark, sf, build=build):
        train, fut = prepared(spark, sf)
        return _out(build().fit(train).transform(fut))


_register("linear_regression_global", lambda: M.linear(XS))
_register("ridge_regression", lambda: M.linear(XS, penalty=0.1))
_register("lasso_regression", lambda: M.linear(XS, penalty=0.01, mixture=1.0))
_register("elastic_net_regression", lambda: M.linear(XS, penalty=0.01, mixture=0.5))
_register("hinge_regression", lambda: M.hinge_regression(["trend", "y_lag56", "y_roll"]))
_register("kernel_linear", lambda: M.kernel_poly(["trend", *_SEAS, "y_lag56", "y_roll"], degree=1))
_register("kernel_polynomial", lambda: M.kernel_poly(["trend", *_SEAS, "y_lag56", "y_roll"]))
_register("kernel_rbf", lambda: M.kernel_rbf(["trend", *_SEAS, "y_lag56", "y_roll"], n=30))
_register("random_forest_global", lambda: M.forest(XS, trees=10))
_register("boosted_trees_global", lambda: M.boosted(XS, trees=10))
_register("model_tree_committees", lambda: M.ModelTree(["trend", *_SEAS, "y_lag56", "y_roll"]))


@query("linear_recipe_forecast")
def _(spark, sf):
    """Recipe (normalised trend, weekday dummies, natural spline) learned on training rows only."""
    train, fut = prepared(spark, sf)
    cols = ["id", "k", "ts", "y", "trend", "y_lag56"]
    rec = (Recipe("y", {"id": "id", "k": "index", "ts": "index"}).step_naomit("y_lag56").step_signature("ts", ["wday"])
           .step_dummy("wday").step_ns("trend", 3).step_normalize("^y_lag"))
    fit = rec.fit(train.select(*cols))
    return _out(M.linear(fit.predictors()).fit(fit.juice).transform(fit.transform(fut.select(*cols))))


@query("knn_regression")
def _(spark, sf):
    train, fut = prepared(spark, sf)
    return _out(M.knn(train, fut, ["sin7_k1", "cos7_k1", "sin365_k1", "cos365_k1", "y_roll"], k=50))


@query("feature_importance")
def _(spark, sf):
    train, _ = prepared(spark, sf)
    return M.importance(M.boosted(XS, trees=5).fit(train), XS, spark).withColumn("importance", F.round("importance", 4))


@query("arima_boosted_residuals")
def _(spark, sf):
    train, fut = prepared(spark, sf)
    order = [A.Order(1, 1, 1)]
    _, rows, _, _ = A.fit(train, order)
    fitted = cut_lineage(rows.select("id", "k", "fitted").join(train, ["id", "k"]))
    return _out(M.boost_residuals(fitted, A.forecast(train, fut, order), fut, ["trend", *_SEAS, "y_lag56"]))


@query("additive_boosted_residuals")
def _(spark, sf):
    train, fut = prepared(spark, sf)
    fc, fitted = ST.additive(train, fut, n_change=10, with_fitted=True)
    return _out(M.boost_residuals(cut_lineage(fitted), fc, fut, ["trend", *_SEAS, "y_lag56"]))


_LAGS = [1, 2, 7, 14, 30]


def _recursive(spark, sf, builds):
    """Eight weeks ahead on short lags: every prediction of a series feeds its later ones."""
    d = P.order_days(spark, sf).select("id", "k", "ts", (F.col("y") / 1e5).alias("y"))
    train = cut_lineage(calendar(W.augment_lags(d, ["y"], _LAGS)).dropna())
    xs = ["trend", *_SEAS, *[f"y_lag{l}" for l in _LAGS]]
    models = [b(xs).fit(train) for b in builds]
    return _out(WK.walk(d, T.future_frame(d, "day", 56), models, WK.lag_transform(_LAGS), max(_LAGS), features=calendar))


@query("recursive_boosted_panel")
def _(spark, sf):
    return _recursive(spark, sf, [lambda xs: M.boosted(xs, trees=20)])


@query("recursive_ensemble")
def _(spark, sf):
    return _recursive(spark, sf, [lambda xs: M.linear(xs), lambda xs: M.forest(xs, trees=50, mtry=5)])


@query("recursive_linear_per_id")
def _(spark, sf):
    d = P.order_days(spark, sf).select("id", "k", "ts", (F.col("y") / 1e5).alias("y"))
    return _out(M.recursive_linear(d, T.future_frame(d, "day", 56), [1, 2, 7, 14, 30]))


# ------------------------------------------------------------------ resamples

_T = ["t"]


def _slices(d):
    """Expanding slices: at least 6 months to learn from, 8 weeks to test, 4 weeks apart."""
    return R.time_series_cv(d, "day", initial="6 months", assess="8 weeks", skip="4 weeks", cumulative=True, slice_limit=3)


def _trend(spark, sf):
    return P.order_days(spark, sf).select("id", "k", "ts", (F.col("y") / 1e5).alias("y"), (F.col("k") / 1000.0).alias("t"))


_CV = (f"{P.ORDER_DAYS}, m AS (SELECT id, ts, k, y / 1e5 AS y, k / 1000.0 AS t, max(k) OVER () AS hi, min(k) OVER () AS lo FROM od), "
       "cv AS (SELECT m.*, CAST(i + 1 AS INTEGER) AS slice, k > hi - i * 28 - 56 AS test FROM m, (SELECT unnest(range(0, 3)) AS i) WHERE k <= hi - i * 28 AND hi - i * 28 - 55 - 183 >= lo)")
# A penalty shrinks the slope of one standardised regressor by 1 + penalty / sd(y).
_RIDGE = "avg(y) AS ym, avg(t) AS tm, covar_pop(y, t) / var_pop(t) / (1 + penalty / stddev_pop(y)) AS b"
_GRID = "g AS (SELECT CAST(i AS INTEGER) AS set, i * 0.25 AS penalty FROM (SELECT unnest(range(0, 3)) AS i))"
_TUNED = (f"{_CV}, {_GRID}, f AS (SELECT set, slice, {_RIDGE} FROM cv, g WHERE NOT test GROUP BY set, slice, penalty), "
          "e AS (SELECT set, slice, sqrt(avg(pow(y - ym - b * (t - tm), 2))) AS rmse, avg(abs(y - ym - b * (t - tm))) AS mae FROM cv JOIN f USING (slice) WHERE test GROUP BY 1, 2), "
          "r AS (SELECT set, avg(rmse) AS rmse, avg(mae) AS mae, stddev_samp(rmse) / sqrt(count(*)) AS rmse_se, count(*) AS n_splits FROM e GROUP BY 1)")


@query("resample_learner_slices", f"WITH {_CV}, f AS (SELECT slice, regr_slope(y, t) AS b, regr_intercept(y, t) AS a, max(ts) AS learned_to FROM cv WHERE NOT test GROUP BY 1) "
       "SELECT slice, id, min(ts) AS tested_from, max(learned_to) < min(ts) AS in_time, count(*) AS n, round(sqrt(avg(pow(y - a - b * t, 2))), 6) AS rmse, round(avg(abs(y - a - b * t)), 6) AS mae "
       "FROM cv JOIN f USING (slice) WHERE test GROUP BY 1, 2")
def _(spark, sf):
    """Least squares on every slice's training rows; no test stamp before its slice's last training stamp."""
    cv = RS.Resamples.of(_slices(_trend(spark, sf)))
    ends = cv.rows.where("role = 'train'").groupBy("slice").agg(F.max("ts").alias("learned_to"))
    p = RS.fit_resamples(cv, {"lm": M.linear(_T)}).withColumn("e", F.col("y") - F.col("prediction")).join(ends, "slice")
    return p.groupBy("slice", "id").agg(F.min("ts").alias("tested_from"), (F.max("learned_to") < F.min("ts")).alias("in_time"), F.count("e").alias("n"),
                                        F.round(F.sqrt(F.avg(F.col("e") * F.col("e"))), 6).alias("rmse"), F.round(F.avg(F.abs("e")), 6).alias("mae"))


def _ridge(p):
    return M.linear(_T, penalty=p["penalty"])


_PENALTIES = M.grid_points({"penalty": (0.0, 0.5)}, 3, "regular")


@query("tune_time_slices", f"WITH {_TUNED} SELECT set, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(rmse_se, 6) AS rmse_se, n_splits FROM r")
def _(spark, sf):
    t = RS.tune(_slices(_trend(spark, sf)), _ridge, _PENALTIES)
    return t.select("set", r("rmse", 6), r("mae", 6), r("rmse_se", 6), "n_splits")


@query("finalize_refit_forecast", f"WITH {_TUNED}, best AS (SELECT set FROM r ORDER BY round(rmse, 9), set LIMIT 1), a AS (SELECT {_RIDGE} FROM m, g JOIN best USING (set) GROUP BY penalty), "
       "z AS (SELECT id, max(k) AS k, max(ts) AS ts FROM od GROUP BY 1), h AS (SELECT unnest(range(1, 57)) AS h) "
       "SELECT id, ts + CAST(h AS INTEGER) * INTERVAL 1 DAY AS ts, round(ym + b * ((k + h) / 1000.0 - tm), 4) AS prediction FROM z, h, a")
def _(spark, sf):
    """Best penalty over the slices, learned again from all rows, eight weeks ahead."""
    d = _trend(spark, sf)
    best = RS.finalize(_ridge, RS.tune(_slices(d), _ridge, _PENALTIES).withColumn("rmse", F.round("rmse", 9)))
    fut = T.future_frame(d, "day", 56).withColumn("t", F.col("k") / 1000.0)
    return _out(best.fit(d).transform(fut))


def _subs(*names):
    every = {"lm": M.linear(XS), "rf": M.forest(XS, trees=20, mtry=5), "gbt": M.boosted(XS, trees=10)}
    return {n: every[n] for n in names or every}


def _stacked(spark, sf, meta, split=_slices):
    train, fut = prepared(spark, sf)
    return RS.Stack(_subs(), meta, split).fit(train).transform(fut)


def _tuned_net():
    points = M.grid_points({"penalty": (1e-3, 1.0), "mixture": (0.0, 1.0)}, 3, log=["penalty"])
    return RS.Tuned(lambda p: M.linear(["lm", "rf", "gbt"], penalty=p["penalty"], mixture=p["mixture"]), points)


@query("stacked_elastic_net")
def _(spark, sf):
    """Sub-models tried on time slices; penalty and mixture of the meta-learner tuned over folds of what they predicted."""
    return _out(_stacked(spark, sf, _tuned_net()))


@query("stacked_boosted")
def _(spark, sf):
    points = M.grid_points({"depth": (1, 4)}, 3, "regular")
    meta = RS.Tuned(lambda p: M.boosted(["lm", "rf", "gbt"], trees=10, depth=int(p["depth"])), points)
    return _out(_stacked(spark, sf, meta, lambda d: R.vfold(d, 3)))


@query("stacked_kernel_model_tree")
def _(spark, sf):
    """Two more meta-learners on the same out-of-fold rows: polynomial kernel and model tree, averaged."""
    train, fut = prepared(spark, sf)
    poly = RS.Stack(_subs("lm", "gbt"), M.kernel_poly(["lm", "gbt"]), _slices).fit(train)
    tree = RS.StackModel(poly.stack, poly.submodels, M.ModelTree(["lm", "gbt"], committees=1).fit(cut_lineage(RS.out_of_fold(_slices(train), poly.stack.learners))))
    cols = ["id", "k", "ts", "prediction"]
    both = poly.transform(fut).select(*cols, F.lit("a").alias("model_id")).unionByName(tree.transform(fut).select(*cols, F.lit("b").alias("model_id")))
    return _out(EN.average(both, "mean", "mean"))


@query("multi_level_stack")
def _(spark, sf):
    """Weighted average of two stacks, their sub-models learned again from all rows before forecasting."""
    train, fut = prepared(spark, sf)
    last = train.agg(F.max("k")).scalar()
    early = train.where(F.col("k") <= last - 56)
    a = RS.Stack(_subs("lm", "rf"), M.linear(["lm", "rf"]), _slices).fit(early).refit(train)
    b = RS.Stack(_subs("lm", "gbt"), M.linear(["lm", "gbt"], penalty=0.01), lambda d: R.vfold(d, 3)).fit(early).refit(train, meta=True)
    cols = ["id", "k", "ts", "model_id", "prediction"]
    both = [m.transform(fut).withColumn("model_id", F.lit(n)).select(*cols) for n, m in (("a", a), ("b", b))]
    return _out(EN.weighted(both[0].unionByName(both[1]), {"a": 3, "b": 1}))


@query("tune_latin_hypercube")
def _(spark, sf):
    train, _ = prepared(spark, sf)
    points = M.grid_points({"penalty": (1e-3, 1.0), "mixture": (0.0, 1.0)}, 3, log=["penalty"])
    t = RS.tune(_slices(train), lambda p: M.linear(XS, penalty=p["penalty"], mixture=p["mixture"]), points)
    return t.select("set", r("rmse", 3), r("mae", 3))


def _candidates():
    return {"lm": M.linear(XS), "lasso": M.linear(XS, penalty=.01, mixture=1.0), "rf": M.forest(XS, trees=10), "gbt": M.boosted(XS, trees=5)}


@query("automl_leaderboard")
def _(spark, sf):
    """Ten folds."""
    train, _ = prepared(spark, sf)
    return RS.leaderboard(R.vfold(train, 10), _candidates(), exclude=["gbt"]).select("model", r("rmse", 3), r("mae", 3), "n_splits")


@query("automl_forecast")
def _(spark, sf):
    """The best candidate over time slices, fitted again by its name."""
    train, fut = prepared(spark, sf)
    cands = _candidates()
    board = cut_lineage(RS.leaderboard(_slices(train), cands))
    return _out(RS.refit(cands, train, board.orderBy("rmse")).transform(fut))
