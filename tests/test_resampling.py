"""Time slices, tuning, stacks and the recursive walk against plain versions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from test_operators import noisy, panel
from tidewheel import core as C
from tidewheel.forecast import learners as M
from tidewheel.forecast import resampling as RS
from tidewheel.forecast import walk as WK
from tidewheel.operators import windows as W
from tidewheel.plans import resample as R


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    d = panel(spark, {"a": noisy(120, 1), "b": noisy(120, 2) * 2})
    return d.withColumns({"t": F.col("k") / 1000.0, "u": F.sin(F.col("k") / 3.0)}).withColumn("y", F.col("y") + rng.normal())


def slices(d, cumulative=True):
    return R.time_series_cv(d, "day", initial=40, assess=14, skip=7, cumulative=cumulative, slice_limit=3)


class Recorder:
    """An estimator that remembers the stamps it was given."""

    def __init__(self):
        self.seen = []

    def fit(self, train):
        self.seen.append((train.agg(F.min("k"), F.max("k")).first(), train.columns))
        return M._Fitted(lambda d: d.withColumn("prediction", F.lit(float(train.agg(F.avg("y")).first()[0]))))


@pytest.mark.parametrize("cumulative", [True, False])
def test_slices_never_learn_from_their_future(frame, cumulative):
    cv, rec = RS.Resamples.of(slices(frame, cumulative)), Recorder()
    p = RS.fit_resamples(cv, {"mean": rec}, workers=1).toPandas()
    assert cv.timed and cv.names == (1, 2, 3) and len(p) == 3 * 14 * 2
    for s, ((lo, hi), cols) in zip(cv.names, rec.seen):
        test = p[p.slice == s]
        assert hi < test.k.min() and lo == (10000 if cumulative else hi - 39) and "role" not in cols and "slice" not in cols
        train = frame.where(F.col("k").between(lo, hi)).agg(F.avg("y")).first()[0]
        assert test.prediction.unique() == pytest.approx([train])


def test_folds_leave_their_rows_out(frame):
    p = RS.fit_resamples(R.vfold(frame, 4), {"lm": M.linear(["t", "u"])}).toPandas()
    rows = R.vfold(frame, 4).toPandas()
    assert len(p) == len(rows)
    for f in range(4):
        tr, te = rows[rows.fold != f], rows[rows.fold == f].set_index(["id", "k"]).sort_index()
        x = lambda d: np.column_stack([np.ones(len(d)), d.t, d.u])
        want = x(te) @ np.linalg.lstsq(x(tr), tr.y, rcond=None)[0]
        np.testing.assert_allclose(p[p.slice == f].set_index(["id", "k"]).sort_index().prediction, want, rtol=1e-6)


def test_metrics_over_slices(frame):
    p = RS.fit_resamples(slices(frame), {"lm": M.linear(["t"]), "lm2": M.linear(["t", "u"])})
    got = {r.model_id: r for r in RS.resample_metrics(p).collect()}
    d = p.toPandas()
    for m in ("lm", "lm2"):
        per = d[d.model_id == m].groupby("slice").apply(lambda g: pd.Series({"rmse": np.sqrt(((g.y - g.prediction) ** 2).mean()), "mae": abs(g.y - g.prediction).mean(),
                                                                            "rsq": np.corrcoef(g.y, g.prediction)[0, 1] ** 2}), include_groups=False)
        assert got[m].rmse == pytest.approx(per.rmse.mean()) and got[m].mae == pytest.approx(per.mae.mean()) and got[m].rsq == pytest.approx(per.rsq.mean())
        assert got[m].n_splits == 3 and got[m].rmse_se == pytest.approx(per.rmse.std() / np.sqrt(3))


def test_needs_resampled_rows_and_passes_errors_on(frame, spark):
    with pytest.raises(ValueError):
        RS.Resamples.of(frame)
    with pytest.raises(ZeroDivisionError):
        RS.side_by_side(spark, [lambda: 1, lambda: 1 // 0])
    assert RS.side_by_side(spark, [lambda i=i: i for i in range(9)], 3) == list(range(9))
    none = slices(frame).where("false")
    assert RS.out_of_fold(none, {"lm": M.linear(["t"])}).count() == 0


def test_tune_finalize_and_refit(frame):
    build = lambda p: M.linear(["t"], penalty=p["penalty"])
    points = [{"penalty": 50.0}, {"penalty": 0.0}, {"penalty": 0.0}]
    t = RS.tune(slices(frame), build, points)
    rows = t.collect()
    assert len(rows) == 3 and rows[0].rmse <= rows[1].rmse <= rows[2].rmse and rows[0].n_splits == 3
    assert RS.best_params(t) == (points[1] if rows[0]["set"] == 1 else points[0])
    assert RS.show_best(t, n=1).first().rmse == rows[0].rmse
    model = RS.finalize(build, t).fit(frame)
    want = M.linear(["t"], penalty=RS.best_params(t)["penalty"]).fit(frame)
    a, b = (m.transform(frame).agg(F.sum("prediction")).first()[0] for m in (model, want))
    assert a == pytest.approx(b)
    tuned = RS.Tuned(build, points, slices).fit(frame)
    assert tuned.transform(frame).agg(F.sum("prediction")).first()[0] == pytest.approx(a)


def test_leaderboard_and_refit_by_name(frame):
    cands = {"flat": M.linear(["t"], penalty=1e4), "lm": M.linear(["t", "u"]), "bad": M.linear(["u"])}
    board = RS.leaderboard(slices(frame), cands, exclude=["bad"])
    assert sorted(r.model for r in board.collect()) == ["flat", "lm"]
    best = RS.refit(cands, frame, board).transform(frame)
    named = RS.refit(cands, frame, board.first()["model"]).transform(frame)
    assert best.agg(F.sum("prediction")).first() == named.agg(F.sum("prediction")).first()


def test_stack_learns_on_what_the_submodels_did_not_see(frame):
    subs = {"lm": M.linear(["t"]), "wave": M.linear(["u"])}
    stack = RS.Stack(subs, M.linear(list(subs)), slices)
    model = stack.fit(frame)
    got = model.transform(frame).orderBy("id", "k").toPandas()
    oof = RS.out_of_fold(slices(frame), subs).toPandas()
    x = lambda d: np.column_stack([np.ones(len(d)), d.lm, d.wave])
    w = np.linalg.lstsq(x(oof), oof.y, rcond=None)[0]
    full = frame
    for n, e in subs.items():
        full = e.fit(frame).transform(full).withColumnRenamed("prediction", n).drop("features")
    np.testing.assert_allclose(got.prediction, x(full.orderBy("id", "k").toPandas()) @ w, rtol=1e-5)
    assert "lm" not in got.columns
    half = frame.where("k < 10060")
    kept = model.refit(half)
    assert kept.meta is model.meta and kept.submodels["lm"] is not model.submodels["lm"]
    assert model.refit(half, meta=True).meta is not model.meta
    level2 = RS.Stack({"s": stack, "lm": subs["lm"]}, M.linear(["s", "lm"]), lambda d: R.vfold(d, 2)).fit(frame)
    assert level2.transform(frame).where("prediction IS NULL").count() == 0


# ------------------------------------------------------------------ recursion

def loop(model, x_of, hist, horizon, depth):
    """One series, one step at a time, through the model's own transform."""
    v, out = list(hist), []
    for h in range(horizon):
        out.append(model(x_of(v[-depth:], h)))
        v.append(out[-1])
    return out


@pytest.mark.parametrize("kind", ["linear", "boosted", "forest", "scaled"])
def test_walk_equals_a_plain_loop(spark, kind):
    lags, n, horizon = [1, 2, 7], 90, 12
    series = {"a": noisy(n, 1), "b": noisy(n, 2) * 3}
    d = panel(spark, series)
    cal = lambda f: f.withColumn("wd", F.pmod("k", F.lit(7)).cast("double"))
    train = cal(W.augment_lags(d, ["y"], lags)).dropna()
    xs = ["wd", *[f"y_lag{l}" for l in lags]]
    est = {"linear": M.linear(xs), "boosted": M.boosted(xs, trees=4), "forest": M.forest(xs, trees=5, min_n=3, mtry=2),
           "scaled": M._pipe(xs, "y", M.LinearRegression(), scale=True)}[kind]
    m = est.fit(train)
    last = next(s for s in m.stages if hasattr(s, "predict"))
    scale = next((s for s in m.stages if hasattr(s, "std")), None)
    from pyspark.ml.linalg import Vectors

    def one(x):
        x = np.array(x)
        return last.predict(Vectors.dense((x - scale.mean.toArray()) / scale.std.toArray() if scale else x))
    fut = d.groupBy("id").agg(F.max("k").alias("m")).select("id", F.explode(F.sequence(F.col("m") + 1, F.col("m") + horizon)).alias("k")).withColumn("ts", C.step_start("k", "day"))
    got = WK.walk(d, fut, [m], WK.lag_transform(lags), 7, features=cal, series=1).toPandas().set_index(["id", "k"]).prediction
    for i, v in series.items():
        want = loop(one, lambda s, h: [(10000 + n + h) % 7, *[s[-l] for l in lags]], v, horizon, 7)
        np.testing.assert_allclose([got[i, 10000 + n + h] for h in range(horizon)], want, rtol=1e-9)


def test_walk_returns_every_stamp_and_own_transforms(spark):
    d = panel(spark, {"a": noisy(40), "b": [1.0, 2.0], "c": [None] * 30})
    fut = spark.createDataFrame([(i, k) for i in ("a", "b", "c", "new") for k in (10020, 10040, 10041, 10043, 10041)] + [(None, 10050)], "id string, k bigint").withColumn("ts", C.step_start("k", "day"))
    rolls = lambda s: {"y_lag1": s[:, -1], "y_roll3": s[:, -3:].mean(1)}
    train = W.augment(d, y_lag1=W.lag("y", 1), l2=W.lag("y", 2), l3=W.lag("y", 3)).withColumn("y_roll3", (F.col("y_lag1") + F.col("l2") + F.col("l3")) / 3)
    m = M.linear(["y_lag1", "y_roll3"]).fit(train)
    got = WK.walk(d, fut, [m], rolls, 3).toPandas()
    assert len(got) == 21 and got[got.id != "a"].prediction.isna().all()
    a = got[got.id == "a"].set_index("k").prediction
    assert np.isnan(a[10020]) and a[10040] == a[10040] and len(a[10041].unique()) == 1 and np.isnan(a[10043])
    model, y = m.stages[1], noisy(40)
    assert a[10040] == pytest.approx(model.intercept + model.coefficients[0] * y[-1] + model.coefficients[1] * y[-3:].mean())
    assert WK.walk(d, fut.where("false"), [m], rolls, 3).count() == 0


def test_walk_refuses_what_it_cannot_read(spark):
    d = panel(spark, {"a": noisy(40)}).withColumn("t", F.col("k") / 1000.0)
    with pytest.raises(TypeError):
        WK.walker(M.kernel_poly(["t"]).fit(d))
