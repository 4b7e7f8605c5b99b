"""Operators on small frames against brute force and known answers."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewheel import core as C
from tidewheel.forecast import arima as A
from tidewheel.forecast import ensemble as EN
from tidewheel.forecast import learners as M
from tidewheel.forecast import linear as L
from tidewheel.forecast import native as N
from tidewheel.forecast import smoothing as S
from tidewheel.forecast import structural as ST
from tidewheel.operators import anomaly as AN
from tidewheel.operators import decompose as DC
from tidewheel.operators import diagnostics as D
from tidewheel.operators import features as FT
from tidewheel.operators import timeverbs as T
from tidewheel.operators import transforms as X
from tidewheel.operators import tsfeatures as TF
from tidewheel.operators import windows as W
from tidewheel.plans import evaluate as E
from tidewheel.plans import resample as R
from tidewheel.plans.recipes import Recipe
from tidewheel.sources import competition as CP
from tidewheel.sources import io


def panel(spark, series, step="day", start=10000):
    """{id: values} -> id, k, ts, y; None marks an unknown value."""
    rows = [(i, start + j, None if v is None else float(v)) for i, vs in series.items() for j, v in enumerate(vs)]
    d = spark.createDataFrame(rows, "id string, k bigint, y double")
    return d.select("id", "k", C.step_start("k", step).alias("ts"), "y")


def noisy(n, seed=0):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 50 + 0.1 * t + 8 * np.sin(2 * np.pi * t / 7) + rng.normal(0, 1, n)


@pytest.mark.parametrize("step", ["second", "15 minutes", "hour", "day", "week", "2 weeks", "month", "quarter", "year"])
def test_step_index_round_trip(spark, step):
    d = spark.sql("SELECT timestamp_ntz'2024-02-29 13:45:10' AS ts UNION ALL SELECT timestamp_ntz'1969-07-20 20:17:40'")
    r = d.select("ts", C.step_index("ts", step).alias("k")).withColumn("s", C.step_start("k", step)).withColumn("n", C.step_start(F.col("k") + 1, step)).collect()
    for x in r:
        assert x.s <= x.ts < x.n


def test_week_starts_on_sunday(spark):
    r = spark.sql("SELECT timestamp_ntz'2024-01-01 05:00:00' AS ts").select(C.floor_time("ts", "week").alias("w")).first()
    assert r.w == dt.datetime(2023, 12, 31)


def test_chunked_windows_equal_plain(spark):
    y = noisy(200)
    d = panel(spark, {"a": y, "b": y[:55] * 2})
    f = dict(l=W.lag("y", 9), lead=W.lag("y", -4), m=W.slide("y", 12, align="center"), df=W.diff("y", 3, 2), lo=W.loess("y", 9))
    key = lambda x: {(r.id, r.k): tuple(r[c] for c in f) for r in x.collect()}
    small, big = key(W.augment(d, size=5, **f)), key(W.augment(d, **f))
    assert small.keys() == big.keys() and len(small) == 255
    for k in small:
        np.testing.assert_allclose(np.array(small[k], float), np.array(big[k], float))


def test_loess_degrees_against_polyfit(spark):
    y = noisy(40)
    for deg in (0, 1, 2):
        r = {x.k - 10000: x.s for x in W.augment(panel(spark, {"a": y}), s=W.loess("y", 10, deg)).collect()}
        for t in (0, 3, 20, 39):
            j = np.arange(max(0, t - 5), min(40, t + 6))
            w = (1 - (np.abs(j - t) / 6) ** 3) ** 3
            assert r[t] == pytest.approx(np.polyval(np.polyfit(j - t, y[j], deg, w=np.sqrt(w)), 0), rel=1e-6)


def test_neighbours_cross_chunks(spark):
    v = [None] * 30
    v[2], v[27] = 1.0, 26.0
    d = C.with_neighbours(panel(spark, {"a": v}), "y", size=4)
    for r in d.collect():
        k = r.k - 10000
        assert (r._prev.k - 10000 if r._prev else None) == (None if k < 2 else 2 if k < 27 else 27)
        assert (r._next.k - 10000 if r._next else None) == (2 if k <= 2 else 27 if k <= 27 else None)


def test_impute_linear_and_ends(spark):
    r = {x.k - 10000: x.y for x in DC.impute(panel(spark, {"a": [None, 1, None, None, 4, None]})).collect()}
    assert [r[i] for i in range(6)] == pytest.approx([1, 1, 2, 3, 4, 4])


def test_position_and_rank(spark):
    rng = np.random.default_rng(1)
    ks = np.sort(rng.choice(5000, 300, replace=False))
    d = spark.createDataFrame([("a", int(k), float(rng.integers(0, 40))) for k in ks], "id string, k bigint, y double").withColumn("ts", C.step_start("k", "day"))
    p = {r.k: r.pos for r in C.with_position(d, name="pos", size=16).collect()}
    assert [p[int(k)] for k in ks] == list(range(1, 301))
    r = C.running(d, "y", rank="rk", rows=16).orderBy("rk").collect()
    assert [x.rk for x in r] == list(range(1, 301))
    assert [(x.y, x.k) for x in r] == sorted((x.y, x.k) for x in r)


@pytest.mark.parametrize("n", [1, 2, 3, 6, 7, 101, 5000])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    hot, cold = rng.normal(size=n), rng.integers(0, 5, size=max(1, n // 3)).astype(float)
    d = spark.createDataFrame([("h", float(v)) for v in hot] + [("c", float(v)) for v in cold], "id string, v double")
    probs = {"a": 0.0, "b": .1, "c": .25, "d": .5, "e": .75, "f": .999, "g": 1.0}
    got = {r.id: r for r in C.exact_quantiles(d, "v", probs, keys=["id"], accuracy=200).collect()}
    for i, v in (("h", hot), ("c", cold)):
        for name, p in probs.items():
            assert got[i][name] == pytest.approx(np.quantile(v, p), abs=1e-12)
    one = C.exact_quantiles(d.where("id = 'h'"), "v", {"m": .5}).first()
    assert one.m == pytest.approx(np.median(hot))


def test_conformal_rank(spark):
    res = spark.createDataFrame([("m", "a", i, float(i)) for i in range(1, 20)], "model_id string, id string, k bigint, residual double")
    fc = spark.createDataFrame([("m", "a", 99, 100.0)], "model_id string, id string, k bigint, prediction double")
    r = {x.level: (x.lo, x.hi) for x in E.interval_conformal(fc, res, [80, 90, 95]).collect()}
    assert r == {80: (84.0, 116.0), 90: (82.0, 118.0), 95: (81.0, 119.0)}


def test_pad_idempotent_and_fills_only_new(spark):
    d = panel(spark, {"a": [1, None, 3]}).where("k <> 10001").union(panel(spark, {"b": [None, 2]}))
    p = T.pad_by_time(d, "day", fill={"y": 0.0})
    key = lambda x: sorted((r.id, r.k, r.y) for r in x.select("id", "k", "y").fillna(-1.0).collect())
    assert key(p) == [("a", 10000, 1.0), ("a", 10001, 0.0), ("a", 10002, 3.0), ("b", 10000, -1.0), ("b", 10001, 2.0)]
    assert key(T.pad_by_time(p, "day", fill={"y": 0.0})) == key(p)


def test_grid_spans_chunks(spark):
    b = spark.createDataFrame([("a", 3, 40), ("b", 7, 7)], "id string, _lo bigint, _hi bigint")
    assert sorted((r.id, r.k) for r in T.grid(b, "day", size=10).collect()) == [("a", k) for k in range(3, 41)] + [("b", 7)]


def test_partial_dates():
    assert T.expand_date("2019-02", end=True) == dt.datetime(2019, 2, 28, 23, 59, 59, 999999)
    assert T.expand_date("2019") == dt.datetime(2019, 1, 1)
    assert T.plus_time("2024-01-31", "1 month") == dt.datetime(2024, 2, 29)
    assert T.horizon_cells("8 weeks", "day") == 56 and T.horizon_cells("2 quarters", "month") == 6


def test_calendar_offsets_clamp(spark):
    rows = [("Monthly", "2023-01-31", 2, "2023-02-28"), ("Yearly", "2024-02-29", 2, "2025-02-28"), ("Weekly", "2024-01-01", 3, "2024-01-15"),
            ("Quarterly", "2023-11-30", 2, "2024-02-29"), ("Daily", "2024-02-28", 3, "2024-03-01")]
    d = spark.createDataFrame(rows, "p string, s string, n int, want string")
    for r in d.select(CP.calendar_offset(F.col("s").cast("timestamp_ntz"), "p", "n").cast("date").cast("string").alias("got"), "want").collect():
        assert r.got == r.want


def test_lead_time_join_latest_issue(spark):
    p = spark.sql("SELECT 'a' AS id, timestamp_ntz'2024-01-02 00:00:00' AS ts, 1.0D AS y")
    f = spark.sql("SELECT 'a' AS id, timestamp_ntz'2024-01-01 00:00:00' AS issue, 24 AS hors, 5.0D AS ws UNION ALL SELECT 'a', timestamp_ntz'2024-01-01 12:00:00', 12, 7.0D")
    assert CP.lead_time_join(p, f).first().ws == 7.0
    assert CP.lead_time_join(p, f, "2024-01-01 06:00:00").first().ws == 5.0


def test_transform_round_trip(spark):
    d = panel(spark, {"a": noisy(60), "b": np.arange(1, 40)})
    z, params = X.log_interval_standardize(d, train=F.col("k") < 10030)
    back = X.invert_forecast(z.withColumn("prediction", F.col("z")).withColumn("actual", F.col("y")).withColumn("residual", F.lit(0.0)), params, ["prediction"])
    for r in back.where("k < 10030").collect():
        assert r.prediction == pytest.approx(r.y) and r.residual == pytest.approx(0, abs=1e-6)
    assert back.where("id = 'b' AND k > 10033 AND prediction IS NOT NULL").count() == 0  # beyond the learned limit
    flat = panel(spark, {"c": [5, 5, 5]})
    assert X.standardize_vec(flat).where("z IS NOT NULL").count() == 0
    assert D.acf(flat, max_lag=1).where("acf IS NOT NULL").count() == 0
    b = X.box_cox_vec(d, lam=0.3).withColumn("back", __import__("tidewheel.functions.scalars", fromlist=["x"]).box_cox_inv("z", 0.3))
    assert all(r.back == pytest.approx(r.y) for r in b.collect())


def test_pacf_against_regression(spark):
    y = noisy(120)
    got = {r.lag: r.pacf for r in D.pacf(panel(spark, {"a": y}), "y", 4).collect()}
    x = y - y.mean()
    rho = np.array([1.0] + [(x[k:] * x[:-k]).sum() / (x * x).sum() for k in range(1, 5)])
    for k in range(1, 5):
        t = np.array([[rho[abs(i - j)] for j in range(k)] for i in range(k)])
        assert got[k] == pytest.approx(np.linalg.solve(t, rho[1:k + 1])[-1])


def test_wide_and_narrow_least_squares(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8)) * [1, 10, 100, 1, 1, 1, 1, 1] + [0, 5, 1e4, 0, 0, 0, 0, 0]
    y = x @ np.arange(1, 9) + 3 + rng.normal(size=400)
    rows = [("ab"[i % 2], *map(float, x[i]), float(y[i])) for i in range(400)]
    xs = [f"x{i}" for i in range(8)]
    d = spark.createDataFrame(rows, ["id", *xs, "y"])
    for names in (xs[:4], xs):
        for r in L.fit(d, "y", names).collect():
            s = np.array([i % 2 == "ab".index(r.id) for i in range(400)])
            want = np.linalg.lstsq(np.column_stack([np.ones(s.sum()), x[s][:, :len(names)]]), y[s], rcond=None)[0]
            assert r.coef == pytest.approx(want[1:], rel=1e-5, abs=1e-5) and r.intercept == pytest.approx(want[0], rel=1e-4)
            assert r.status == "ok"
    c = L.fit(d.withColumn("x9", F.col("x0") * 2), "y", ["x0", "x9"]).first()
    assert c.status == "rank deficient"


def test_splines_sum_and_linearity(spark):
    d = spark.createDataFrame([(i / 20,) for i in range(21)], "x double")
    b = FT.b_spline(F.col("x"), [0.3, 0.6])
    assert len(b) == 5
    r = d.select(*[c.alias(f"b{i}") for i, c in enumerate(b)]).collect()
    assert all(0 <= sum(x) <= 1 + 1e-9 for x in r) and sum(r[-1]) == pytest.approx(1)
    n = FT.natural_spline(F.col("x"), [0.5])
    v = d.select(*[c.alias(f"n{i}") for i, c in enumerate(n)]).collect()
    assert v[4].n1 == pytest.approx(0.2 ** 3)


def test_stl_recovers_line_and_season(spark):
    t = np.arange(84)
    d = DC.stl(panel(spark, {"a": 10 + 0.5 * t + np.tile([3, -1, 0, 2, -4, 1, -1], 12)}))
    inner = d.where("k BETWEEN 10020 AND 10060").toPandas()
    assert inner["remainder"].abs().max() < 0.6
    flat = DC.stl(panel(spark, {"a": np.tile([3.0, -1, 0, 2, -4, 1, -1], 12)})).toPandas()
    assert flat["remainder"][(flat.k > 10005) & (flat.k < 10075)].abs().max() < 1.0


def test_clean_and_flags_find_the_spike(spark):
    y = noisy(120)
    y[60] += 50
    d = panel(spark, {"a": y})
    f = DC.anomaly_diagnostics(d).where("anomaly = 1").select("k").collect()
    assert 10060 in [r.k for r in f]
    c = DC.clean(d, out="c").where("k = 10060").first()
    assert abs(c.c - noisy(120)[60]) < 15
    assert 10060 in [r.k for r in AN.point_cost(d).collect()]
    assert [r.k for r in AN.gesd(d, "y").collect()] == [10060]
    assert 10060 in [r.k for r in AN.knn_gap(d).collect()]
    assert 10060 in [r.k for r in AN.ewma_charts(d).where("sd_ewma = 1").collect()]
    v = AN.detect(d, ["forecast", "otsad"])
    top = v.orderBy(F.desc("score"), "ts").first()
    assert top.value == pytest.approx(y[60]) and top.score == pytest.approx(np.mean([top.forecast, top.otsad_cpp, top.otsad_cpsd, top.otsad_cpts]))


def test_anomaly_cap(spark):
    y = np.zeros(40) + np.random.default_rng(0).normal(0, .01, 40)
    y[5:15] += 100
    f = DC.anomaly_diagnostics(panel(spark, {"a": y}), max_anomalies=0.1)
    assert f.where("anomaly = 1").count() <= 4


def test_vote_weights(spark):
    d = spark.createDataFrame([(1, 0, 1)], "forecast int, anomalize int, stray int")
    r = AN.score_votes(d, ["forecast", "anomalize", "stray"], ["stray", "forecast"]).first()
    assert r.score == pytest.approx(2 / 3) and r.score_w == pytest.approx((3 + 2) / 6)


def test_knn_conformal_chunk_invariant(spark):
    y = noisy(400)
    y[300] += 40
    d = panel(spark, {"a": y})
    a = sorted(r.k for r in AN.knn_conformal(d, train=60, size=50).collect())
    b = sorted(r.k for r in AN.knn_conformal(d, train=60).collect())
    assert a == b and 10300 in a


def _hw(y, period, par):
    m = S._start(np.asarray(y[:2 * period], float), (10000 + np.arange(len(y[:2 * period]))) % period, period, np.array([par[:4]]))
    l, b, s, sse = m[0, 0, 0], m[0, 1, 0], m[0, 2:, 0].copy(), 0.0
    for i, v in enumerate(y):
        p = (10000 + i) % period
        e = v - (l + par[3] * b + s[p])
        sse += e * e
        l, b, s[p] = l + par[3] * b + par[0] * e, par[3] * b + par[1] * e, s[p] + par[2] * e
    return sse, [l, b, *s]


def test_smoothing_chunks_equal_direct_recursion(spark):
    y = noisy(150)
    grid = S.auto_grid(7)
    for size in (16, 1 << 16):
        for r in S.fit(panel(spark, {"a": y}), period=7, grid=grid, size=size).collect():
            sse, state = _hw(y, 7, grid[r.p])
            assert r.sse == pytest.approx(sse, rel=1e-9)
            assert r.state == pytest.approx(state, rel=1e-8, abs=1e-8)


def test_forecasters_on_toy_line(spark):
    d = panel(spark, {"X": range(1, 61)}, "month", 2016 * 12)
    s = R.time_series_split(d, "month", 12)
    train, test = R.training(s), R.testing(s)
    err = lambda fc: E.calibrate(fc, test).agg(F.max(F.abs("residual"))).first()[0]
    assert err(S.ets(train, test, 1, S.holt_grid())) < 1e-6
    assert err(ST.additive(train, test, n_change=3, seasons={})) < 0.5
    assert err(A.forecast(train, test, [A.Order(1, 1, 0)], 12, horizon=12)) < 0.5
    assert err(M.recursive_linear(train, test, [1, 2], horizon=12)) < 1e-3


def test_seasonal_models_beat_naive(spark):
    d = panel(spark, {"a": noisy(280), "b": noisy(280, 1) * 2})
    s = R.time_series_split(d, "day", 28)
    train, test = R.training(s), R.testing(s)
    rmse = lambda fc: E.accuracy(E.calibrate(fc.withColumn("model_id", F.lit("m")), test), ["model_id"]).first().rmse
    base = rmse(N.naive(train, test))
    assert rmse(S.ets(train, test, 7)) < base
    assert rmse(A.forecast(train, test, horizon=28)) < base
    assert rmse(ST.additive(train, test, seasons={7: 3})) < base
    assert rmse(ST.stl_forecast(train, test, lambda t, f: S.ets(t, f, 1, S.holt_grid()))) < base
    th = ST.temporal_hierarchy(train, "day", 4, lambda t, f, n: S.ets(t, f, max(n, 1)))
    assert th.count() == 56 and rmse(th) < base


def test_hierarchy_weights_are_coherent():
    sizes, g = ST.hierarchy_weights(6)
    assert sizes == [1, 2, 3, 6]
    bottom = np.arange(1.0, 7)
    nodes = np.concatenate([bottom.reshape(-1, s).sum(axis=1) for s in sizes])
    np.testing.assert_allclose(g @ nodes, bottom)


def test_knn_cannot_extrapolate_and_equals_brute_force(spark):
    d = panel(spark, {"a": range(1, 21)}, "quarter", 2021 * 4).withColumn("x", F.col("k").cast("double"))
    q = T.future_frame(d, "quarter", 4).withColumn("x", F.col("k").cast("double"))
    assert all(r.prediction <= 20 for r in M.knn(d, q, ["x"], k=3).collect())
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(100, 2)), rng.normal(size=100)
    t = spark.createDataFrame([("a", i, *map(float, x[i]), float(y[i])) for i in range(100)], "id string, k bigint, u double, v double, y double")
    qs = spark.createDataFrame([("a", 200, 0.1, 0.2)], "id string, k bigint, u double, v double")
    for size in (7, 1 << 14):
        got = M.knn(t, qs, ["u", "v"], k=5, power=2, size=size).first().prediction
        dist = np.sqrt(((x - [0.1, 0.2]) ** 2).sum(axis=1))
        i = np.argsort(dist)[:5]
        assert got == pytest.approx((y[i] / (dist[i] + 1e-9)).sum() / (1 / (dist[i] + 1e-9)).sum())


def test_accuracy_known_values(spark):
    cal = spark.createDataFrame([("m", "a", i, a, p, a - p) for i, (a, p) in enumerate([(1.0, 2.0), (3.0, 3.0), (0.0, 2.0), (4.0, 3.0)])],
                                "model_id string, id string, k bigint, actual double, prediction double, residual double")
    r = E.accuracy(cal).first()
    assert (r.mae, r.rmse, r.n_zero) == (1.0, pytest.approx(np.sqrt(1.5)), 1)
    assert r.mape == pytest.approx(100 * (1 + 0 + .25) / 3) and r.mase == pytest.approx(1 / 3)


def test_select_best_keeps_ties_and_checks_args(spark):
    acc = spark.createDataFrame([("1", "a", 1.0), ("2", "a", 1.0), ("3", "a", 2.0)], "model_id string, id string, rmse double")
    assert E.select_best(acc, "rmse", 1, True, "id").count() == 2
    with pytest.raises(ValueError):
        E.select_best(acc, by_id=True)
    fc = acc.select("model_id", "id")
    assert E.best_forecast(fc, E.select_best(acc, "rmse", 1, True, "id")).count() == 1


def test_splits_disjoint_and_weights(spark):
    d = panel(spark, {"a": range(30), "b": range(20)})
    assert {(r.segment, r.n) for r in R.nested_split(d, 5).groupBy("segment").agg(F.count("*").alias("n")).collect()} == {("train", 40), ("test", 10)}
    assert R.vfold(d, 3).groupBy("id", "k").count().where("count > 1").count() == 0
    w = EN.rank_loadings(spark.createDataFrame([("1", 3.0), ("2", 1.0), ("3", 2.0)], "model_id string, rmse double"))
    assert {r.model_id: r.loading for r in w.collect()} == {"1": 1.0, "2": 3.0, "3": 2.0}


def test_recipe_learns_on_training_rows_only(spark):
    d = panel(spark, {"a": range(10), "b": range(100, 110)}).withColumn("x", F.col("y"))
    fit = Recipe("y", {"id": "id", "k": "i", "ts": "i"}).step_normalize("^x$").step_filter(F.col("y") > 3).fit(d.where("id = 'a'"))
    out = fit.transform(d)
    assert out.count() == 20 and fit.juice.count() == 6
    assert out.where("id = 'a'").agg(F.avg("x")).first()[0] == pytest.approx(0)
    assert out.where("id = 'b'").agg(F.min("x")).first()[0] > 10
    assert fit.predictors() == ["x"]


def test_grids():
    for kind in ("latin", "random", "max_entropy"):
        g = M.grid_points({"a": (0, 1), "b": (1e-3, 1)}, 5, kind, log=["b"])
        assert len(g) == 5 and all(0 <= p["a"] <= 1 and 1e-3 <= p["b"] <= 1 for p in g)
    assert len(M.grid_points({"a": (0, 1), "b": (0, 1)}, 3, "regular")) == 9
    a = sorted(int(p["a"] * 5) for p in M.grid_points({"a": (0, 1)}, 5))
    assert a == [0, 1, 2, 3, 4]


def test_panel_equals_union_of_single_series(spark):
    a, b = noisy(90), noisy(90, 2)
    both = panel(spark, {"a": a, "b": b})
    f = lambda d: sorted((r.id, r.k, round(r.prediction, 6)) for r in S.ets(d, T.future_frame(d, "day", 7), 7).collect())
    assert f(both) == sorted(f(panel(spark, {"a": a})) + f(panel(spark, {"b": b})))


def test_csv_many_and_save(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "a int, b string").write.option("header", True).csv(f"{tmp_path}/one")
    spark.createDataFrame([(2,)], "a int").write.option("header", True).csv(f"{tmp_path}/two")
    d = io.read_csv_many(spark, [(f"{tmp_path}/one", "a int, b string"), (f"{tmp_path}/two", "a int")])
    assert sorted((r.a, r.b) for r in d.collect()) == [(1, "x"), (2, None)]
    model = M.linear(["a"], "a").fit(spark.createDataFrame([(float(i),) for i in range(9)], "a double"))
    io.save_artifacts(str(tmp_path / "art"), {"t": d}, {"m": model})
    assert io.load_table(spark, str(tmp_path / "art"), "t").count() == 2
    again = io.load_model(str(tmp_path / "art"), "m").transform(spark.createDataFrame([(5.0,)], "a double")).first()
    assert again.prediction == pytest.approx(5.0)


def test_wide_to_long_and_two_digit_year(spark):
    d = spark.createDataFrame([("Y1", 5.0, None, 7.0)], "V1 string, V2 double, V3 double, V4 double")
    assert sorted((r.id, r.date, r.value) for r in CP.wide_to_long(d).collect()) == [("Y1", 1, 5.0), ("Y1", 3, 7.0)]
    t = spark.sql("SELECT timestamp_ntz'2079-05-01 12:00:00' AS d")
    assert t.select(CP.repair_two_digit_year("d").alias("d")).first().d == dt.datetime(1979, 5, 1, 12)


def asked(spark, ids, first, n):
    rows = [(i, first + j) for i in ids for j in range(n)]
    d = spark.createDataFrame(rows, "id string, k bigint")
    return d.select("id", "k", C.step_start("k", "day").alias("ts"))


def test_forecasts_reach_every_stamp_asked(spark):
    train = panel(spark, {"a": noisy(140), "short": [1, 2, 3]})
    future = asked(spark, ["a", "short", "new"], 10140, 70)
    for fc in (A.forecast(train, future, [A.Order(1, 1, 0)], 7), M.recursive_linear(train, future, [1, 7])):
        got = fc.toPandas()
        assert len(got) == 210 and got[got.id == "a"].prediction.notna().all()
        assert got[got.id == "new"].prediction.isna().all()
    early = asked(spark, ["a"], 10100, 100)
    assert A.forecast(train, early, [A.Order(1, 1, 0)], 7).where("prediction IS NULL").count() == 40


def test_smoothing_survives_a_series_without_first_values(spark):
    train = panel(spark, {"a": noisy(60), "b": [None] * 20 + noisy(40).tolist(), "c": [None] * 9 + noisy(51).tolist()})
    for period in (1, 7):
        got = S.ets(train, asked(spark, ["a", "b", "c"], 10060, 3), period).toPandas()
        assert len(got) == 9 and np.isfinite(got.prediction).all()


def test_learners_return_rows_with_unknown_regressors(spark):
    rows = [("a", i, float(i % 9), float(i % 5), 2.0 * (i % 9) - (i % 5)) for i in range(90)]
    d = spark.createDataFrame([*rows, ("a", 90, None, 1.0, 3.0), ("a", 91, 1.0, 1.0, None), ("a", 92, float("nan"), 1.0, 1.0)],
                              "id string, k bigint, u double, v double, y double")
    for est in (M.linear(["u", "v"]), M.boosted(["u", "v"], trees=2), M.kernel_poly(["u", "v"]), M.hinge_regression(["u", "v"])):
        got = est.fit(d).transform(d).toPandas().set_index("k")
        assert len(got) == 93 and got.prediction.drop([90, 92]).notna().all()
        assert got.prediction[[90, 92]].isna().all()
    near = M.knn(d.where("k < 90"), d.where("k >= 90"), ["u", "v"], k=3).toPandas().set_index("k")
    assert sorted(near.index) == [90, 91, 92] and near.prediction.notna()[91] and np.isnan(near.prediction[90])


def test_cluster_keeps_series_with_unknown_features(spark):
    d = spark.createDataFrame([(str(i), float(i), float(i % 2)) for i in range(6)] + [("x", None, 1.0)], "id string, u double, v double")
    got = TF.cluster(d, ["u", "v"], k=2).toPandas().set_index("id")
    assert len(got) == 7 and np.isnan(got.cluster["x"]) and got.cluster.drop("x").notna().all()


def test_recursion_equals_a_plain_loop(spark):
    y = noisy(80).tolist()
    train = panel(spark, {"a": y, "b": [None if i == 77 else v + 5 for i, v in enumerate(y)]})
    lags = [2, 5]
    d = W.augment(train, **{f"y_lag{l}": W.lag("y", l) for l in lags})
    models = [M.linear([f"y_lag{l}" for l in lags]).fit(d), M.linear(["y_lag2"]).fit(d)]
    c = [[*m.stages[1].coefficients, m.stages[1].intercept] for m in models]
    got = M.recursive(train, asked(spark, ["a", "b"], 10080, 9), lags, models, lambda f: f).toPandas()
    assert len(got) == 18
    v = list(y)
    for _ in range(9):
        v.append(((c[0][0] * v[-2] + c[0][1] * v[-5] + c[0][2]) + (c[1][0] * v[-2] + c[1][1])) / 2)
    np.testing.assert_allclose(got[got.id == "a"].sort_values("k").prediction, v[80:], rtol=1e-9)
    gap = got[got.id == "b"].sort_values("k").prediction.to_numpy()
    assert np.isnan(gap[2]) and np.isfinite(gap[:2]).all()


def test_interval_of_any_level(spark):
    assert abs(E.normal_quantile(95) - 1.959964) < 1e-6 and abs(E.normal_quantile(50) - 0.674490) < 1e-6


def test_wide_and_narrow_regression_leave_out_the_same_rows(spark):
    rows = [("a", *[float((i * p) % 11) for p in range(1, 8)]) for i in range(40)] + [("a", float("nan"), *[1.0] * 6)]
    d = spark.createDataFrame(rows, "id string, y double, a double, b double, c double, d double, e double, f double")
    for xs in (["a", "b"], list("abcdef")):
        assert L.gram(d, "y", xs, ["id"]).first()["n"] == 40
