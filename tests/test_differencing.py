"""Choice of differencing and comparisons on equal rows, against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_operators import noisy, panel
from tidewheel.forecast import arima as A
from tidewheel.forecast import differencing as DF
from tidewheel.forecast import smoothing as S
from tidewheel.forecast import structural as ST
from tidewheel.operators import decompose as DC
from tidewheel.operators import timeverbs as T


def plain_kpss(y):
    e = np.asarray(y, float) - np.mean(y)
    n = len(e)
    lags = int(4 * (n / 100) ** 0.25)
    v = e @ e + 2 * sum((1 - j / (lags + 1)) * (e[j:] @ e[:-j]) for j in range(1, lags + 1))
    return (np.cumsum(e) ** 2).sum() / (n * v)


@pytest.mark.parametrize("size", [6, 50, 1 << 16])
def test_kpss_over_chunks(spark, size):
    rng = np.random.default_rng(0)
    series = {"white": rng.normal(size=300), "walk": np.cumsum(rng.normal(size=180)), "short": [1.0, 2.0, 4.0], "flat": [7.0] * 40, "null": [None] * 5}
    got = {r.id: r for r in DF.kpss(panel(spark, series), size=size).collect()}
    for i in ("white", "walk", "short"):
        assert got[i].stat == pytest.approx(plain_kpss(series[i])) and got[i].n == len(series[i])
    assert got["flat"].stat is None and "null" not in got and got["white"].stat < DF.CRITICAL < got["walk"].stat


def test_choice_of_differencing(spark):
    rng = np.random.default_rng(1)
    t = np.arange(420)
    series = {"white": rng.normal(size=420), "walk": np.cumsum(rng.normal(size=420)), "twice": np.cumsum(np.cumsum(rng.normal(size=420))), "season": 20 * np.sin(2 * np.pi * t / 7) + rng.normal(size=420),
              "both": np.cumsum(rng.normal(1, 1, 420)) + 30 * (t % 7 == 0), "flat": [3.0] * 30, "short": [1.0, 2.0]}
    got = {r.id: (r.d, r.seasonal_d) for r in DF.choose(panel(spark, series)).collect()}
    def plain_d(y):
        return next((d for d in (0, 1) if plain_kpss(np.diff(y, d)) <= DF.CRITICAL), 2)
    assert [got[i] for i in ("white", "walk", "twice")] == [(plain_d(series[i]), 0) for i in ("white", "walk", "twice")] and got["white"][0] == 0 < got["walk"][0]
    assert got["season"] == (plain_d(series["season"][7:] - series["season"][:-7]), 1) and got["both"][1] == 1 and got["flat"] == (0, 0) and got["short"][1] == 0


def test_candidates_hold_the_airline_family():
    every = A.candidates(1, 1)
    assert A.Order(1, 1, 1, 1, 1, 1) in every and A.Order(0, 1, 1, 0, 1, 1) in every and len(every) == len(set(every)) == 35
    assert all((o.d, o.D) == (1, 1) for o in every)


def test_differencings_are_judged_on_equal_rows(spark):
    rng = np.random.default_rng(3)
    series = {"walk": np.cumsum(rng.normal(size=300)), "white": rng.normal(size=300)}
    d = panel(spark, series)
    fut = T.future_frame(d, "day", 5)
    orders = [A.Order(1, 0, 0), A.Order(0, 1, 1), A.Order(0, 0, 1, 0, 1, 1)]
    skip = A.burn_in(orders, 7)
    one = {(r.id, r.order): r for o in orders for r in A.search(d, fut, [o], skip=skip).collect()}
    assert {r.n_scored for r in one.values()} == {300 - skip}
    best = {r.id: r for r in A.search(d, fut, orders).collect()}
    for i in series:
        want = min((r for (j, _), r in one.items() if j == i), key=lambda r: r.score)
        assert best[i].order == want.order and best[i].score == pytest.approx(want.score) and best[i].n_scored == 300 - skip


def test_smoothing_counts_only_the_asked_cells(spark):
    y = noisy(90)
    grid = [(0.3, 0.0, 0.0, 0.0, 2)]
    for skip in (0, 10, 40):
        for size in (8, 1 << 16):
            r = S.fit(panel(spark, {"a": y, "s": y[:5]}), "y", 1, grid, size=size, skip=skip).where("id = 'a'").first()
            # The start: mean of the first cycle, as ``_start`` has it for models without trend.
            level, sse = y[0], 0.0
            for k, v in enumerate(y):
                sse += (v - level) ** 2 if k >= skip else 0.0
                level += 0.3 * (v - level)
            assert r.n == 90 - skip and r.sse == pytest.approx(sse) and r.state[0] == pytest.approx(level)
    short = S.fit(panel(spark, {"s": y[:5]}), "y", 1, grid, skip=40).first()
    assert short.n == 5


def test_smoothing_or_arima_and_auto_reach_every_stamp(spark):
    rng = np.random.default_rng(4)
    series = {"walk": np.cumsum(rng.normal(size=200)), "season": 9 * np.sin(2 * np.pi * np.arange(200) / 7) + rng.normal(size=200), "short": [1.0, 2.0, 3.0, 4.0], "null": [None] * 30}
    d = panel(spark, series)
    fut = T.future_frame(d, "day", 6)
    for fc in (A.auto(d, fut), ST.smoothing_or_arima(d, fut)):
        got = fc.toPandas()
        assert len(got) == 24 and got[got.id.isin(["walk", "season"])].prediction.notna().all() and got[got.id == "null"].prediction.isna().all()
    assert ST.smoothing_or_arima(d, fut).where("id = 'short' AND prediction IS NULL").count() == 0
    assert ",0," in A.auto_search(d, fut).where(F.col("id") == "season").first().order


def test_seasons_are_found_together(spark):
    t = np.arange(420)
    y = 0.02 * t + 5 * np.sin(2 * np.pi * t / 7) + 8 * (t % 30 == 3) + 3 * np.cos(2 * np.pi * t / 70)
    d = panel(spark, {"a": y, "short": y[:40]})
    got = DC.multi_stl(d, periods=(70, 7, 30)).toPandas().sort_values(["id", "k"])
    assert np.abs(got.season_7 + got.season_30 + got.season_70 + got.trend + got.remainder - got.y).max() < 1e-9
    assert np.abs(got.seasadj - got.trend - got.remainder).max() < 1e-9 and (got[got.id == "short"].season_70 == 0).all() and (got[got.id == "short"].season_30 == 0).all()
    a = got[got.id == "a"]
    for p in (7, 30, 70):
        assert a.groupby(a.k % p)[f"season_{p}"].nunique().max() == 1
    one = DC.stl(d, "y", 7).where("id = 'a'").agg(F.var_pop("remainder")).first()[0]
    assert a.remainder.var() < 0.1 * one


def test_stl_forecast_with_regressors(spark):
    t = np.arange(240)
    y = 4 * np.sin(2 * np.pi * t / 7) + 2 * np.cos(2 * np.pi * t / 30) + 10 * (t % 11 == 0)
    d = panel(spark, {"a": y[:210], "flat": [2.0] * 210})
    hit = lambda f: f.withColumn("hit", F.when(F.pmod(F.col("k") - 10000, F.lit(11)) == 0, 1.0).otherwise(0.0))
    fut = T.future_frame(d, "day", 30)
    fc = ST.stl_forecast(hit(d), hit(fut), lambda a, b: S.ets(a, b, 1), (7, 30), xs=["hit"]).toPandas()
    assert len(fc) == 60 and fc.prediction.notna().all()
    a = fc[fc.id == "a"].sort_values("k").prediction.to_numpy()
    assert np.sqrt(((a - y[210:]) ** 2).mean()) < 1.2 and np.abs(fc[fc.id == "flat"].prediction - 2).max() < 1e-6
    plain = ST.stl_forecast(d, fut, lambda a, b: A.auto(a, b, 1), (7, 30))
    assert plain.count() == 60


def test_unknown_cells_do_not_stop_arima(spark):
    rng = np.random.default_rng(6)
    y = list(np.cumsum(rng.normal(size=160)))
    for i in (40, 41, 157, 159):
        y[i] = None
    d = panel(spark, {"a": y}).withColumn("x", F.cos(F.col("k") / 5.0))
    fut = T.future_frame(d, "day", 4).withColumn("x", F.cos(F.col("k") / 5.0))
    for fc in (A.forecast(d, fut, [A.Order(1, 1, 1)]), ST.with_regressors(d, fut, ["x"], lambda a, b: A.forecast(a, b, [A.Order(1, 0, 1), A.Order(0, 1, 1)]))):
        got = fc.collect()
        assert len(got) == 4 and all(r.prediction is not None and abs(r.prediction - y[158]) < 15 for r in got)
