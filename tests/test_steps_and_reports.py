"""Steps per series, failure reports, series features against plain versions."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_operators import noisy, panel
from tidewheel import core as C
from tidewheel.forecast import native as N
from tidewheel.forecast import smoothing as S
from tidewheel.operators import spectrum as SP
from tidewheel.operators import timeverbs as T
from tidewheel.operators import tsfeatures as TF
from tidewheel.operators import windows as W
from tidewheel.operators.decompose import stl
from tidewheel.plans import evaluate as E

D = dt.datetime


def stamps(spark, series):
    return spark.createDataFrame([(i, t) for i, ts in series.items() for t in ts], "id string, ts timestamp_ntz")


def test_steps_are_each_series_own(spark):
    month = lambda n, day: [D(2023 + (m // 12), m % 12 + 1, day, 6, 30) for m in range(n)]
    ends = [D(2023, 11, 30), D(2023, 12, 31), D(2024, 1, 31), D(2024, 2, 29)]
    series = {"hour": [D(2024, 1, 1) + dt.timedelta(hours=h) for h in range(60) if h not in (7, 8, 30)], "day": [D(2024, 1, 25) + dt.timedelta(days=d) for d in range(40)],
              "week": [D(2024, 1, 1) + dt.timedelta(days=7 * d) for d in range(9)], "month": month(8, 15), "quarter": month(24, 1)[::3], "year": [D(y, 2, 1) for y in range(2001, 2009)],
              "ends": ends, "quarterhour": [D(2024, 2, 28, 23) + dt.timedelta(minutes=15 * i) for i in range(30)], "one": [D(2024, 1, 1)], "same": [D(2024, 1, 1)] * 3}
    got = {r.id: r for r in T.infer_steps(stamps(spark, series)).collect()}
    want = {"hour": (0, 3600), "day": (0, 86400), "week": (0, 604800), "month": (1, 0), "quarter": (3, 0), "year": (12, 0), "ends": (1, 0), "quarterhour": (0, 900), "one": (None, None), "same": (None, None)}
    assert {i: (r.months, r.seconds) for i, r in got.items()} == want and got["ends"].month_end and not got["month"].month_end
    f = T.future_frame(stamps(spark, series), None, 3).orderBy("id", "h").collect()
    ahead = {i: [r.ts for r in f if r.id == i] for i in series}
    assert ahead["month"] == [D(2023, 9, 15, 6, 30), D(2023, 10, 15, 6, 30), D(2023, 11, 15, 6, 30)] and ahead["ends"] == [D(2024, 3, 31), D(2024, 4, 30), D(2024, 5, 31)]
    assert ahead["hour"][0] == D(2024, 1, 3, 12) and ahead["quarterhour"][-1] == max(series["quarterhour"]) + dt.timedelta(minutes=45)
    assert ahead["year"] == [D(2009, 2, 1), D(2010, 2, 1), D(2011, 2, 1)] and ahead["one"] == ahead["same"] == []
    n = {r.id: r.n for r in T.future_frame(stamps(spark, series), None, "8 weeks").groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert n == {"hour": 1344, "day": 56, "week": 8, "month": 2, "quarter": 1, "ends": 2, "quarterhour": 5376}
    both = T.future_frame(stamps(spark, series).withColumn("y", F.lit(1.0)), None, 1, bind=True)
    assert both.count() == sum(map(len, series.values())) + 8 and both.where("y IS NULL").count() == 8


def test_report_keeps_failures_apart(spark):
    d = panel(spark, {"a": noisy(40), "flat": [2.0] * 40, "short": [1.0, 2.0], "null": [None] * 40})
    fut = T.future_frame(d, "day", 3)

    def partial(train, future):
        return future.withColumn("prediction", F.when(F.col("id") == "a", F.col("k") - F.lit(10041.0)).when(F.col("id") == "flat", F.lit(float("nan")))).where("prediction <> 0 OR isnan(prediction)")

    def broken(train, future):
        raise RuntimeError("first line\nsecond line")
    fc, rep = E.nested_forecast({"ses": lambda t, f: S.ets(t, f, 1), "naive": N.naive, "partial": partial, "broken": broken}, d, fut, needs={"partial": 10})
    assert fc.count() == 4 * 4 * 3 and fc.columns == ["model_id", "id", "k", "ts", "prediction"]
    got = {(r.model_id, r.id): (r.status, r.error, r.n_known, r.n_predicted) for r in rep.collect()}
    assert len(got) == 16 and got["ses", "a"] == ("ok", None, 40, 3) and got["ses", "flat"] == ("ok", None, 40, 3) and got["ses", "short"][0] == "ok"
    assert got["ses", "null"] == got["naive", "null"] == ("failed", "no known value", 0, 0)
    assert got["partial", "a"][0] == "partial" and got["partial", "a"][3] == 2 and got["partial", "flat"] == ("failed", "constant series", 40, 0)
    assert got["partial", "short"] == ("failed", "2 known values, needs 10", 2, 0)
    assert all(got["broken", i][:2] == ("failed", "RuntimeError: first line") for i in ("a", "flat", "short", "null"))


def test_forecasters_return_every_row_asked(spark):
    d = panel(spark, {"a": noisy(30)})
    fut = spark.createDataFrame([(i, 10030 + h) for i in ("a", "new") for h in range(9)], "id string, k bigint").withColumn("ts", C.step_start("k", "day"))
    for f in (N.naive, lambda t, x: N.seasonal_naive(t, x, 7), N.window, N.window_weighted, lambda t, x: S.ets(t, x, 7), S.theta):
        got = f(d, fut).toPandas()
        assert len(got) == 18 and got[got.id == "a"].prediction.notna().all() and got[got.id == "new"].prediction.isna().all()


@pytest.mark.parametrize("cells", [1, 40, 1 << 18])
def test_entropy_equals_a_plain_transform(spark, cells):
    series = {"a": noisy(200), "b": np.random.default_rng(1).normal(size=97), "c": [3.0] * 50, "d": [1.0, 5.0], "e": [None, 2.0, 4.0, None, 9.0]}
    got = {r.id: r for r in SP.spectral_entropy(panel(spark, series), cells=cells).collect()}
    for i, v in series.items():
        x = np.array([np.nan if z is None else z for z in v], float)
        x = np.nan_to_num(x - np.nanmean(x))
        m = int(np.ceil(np.sqrt(len(x))))
        p = np.abs(np.fft.fft(x, m * m)) ** 2
        p = p[1:m * m // 2 + 1]
        assert got[i].n_freq == len(p) >= len(x) // 2
        if p.sum() > 1e-9 and len(p) > 1:
            q = p[p > 0] / p.sum()
            assert got[i].entropy == pytest.approx(-(q * np.log(q)).sum() / np.log(len(p)), rel=1e-9)
        else:
            assert got[i].entropy is None


def test_series_features_equal_numpy(spark):
    series = {"a": noisy(140), "b": np.cumsum(np.random.default_rng(2).normal(size=90))}
    d = panel(spark, series)
    got = TF.ts_features(d, scale=False, prefix="").toPandas().set_index("id")
    s = stl(d, "y", 7).orderBy("k").toPandas()

    def acf(x, l):
        x = np.asarray(x, float) - np.mean(x)
        return (x[l:] * x[:len(x) - l]).sum() / (x * x).sum()
    for i, y in series.items():
        m, n = s[s.id == i], len(y)
        t = np.arange(n)
        q, _ = np.linalg.qr(np.column_stack([np.ones(n), t, t ** 2]))
        q = q * np.sign(q[-1])
        assert got.linearity[i] == pytest.approx(q[:, 1] @ m.trend.to_numpy()) and got.curvature[i] == pytest.approx(q[:, 2] @ m.trend.to_numpy())
        for name, x in (("x", y), ("diff1", np.diff(y)), ("diff2", np.diff(y, 2)), ("e", m.remainder)):
            assert got[f"{name}_acf1"][i] == pytest.approx(acf(x, 1), rel=1e-6) and got[f"{name}_acf10"][i] == pytest.approx(sum(acf(x, l) ** 2 for l in range(1, 11)), rel=1e-6)
        per = m.groupby(m.k % 7).season.first()
        assert got.peak[i] == per.idxmax() + 1 and got.trough[i] == per.idxmin() + 1
        loo = [np.var(np.delete(m.remainder.to_numpy(), j), ddof=0) for j in range(n)]
        assert got.spike[i] == pytest.approx(np.var(loo, ddof=1), rel=0.05)


def test_windows_ahead_are_linear(spark):
    """The next known value comes from a descending window, also far beyond a chunk."""
    v = [None] * 4000
    v[0], v[3999] = 1.0, 2.0
    r = C.with_neighbours(panel(spark, {"a": v}), "y").where("k = 12000").first()
    assert (r._prev.y, r._next.y) == (1.0, 2.0)
    assert W.augment(panel(spark, {"a": v}), l=W.lag("y", 1)).count() == 4000
