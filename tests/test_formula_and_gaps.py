"""Regression by formula, windows over gaps, scratch folders."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_operators import noisy, panel
from tidewheel.forecast import linear as L
from tidewheel.operators import diagnostics as D
from tidewheel.operators import windows as W
from tidewheel.plans import evaluate as E
from tidewheel.session import clear_scratch, cut_lineage, new_folder


def test_windows_go_by_position(spark):
    y = noisy(60)
    gaps = {7, 8, 20, 21, 22, 23, 24, 25, 26, 40, 59}
    d = panel(spark, {"a": [None if i in gaps else v for i, v in enumerate(y)]}).where("y IS NOT NULL")
    f = dict(l1=W.lag("y", 1), l5=W.lag("y", 5), ahead=W.lag("y", -3), m=W.slide("y", 5, partial=True), full=W.slide("y", 5), df=W.diff("y", 2), w=W.weighted_tail("y", (.2, .8)))
    x = {i: v for i, v in enumerate(y) if i not in gaps}
    for size in (3, 6, 1 << 16):
        got = {r.k - 10000: r for r in W.augment(d, size=size, **f).collect()}
        assert got.keys() == x.keys()
        for i, r in got.items():
            assert (r.l1, r.l5, r.ahead) == (x.get(i - 1), x.get(i - 5), x.get(i + 3))
            near = [x[j] for j in range(i - 4, i + 1) if j in x]
            assert r.m == pytest.approx(np.mean(near)) and (r.full is None if len(near) < 5 else r.full == pytest.approx(np.mean(near)))
            assert r.df == (pytest.approx(x[i] - x[i - 2]) if i - 2 in x else None) and r.w == (pytest.approx(.8 * x[i] + .2 * x[i - 1]) if i - 1 in x else None)


def test_acf_over_gaps(spark):
    y = noisy(80)
    d = panel(spark, {"a": [None if i in (3, 30, 31) else v for i, v in enumerate(y)]}).where("y IS NOT NULL")
    x = {i: v for i, v in enumerate(y) if i not in (3, 30, 31)}
    m = np.mean(list(x.values()))
    want = [sum((x[i] - m) * (x[i - l] - m) for i in x if i - l in x) / sum((v - m) ** 2 for v in x.values()) for l in range(4)]
    assert [r.acf for r in D.acf(d, "y", 3).orderBy("lag").collect()] == pytest.approx(want)


def test_regression_by_formula(spark):
    d = panel(spark, {"a": noisy(90), "b": noisy(90, 1) * 2}).withColumns({"u": F.cos(F.col("k") / 7.0), "wd": F.pmod("k", F.lit(3)).cast("int")})
    d = d.withColumn("y", F.when(F.col("k") != 10005, F.col("y")))
    rows, terms = L.regress(d, "y ~ u + factor(wd) + u:factor(wd) + pow(k - 10000, 2)")
    p = rows.orderBy("id", "k").toPandas()
    assert len(p) == 180 and p[p.k == 10005].residual.isna().all() and p[p.k == 10005].fitted.notna().all() and set(rows.columns) == {*d.columns, "fitted", "residual"}
    t = {(r.id, r.term): r.estimate for r in terms.collect()}
    for i in ("a", "b"):
        q = p[(p.id == i) & p.y.notna()]
        w1, w2 = (q.wd == 1) * 1.0, (q.wd == 2) * 1.0
        x = np.column_stack([np.ones(len(q)), q.u, w1, w2, q.u * w1, q.u * w2, (q.k - 10000) ** 2])
        beta = np.linalg.lstsq(x, q.y, rcond=None)[0]
        names = ["(intercept)", "u", "wd=1", "wd=2", "u:wd=1", "u:wd=2", "pow(k - 10000, 2)"]
        assert [t[i, n] for n in names] == pytest.approx(beta, rel=1e-5, abs=1e-6)
        np.testing.assert_allclose(q.fitted, x @ beta, rtol=1e-6)
    rows, terms = L.regress(d, "y ~ u + wd - 1")
    q = rows.where("id = 'a' AND y IS NOT NULL").toPandas()
    beta = np.linalg.lstsq(np.column_stack([q.u, q.wd]), q.y, rcond=None)[0]
    got = {r.term: r for r in terms.where("id = 'a'").collect()}
    assert [got["u"].estimate, got["wd"].estimate] == pytest.approx(beta, rel=1e-6) and got["u"].n == 89 and "(intercept)" not in got
    for bad in ("y", "y ~ ", "~ u", "y ~ u + + wd"):
        with pytest.raises(ValueError):
            L.regress(d, bad)
    assert L.regress(d.where("false"), "y ~ u")[1].count() == 0


def test_scratch_is_parquet_and_can_be_cleared(spark):
    d = cut_lineage(spark.range(5).withColumn("x", F.lit(1.0)))
    assert d.count() == 5 and d.inputFiles() and "tidewheel-" in d.inputFiles()[0]
    path = new_folder(spark)
    spark.range(2).write.parquet(path)
    assert clear_scratch(spark) >= 2 and not os.path.exists(path.removeprefix("file:"))
    assert clear_scratch(spark) == 0


def test_accuracy_scales_by_neighbours_only(spark):
    d = spark.createDataFrame([("m", "a", k, float(k * k), float(k * k + 1)) for k in (0, 1, 2, 9, 10)], "model_id string, id string, k bigint, actual double, prediction double").withColumn("ts", F.lit(None).cast("timestamp_ntz")).withColumn("residual", F.col("actual") - F.col("prediction"))
    r = E.accuracy(d).first()
    assert r.mae == pytest.approx(1.0) and r.mase == pytest.approx(1.0 / np.mean([1, 3, 19]))
