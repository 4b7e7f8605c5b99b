"""Detectors whose work is spread over one key: against sequential and brute-force versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_operators import panel
from tidewheel import core as C
from tidewheel.operators import anomaly as AN
from tidewheel.operators import decompose as DC


def spiky(n, seed=0, ties=False):
    rng = np.random.default_rng(seed)
    y = rng.normal(0, 1, n) + 0.01 * np.arange(n)
    y[rng.integers(0, n, max(1, n // 25))] += rng.choice([-9.0, 9.0], max(1, n // 25))
    return np.round(y) if ties else y


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("rows", [4, 37, 1 << 16])
def test_running_ranks_and_sums(spark, rows, ties):
    series = {"a": spiky(300, 1, ties), "b": spiky(40, 2, ties), "c": [5.0]}
    d = panel(spark, series)
    got = C.running(d, "y", rank="r", sums={"s": F.col("y")}, rows=rows).orderBy("id", "r").collect()
    for i, v in series.items():
        mine = [r for r in got if r.id == i]
        want = sorted((float(y), 10000 + k) for k, y in enumerate(v))
        assert [(r.y, r.k) for r in mine] == want and [r.r for r in mine] == list(range(1, len(v) + 1))
        np.testing.assert_allclose([r.s for r in mine], np.concatenate([[0], np.cumsum([y for y, _ in want])[:-1]]), atol=1e-9)


def test_no_task_holds_a_key_of_one_value(spark):
    d = C.value_bins(panel(spark, {"a": [0.0] * 200 + [1.0, 2.0]}), "y", sub=C.chunk_of("k", 16), rows=16)
    assert d.groupBy("_bin", "_sub").count().agg(F.max("count")).first()[0] <= 16


@pytest.mark.parametrize("size", [7, 64, 1 << 16])
def test_sd_ewma_chunks_equal_the_sequence(spark, size):
    y = list(spiky(500, 3))
    y[40:90] = [None] * 50
    series = {"a": y, "b": list(spiky(12, 4)), "c": [None, None], "d": [3.0] * 60}
    got = {(r.id, r.k): (r.sd_ewma, r.two_stage) for r in AN.sd_ewma_charts(panel(spark, series), size=size).collect()}
    n = 0
    for i, v in series.items():
        nt = min(int(sum(x is not None for x in v) * 0.15), 750)
        head = [x for x in v[:nt] if x is not None]
        chart = AN.Ewma(float(np.mean(head)) if head else 0.0, float(np.var(head)) if head else 0.0, nt)
        for k, x in enumerate(v):
            if x is not None:
                assert got[i, 10000 + k] == chart.update(float(x))[1:], (i, k)
                n += 1
    assert n == len(got) and sum(a for a, _ in got.values()) > 3
    pewma = AN.ewma_charts(panel(spark, series))
    assert pewma.columns == ["id", "k", "pewma", "sd_ewma", "two_stage"] and pewma.count() == n


def test_scan_is_the_recursion():
    x, s, want = np.random.default_rng(0).normal(size=300), 2.0, []
    for v in x:
        s = 0.8 * s + v
        want.append(s)
    for n in (1, 63, 64, 65, 300):
        np.testing.assert_allclose(AN._scan(0.8, x[:n], 2.0), want[:n])


@pytest.mark.parametrize("rows", [8, 1 << 16])
@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("k", [None, 1, 7, 500])
def test_knn_distance_equals_brute_force(spark, k, ties, rows):
    series = {"a": spiky(150, 5, ties), "b": spiky(9, 6, ties), "c": [4.0], "d": [2.0] * 30, "e": [None, 1.0, None, 4.0]}
    got = {(r.id, r.k): r._d for r in AN.knn_distance(panel(spark, series), k, rows=rows).collect()}
    for i, v in series.items():
        x = {10000 + j: float(y) for j, y in enumerate(v) if y is not None}
        n = len(x)
        kk = min(max(int(n * 0.1), 1) if k is None else k, n - 1)
        for at, y in x.items():
            if n == 1:
                assert (i, at) not in got
            else:
                assert got[i, at] == pytest.approx(sorted(abs(z - y) for z in x.values())[kk], abs=1e-12), (i, at)


def test_gesd_over_bins_equals_one_window(spark, monkeypatch):
    y = spiky(400, 7)
    c = y - y.mean()
    order, left, over, gone = np.argsort(-abs(c), kind="stable"), len(y), [], []
    for step, i in enumerate(order[:80]):
        rest = np.delete(c, gone)
        p = 0.05 / (2 * (left - step))
        q = np.sqrt(-2 * np.log(p))
        z = q - (2.515517 + 0.802853 * q + 0.010328 * q * q) / (1 + 1.432788 * q + 0.189269 * q * q + 0.001308 * q ** 3)
        v = left - step - 2
        tq = z + (z ** 3 + z) / (4 * v) + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / (96 * v * v)
        n = left - step
        if abs(c[i] - rest.mean()) / rest.std(ddof=1) > (n - 1) * tq / np.sqrt((n - 2 + tq * tq) * n):
            over.append(step)
        gone.append(i)
    want = sorted(10000 + order[: over[-1] + 1]) if over else []
    real = C.running
    monkeypatch.setattr(AN, "running", lambda *a, **kw: real(*a, **{**kw, "rows": 9}))
    assert sorted(r.k for r in AN.gesd(panel(spark, {"a": y}), "y").collect()) == want and len(want) > 5


def test_anomaly_cap_keeps_the_farthest(spark, monkeypatch):
    rng = np.random.default_rng(8)
    y = rng.normal(0, 0.01, 210)
    y[::5] += rng.normal(0, 50, 42)
    d = panel(spark, {"a": y, "b": rng.normal(0, 1, 100)})
    real = C.running
    monkeypatch.setattr(DC, "running", lambda *a, **kw: real(*a, **{**kw, "rows": 5}))
    r = DC.anomaly_diagnostics(d, max_anomalies=0.02).where("id = 'a'").collect()
    excess = {x.k: max(x.rem_l1 - x.remainder, x.remainder - x.rem_l2) for x in r}
    beyond = sorted((k for k, e in excess.items() if e > 0), key=lambda k: (-excess[k], k))
    assert len(beyond) > 4 and {x.k for x in r if x.anomaly} == set(beyond[:4])


def test_detect_refuses_unknown_methods(spark):
    d = panel(spark, {"a": spiky(60)})
    for bad in (["stray", "none"], []):
        with pytest.raises(ValueError):
            AN.detect(d, methods=bad)


def plain_conformal(y, threshold, dim, train, share):
    x = [np.nan if v is None else float(v) for v in y]
    n, known = len(x), sum(v is not None for v in y)
    kk, nt = max(int(known * share), 1), max(min(int(known * 0.15), train), 2)
    first = next(i for i, v in enumerate(y) if v is not None)
    vec = lambda i: np.array(x[i - dim + 1:i + 1]) if i >= dim - 1 else np.array([np.nan])
    s, out = [np.nan] * n, []
    for i in range(n):
        if not np.isnan(vec(i)).any():
            d = sorted(np.sqrt(((vec(i) - vec(j)) ** 2).sum()) for j in range(max(0, i - nt), i) if not np.isnan(vec(j)).any())[:kk]
            s[i] = np.mean(d) if d else np.nan
    for i in range(n):
        past = [v for v in s[max(0, i - nt):i] if v == v]
        if i >= nt + dim and s[i] == s[i] and past and np.mean([v < s[i] for v in past]) >= threshold:
            out.append(10000 + i)
    return out if first == 0 else None


@pytest.mark.parametrize("size", [40, 4096])
def test_knn_conformal_equals_brute_force(spark, size):
    a = list(spiky(400, 9))
    a[100:104], a[250] = [None] * 4, None
    series = {"a": a, "b": list(spiky(60, 10)), "c": [1.0, 2.0, 3.0], "d": [None] * 20}
    for train, share in ((40, 0.02), (25, 0.5)):
        got = AN.knn_conformal(panel(spark, series), train=train, share=share, size=size).collect()
        assert sorted(r.k for r in got if r.id == "a") == plain_conformal(a, 0.95, 5, train, share)
        assert sorted(r.k for r in got if r.id == "b") == plain_conformal(series["b"], 0.95, 5, train, share)
        assert {r.id for r in got} <= {"a", "b"} and len(got) > 5
