"""Charts on a stream equal the batch, however rows are dealt to micro-batches."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.core import with_position
from tidewheel.operators import anomaly as AN
from tidewheel.streaming import live as LV

START = dt.datetime(2024, 1, 1)


def rows(n=240, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for i, step in (("a", 7), ("b", 31)):
        t = 0.0
        for k in range(n):
            t += float(rng.exponential(step))
            out.append((i, START + dt.timedelta(seconds=t), float(rng.normal() + (12 if k % 60 == 59 else 0))))
        out.append((i, out[-1][1], out[-1][2] + 1.0))
    return out + [("a", START + dt.timedelta(seconds=500), None)]


def streamed(spark, tmp_path, parts):
    """Each part is one file and one micro-batch."""
    folder = tmp_path / "in"
    for j, part in enumerate(parts):
        d = spark.createDataFrame(part, "id string, ts timestamp_ntz, y double").coalesce(1)
        d.write.mode("append").parquet(str(folder / f"{j:03d}"))
    schema = "id string, ts timestamp_ntz, y double"
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))
    got = LV.run_to_table(LV.online_flags(events, n_train=40, late="5 minutes", bucket=20), str(tmp_path / "out")).collect()
    return sorted((r.id, r.ts, r.pewma, r.sd_ewma, r.two_stage) for r in got)


@pytest.fixture(scope="module")
def batch(spark):
    d = with_position(spark.createDataFrame(rows(), "id string, ts timestamp_ntz, y double").where("y IS NOT NULL"), tie=("y",))
    flags = AN.ewma_charts(d, n_train=40).join(d, ["id", "k"])
    last = max(r[1] for r in rows())
    done = (F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 20) + 1) * 20 <= int((last - dt.timedelta(minutes=5)).replace(tzinfo=dt.timezone.utc).timestamp())
    return sorted((r.id, r.ts, r.pewma, r.sd_ewma, r.two_stage) for r in flags.where(done).collect())


def test_ordered_stream_equals_batch(spark, tmp_path, batch):
    d = sorted(rows(), key=lambda r: r[1])
    got = streamed(spark, tmp_path, [d[i:i + 90] for i in range(0, len(d), 90)])
    assert got == batch and sum(r[3] for r in got) > 3 and len(got) > 300


def test_late_rows_are_put_in_order(spark, tmp_path, batch):
    rng = np.random.default_rng(5)
    # Delays below the promised lateness shuffle neighbours across micro-batches.
    d = sorted(rows(), key=lambda r: r[1] + dt.timedelta(seconds=float(rng.uniform(0, 250))))
    assert d != sorted(rows(), key=lambda r: r[1])
    assert streamed(spark, tmp_path, [d[i:i + 60] for i in range(0, len(d), 60)]) == batch


def test_one_batch_and_refusal(spark, tmp_path, batch):
    assert streamed(spark, tmp_path, [rows()]) == batch
    with pytest.raises(ValueError):
        LV.online_flags(spark.createDataFrame([], "id string, ts timestamp_ntz, y double"), n_train=0)


class _Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


class _Map(dict):
    """Map state that counts its scans."""
    scans = 0

    def updateValue(self, k, v):
        self[k] = v

    def getValue(self, k):
        return self[k]

    def removeKey(self, k):
        del self[k]

    def containsKey(self, k):
        return k in self

    def keys(self):
        self.scans += 1
        return iter(list(super().keys()))


class _Value:
    def __init__(self):
        self.v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v


class _Handle:
    def __init__(self):
        self.maps, self.timers = [], set()

    def getMapState(self, *_):
        self.maps.append(_Map())
        return self.maps[-1]

    def getValueState(self, *_):
        return _Value()

    def registerTimer(self, ms):
        self.timers.add(ms)


def test_state_calls_do_not_go_by_bucket():
    """Thousands of passed buckets are a few entries and one scan of the state; rows come back whole and in order."""
    import pandas as pd

    n, h = 20000, _Handle()
    rng = np.random.default_rng(1)
    us = rng.permutation(np.arange(n)) * 60_000_000 + 5
    y = rng.normal(size=n)
    p = LV._OrderedCharts(10, 60_000)
    p.init(h)
    assert list(p.handleInputRows(("a",), iter([pd.DataFrame({"us": us[i:i + 1000], "y": y[i:i + 1000]}) for i in range(0, n, 1000)]), _Clock(0))) == []
    assert sum(len(m) for m in h.maps) < n / 50 and len(h.timers) < 10
    half, out = n // 2 * 60_000 + 30_000, []
    for ms in (half, 2 * n * 60_000):
        for t in sorted(t for t in h.timers if t <= ms):
            out += [(f["us"].to_numpy(), ms) for f in p.handleExpiredTimer(("a",), _Clock(ms), None)]
            h.timers.discard(t)
        if ms == half:
            assert min(h.timers) == (n // 2 + 1) * 60_000
    assert np.concatenate([u for u, _ in out]).tolist() == sorted(us.tolist())
    assert max(u.max() for u, ms in out if ms == half) == (n // 2 - 1) * 60_000_000 + 5
    assert sum(m.scans for m in h.maps) < 20 and not any(h.maps)
