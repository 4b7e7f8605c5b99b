"""Streaming forms: windowed summaries with late data, enrichment, online anomaly flags, scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewheel.operators.anomaly import Ewma


def read_events(spark: SparkSession, folder: str, schema, glob: str = "*.parquet", max_files: int = 1000) -> DataFrame:
    return (spark.readStream.schema(schema).option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", max_files).parquet(folder))


def summarise_by_window(events: DataFrame, size: str, slide: str | None = None, *, late: str = "10 minutes", ts: str = "ts",
                        keys: Sequence[str] = ("id",), **aggs: Column) -> DataFrame:
    """Tumbling (or sliding) summary; windows close once the watermark has passed them."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    events = events.withColumn(ts, F.col(ts).cast("timestamp"))  # watermarks need an instant
    g = events.withWatermark(ts, late).groupBy(*keys, w.alias("w")).agg(*[c.alias(n) for n, c in aggs.items()])
    return g.select(*keys, F.col("w.start").cast("timestamp_ntz").alias("start"),
                    F.col("w.end").cast("timestamp_ntz").alias("end"), *aggs)


def enrich(events: DataFrame, calendar: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Stream-static left join; rows without a calendar entry count 0."""
    return events.join(calendar, list(on), "left").withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})


class _OrderedCharts(StatefulProcessor):
    """Rows wait in stretches of time until the watermark has passed their bucket; then a key's chart sees them in time order."""

    #: Buckets of one stretch; rows that a key gathers before they go to the state; rows of one output frame.
    STRETCH, GATHERED, OUT = 256, 1 << 18, 1 << 13

    def __init__(self, n_train: int, bucket_ms: int):
        self.n_train, self.bucket_ms = n_train, bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # A stretch's rows are as many entries as there were deliveries: each is written once and read once.
        self.waiting = handle.getMapState("waiting", "stretch bigint, delivery bigint", "us binary, y binary")
        self.deliveries = handle.getValueState("deliveries", "n bigint")
        # Training values until there are enough of them, then the chart's few numbers.
        self.chart = handle.getValueState("chart", "head array<double>, s array<double>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        closed, parts, n = self._closed(timerValues), [], 0
        for pdf in rows:
            us, y = pdf["us"].to_numpy(np.int64), pdf["y"].to_numpy(np.float64)
            known = us >= closed  # others are later than promised
            parts.append((us[known], y[known]))
            n += int(known.sum())
            if n >= self.GATHERED:
                self._hold(parts)
                parts, n = [], 0
        if n:
            self._hold(parts)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """All that has passed, stretch by stretch; a timer stands for the first bucket that has not."""
        closed, span = self._closed(timerValues), 1000 * self.bucket_ms * self.STRETCH
        head, state = self.chart.get() if self.chart.exists() else ([], None)
        head, chart = list(head), None if state is None else Ewma(0.0, 1.0, self.n_train, state)
        ready, n = [], 0
        for stretch, entries in groupby(sorted((s, e) for s, e in self.waiting.keys()), lambda x: x[0]):
            if stretch * span >= closed:
                self._wake(stretch * span)
                break
            entries = list(entries)
            held = [self.waiting.getValue(e) for e in entries]
            us, y = (np.concatenate([np.frombuffer(h[c], t) for h in held]) for c, t in ((0, np.int64), (1, np.float64)))
            order = np.lexsort((y, us))
            us, y = us[order], y[order]
            k = int(np.searchsorted(us, closed))
            for e in entries[k < len(us):]:
                self.waiting.removeKey(e)
            if k < len(us):  # the stretch that is passed in part
                self.waiting.updateValue(entries[0], (us[k:].tobytes(), y[k:].tobytes()))
                self._wake(int(us[k]))
            if k:
                chart, flags = self._advance(head, chart, y[:k].tolist())
                ready.append((us[:k], flags))
                n += k
            if n >= self.OUT:
                yield self._frame(key, ready)
                ready, n = [], 0
            if k < len(us):
                break
        if n:
            yield self._frame(key, ready)
        self.chart.update((head, None if chart is None else [float(x) for x in chart.s]))

    def _closed(self, timerValues) -> int:
        """The microsecond before which every bucket has been passed by the watermark."""
        return timerValues.getCurrentWatermarkInMs() // self.bucket_ms * self.bucket_ms * 1000

    def _wake(self, us: int) -> None:
        """Call again when the bucket of ``us`` has been passed."""
        self.handle.registerTimer((us // (1000 * self.bucket_ms) + 1) * self.bucket_ms)

    def _hold(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        us, y = (np.concatenate(c) for c in zip(*parts))
        stretch = us // (1000 * self.bucket_ms * self.STRETCH)
        order = np.argsort(stretch, kind="stable")
        stretch = stretch[order]
        n = self.deliveries.get()[0] if self.deliveries.exists() else 0
        for rows in np.split(order, np.flatnonzero(np.diff(stretch)) + 1):
            self.waiting.updateValue((int(us[rows[0]]) // (1000 * self.bucket_ms * self.STRETCH), n), (us[rows].tobytes(), y[rows].tobytes()))
        self.deliveries.update((n + 1,))
        self._wake(int(us.min()))

    def _advance(self, head: list[float], chart: Ewma | None, values: list[float]) -> tuple[Ewma | None, list[tuple[int, int, int]]]:
        """The chart after ``values`` and their flags; training values are put to ``head``, which is emptied once there are enough."""
        flags = []
        for v in values:
            if chart is not None:
                flags.append(chart.update(v))
                continue
            head.append(v)
            flags.append((0, 0, 0))
            if len(head) >= self.n_train:
                chart = Ewma(float(np.mean(head)), float(np.var(head)), self.n_train)
                for x in head:
                    chart.update(x)
                head.clear()
        return chart, flags

    def _frame(self, key, ready: list) -> pd.DataFrame:
        out = pd.DataFrame([f for _, flags in ready for f in flags], columns=["pewma", "sd_ewma", "two_stage"]).astype("int32")
        out.insert(0, "us", np.concatenate([us for us, _ in ready]))
        out.insert(0, "id", key[0])
        return out

    def close(self) -> None:
        pass


def online_flags(events: DataFrame, n_train: int = 50, y: str = "y", late: str = "10 minutes", bucket: int = 60) -> DataFrame:
    """``id, ts, pewma, sd_ewma, two_stage``: the control charts of ``anomaly.ewma_charts(..., n_train=n_train)`` on a stream.

    Rows are put in time order (ties by value) across micro-batches: a row waits until the watermark, ``late`` behind the newest stamp, has passed
    its ``bucket`` of seconds, and rows later than that are dropped.  So flags do not depend on how rows are dealt to batches.  State per
    key: the rows of the open buckets and a few numbers.  The rows are kept as arrays over stretches of 256 buckets, one stretch at a time in memory,
    so that state calls go by stretches and not by rows.  Rows without a value or stamp are left out.  Timers need the RocksDB state store, which is
    set for the session's streams here.
    """
    if n_train < 1:
        raise ValueError("n_train must be 1 at least")
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    d = events.where(F.col(y).isNotNull() & F.col("ts").isNotNull()).select("id", F.col("ts").cast("timestamp").alias("at"), F.col(y).cast("double").alias("y"))
    d = d.withWatermark("at", late).withColumn("us", F.unix_micros("at"))
    key = events.schema["id"].dataType.simpleString()
    out = d.groupBy("id").transformWithStateInPandas(_OrderedCharts(n_train, 1000 * bucket), f"id {key}, us bigint, pewma int, sd_ewma int, two_stage int", "append", "eventTime")
    return out.select("id", F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"), "pewma", "sd_ewma", "two_stage")


def score_stream(events: DataFrame, model: PipelineModel, prepare: Callable[[DataFrame], DataFrame], sink: str,
                 checkpoint: str):
    """Score new stamps batch by batch with a fitted pipeline; idempotent per batch id."""
    def write(batch: DataFrame, epoch: int) -> None:
        scored = model.transform(prepare(batch)).select("id", "ts", "prediction")
        scored.write.mode("overwrite").parquet(f"{sink}/batch={epoch}")
    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_table(df: DataFrame, folder: str) -> DataFrame:
    """Run a stream over what is available into a Parquet table and read that."""
    q = (df.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").outputMode("append")
           .trigger(availableNow=True).start(f"{folder}/data"))
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/data")
