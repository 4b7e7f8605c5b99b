"""Streaming queries over the events table, run to completion with ``availableNow``."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.anomalies import charts_sql
from catalog.panels import r, table
from tidewheel.forecast import learners as M
from tidewheel.session import new_folder
from tidewheel.streaming import live as LV


def _events(spark, sf):
    s = LV.read_events(spark, sf, table(spark, sf, "events").schema, "events.parquet")
    return s.select(F.col("event_type").alias("id"), "ts", F.col("value").alias("y"), "user_id", "event_id")


@query("stream_tumbling_day", "SELECT event_type AS id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS start, count(*) AS n, round(sum(value), 4) AS v FROM events "
       "GROUP BY 1, 2 HAVING date_trunc('day', min(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)")
def _(spark, sf):
    d = LV.summarise_by_window(_events(spark, sf), "1 day", n=F.count(F.lit(1)), v=F.sum("y"))
    return LV.run_to_table(d, new_folder(spark)).select("id", "start", "n", r("v"))


@query("stream_sliding_week", "WITH e AS (SELECT event_type AS id, value, CAST(date_trunc('day', ts) AS TIMESTAMP) - CAST(j AS INTEGER) * INTERVAL 1 DAY AS start FROM events, (SELECT unnest(range(0, 7)) AS j)) "
       "SELECT id, start, round(avg(value), 5) AS mean FROM e WHERE start + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events) GROUP BY 1, 2")
def _(spark, sf):
    d = LV.summarise_by_window(_events(spark, sf), "7 days", "1 day", mean=F.avg("y"))
    return LV.run_to_table(d, new_folder(spark)).select("id", "start", r("mean", 5))


@query("stream_static_enrichment", "WITH c AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, count(*) AS event FROM events WHERE event_type = 'signup' AND value > 100 GROUP BY 1) "
       "SELECT event_id, coalesce(CAST(event AS DOUBLE), 0) AS event FROM events LEFT JOIN c ON c.day = date_trunc('day', ts)")
def _(spark, sf):
    cal = table(spark, sf, "events").where("event_type = 'signup' AND value > 100").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("event"))
    d = LV.enrich(_events(spark, sf).withColumn("day", F.to_date("ts")), cal, ["day"], ["event"])
    return LV.run_to_table(d.select("event_id", "event"), new_folder(spark))


@query("stream_online_flags", charts_sql("eh AS (SELECT event_type AS id, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts, value) AS k, value AS y FROM events)", "50") +
       "SELECT id, ts, pewma, sd_ewma, two_stage FROM rr WHERE i > 0 AND (epoch_ms(ts) // 60000 + 1) * 60000 <= (SELECT epoch_ms(max(ts)) - 600000 FROM events)")
def _(spark, sf):
    """Control charts in event time: every row whose minute the watermark has passed, flagged as a batch run would flag it."""
    return LV.run_to_table(LV.online_flags(_events(spark, sf)), new_folder(spark))


@query("stream_model_scoring")
def _(spark, sf):
    prepare = lambda d: d.withColumns({"h": F.hour("ts").cast("double"), "wd": F.dayofweek("ts").cast("double")})
    train = prepare(table(spark, sf, "events").select("ts", F.col("value").alias("y")))
    model = M.linear(["h", "wd"]).fit(train)
    out = new_folder(spark)
    LV.score_stream(_events(spark, sf), model, prepare, f"{out}/scored", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/scored").select("id", "ts", r("prediction"))
