"""Panels the queries start from, and the same panels as SQL common table expressions."""

from pyspark.sql import functions as F

from tidewheel.core import step_index, step_start
from tidewheel.operators.timeverbs import pad_by_time, summarise_by_time


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _panel(df, key, ts, by, **aggs):
    d = df.withColumnsRenamed({key: "id", ts: "ts"})
    return summarise_by_time(d, by, **aggs)


def event_days(spark, sf):
    """id = event type; n events and v total value per day, padded with 0."""
    d = _panel(table(spark, sf, "events"), "event_type", "ts", "day",
               n=F.count(F.lit(1)), v=F.sum("value"))
    return pad_by_time(d, "day", fill={"n": 0, "v": 0.0})


def event_hours(spark, sf):
    d = _panel(table(spark, sf, "events"), "event_type", "ts", "hour", y=F.sum("value"))
    return pad_by_time(d, "hour", fill={"y": 0.0})


def order_days(spark, sf):
    """id = order priority; n orders and y total price per day, padded with 0."""
    d = _panel(table(spark, sf, "orders"), "o_orderpriority", "o_orderdate", "day",
               n=F.count(F.lit(1)), y=F.sum("o_totalprice"))
    return pad_by_time(d, "day", fill={"n": 0, "y": 0.0})


def order_days_sparse(spark, sf):
    """Same, but inserted days stay NULL."""
    d = _panel(table(spark, sf, "orders"), "o_orderpriority", "o_orderdate", "day",
               y=F.sum("o_totalprice"))
    return pad_by_time(d, "day")


def order_weeks(spark, sf):
    d = _panel(table(spark, sf, "orders"), "o_orderpriority", "o_orderdate", "week",
               y=F.sum("o_totalprice"))
    return pad_by_time(d, "week", fill={"y": 0.0})


def order_months(spark, sf):
    d = _panel(table(spark, sf, "orders"), "o_orderpriority", "o_orderdate", "month",
               y=F.sum("o_totalprice"))
    return pad_by_time(d, "month", fill={"y": 0.0})


def ship_days(spark, sf):
    """id = return flag; shipped quantity q and value x per day, padded with 0."""
    d = _panel(table(spark, sf, "lineitem"), "l_returnflag", "l_shipdate", "day",
               q=F.sum("l_quantity"), x=F.sum("l_extendedprice"))
    return pad_by_time(d, "day", fill={"q": 0.0, "x": 0.0})


def ship_total_days(spark, sf):
    """Regressor over all flags: shipped value per day."""
    d = table(spark, sf, "lineitem").groupBy(step_index("l_shipdate", "day").alias("k")).agg(
        F.sum("l_extendedprice").alias("x"))
    return d.select("k", step_start("k", "day").alias("ts"), "x")


def _padded(name, src, cols, by="DAY", fill="0", key="k"):
    """SQL for a padded panel; ``k`` is the number of days since 1970."""
    pick = ", ".join(f"CASE WHEN s.id IS NULL THEN {fill} ELSE s.{c} END AS {c}" for c in cols)
    return (f"{name}_s AS ({src}), {name}_g AS (SELECT id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 {by})) AS ts "
            f"FROM {name}_s GROUP BY id), {name} AS (SELECT g.id, CAST(g.ts AS TIMESTAMP) AS ts, "
            f"date_diff('{by.lower()}', TIMESTAMP '1970-01-01', CAST(g.ts AS TIMESTAMP)) AS k, {pick} "
            f"FROM {name}_g g LEFT JOIN {name}_s s ON s.id = g.id AND s.ts = g.ts)")


EVENT_DAYS = _padded("ev", "SELECT event_type AS id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, count(*) AS n, "
                     "sum(value) AS v FROM events GROUP BY 1, 2", ["n", "v"])
EVENT_HOURS = _padded("eh", "SELECT event_type AS id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, "
                      "sum(value) AS y FROM events GROUP BY 1, 2", ["y"], "HOUR")
_ORD = ("SELECT o_orderpriority AS id, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS ts, count(*) AS n, "
        "sum(o_totalprice) AS y FROM orders GROUP BY 1, 2")
ORDER_DAYS = _padded("od", _ORD, ["n", "y"])
ORDER_DAYS_SPARSE = _padded("od", _ORD, ["y"], fill="NULL")
ORDER_WEEKS = (
    "ow_s AS (SELECT o_orderpriority AS id, CAST(date_trunc('week', o_orderdate + INTERVAL 1 DAY) AS TIMESTAMP) - INTERVAL 1 DAY AS ts, "
    "sum(o_totalprice) AS y FROM orders GROUP BY 1, 2), ow_g AS (SELECT id, unnest(generate_series(min(ts), max(ts), INTERVAL 7 DAY)) AS ts "
    "FROM ow_s GROUP BY id), ow AS (SELECT g.id, CAST(g.ts AS TIMESTAMP) AS ts, coalesce(s.y, 0) AS y, "
    "(date_diff('day', TIMESTAMP '1970-01-01', CAST(g.ts AS TIMESTAMP)) + 4) // 7 AS k FROM ow_g g LEFT JOIN ow_s s ON s.id = g.id AND s.ts = g.ts)")
ORDER_MONTHS = (
    "om_s AS (SELECT o_orderpriority AS id, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS ts, sum(o_totalprice) AS y "
    "FROM orders GROUP BY 1, 2), om_g AS (SELECT id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 MONTH)) AS ts FROM om_s GROUP BY id), "
    "om AS (SELECT g.id, CAST(g.ts AS TIMESTAMP) AS ts, coalesce(s.y, 0) AS y, year(g.ts) * 12 + month(g.ts) - 1 AS k "
    "FROM om_g g LEFT JOIN om_s s ON s.id = g.id AND s.ts = g.ts)")
SHIP_DAYS = _padded("sd", "SELECT l_returnflag AS id, CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS ts, "
                    "sum(l_quantity) AS q, sum(l_extendedprice) AS x FROM lineitem GROUP BY 1, 2", ["q", "x"])
SHIP_TOTAL = ("st AS (SELECT CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS ts, sum(l_extendedprice) AS x "
              "FROM lineitem GROUP BY 1)")


def r(c, digits=4, name=None):
    """Rounded output column, so both engines' last bits agree."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits).alias(name if name else c)
