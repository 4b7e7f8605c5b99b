"""Queries for sources, verbs, joins, aggregates, reshaping and windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog import query
from catalog import panels as P
from catalog.panels import r, table
from tidewheel.core import epoch_second, exact_quantiles, step_index, step_start, with_position
from tidewheel.functions import scalars as S
from tidewheel.operators import timeverbs as T
from tidewheel.operators import transforms as X
from tidewheel.operators import verbs as V
from tidewheel.operators import windows as W
from tidewheel.sources import competition as C
from tidewheel.session import new_folder
from tidewheel.sources import io


# ------------------------------------------------------------------ sources and sinks

@query("read_snapshot", "SELECT event_type, count(*) AS n, round(sum(value), 3) AS v FROM events GROUP BY 1")
def _(spark, sf):
    return io.read_snapshot(spark, f"{sf}/events.parquet").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("v"))


@query("csv_round_trip_bind", "SELECT 'customer' AS src, c_nationkey AS nation, count(*) AS n, count(c_mktsegment) AS n_seg FROM customer GROUP BY 2 "
       "UNION ALL SELECT 'supplier', s_nationkey, count(*), 0 FROM supplier GROUP BY 2")
def _(spark, sf):
    out = new_folder(spark)
    io.write_snapshot(table(spark, sf, "customer").select(F.lit("customer").alias("src"), F.col("c_nationkey").alias("nation"), "c_mktsegment"),
                      f"{out}/a", "csv")
    io.write_snapshot(table(spark, sf, "supplier").select(F.lit("supplier").alias("src"), F.col("s_nationkey").alias("nation")),
                      f"{out}/b", "csv")
    d = io.read_csv_many(spark, [(f"{out}/a", "src string, nation int, c_mktsegment string"),
                                 (f"{out}/b", "src string, nation int")])
    return d.groupBy("src", "nation").agg(F.count(F.lit(1)).alias("n"), F.count("c_mktsegment").alias("n_seg"))


@query("artifact_params_round_trip", "SELECT event_type AS id, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd FROM events GROUP BY 1")
def _(spark, sf):
    out = new_folder(spark)
    p = X.scale_params(table(spark, sf, "events").withColumnRenamed("event_type", "id"), "value")
    io.save_artifacts(out, tables={"params": p})
    return io.load_table(spark, out, "params").select("id", r("mean", 6), r("sd", 6))


@query("make_timeseries_counts", "WITH g AS (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH)) AS ts) "
       "SELECT CAST(g.ts AS TIMESTAMP) AS ts, count(o_orderkey) AS n FROM g LEFT JOIN orders ON date_trunc('month', o_orderdate) = g.ts GROUP BY 1")
def _(spark, sf):
    g = io.make_timeseries(spark, "1995-01-01", "1 month", 84)
    o = T.summarise_by_time(table(spark, sf, "orders"), "month", keys=(), ts="o_orderdate", c=F.count(F.lit(1))).withColumnRenamed("o_orderdate", "ts")
    return g.join(o.select("ts", "c"), "ts", "left").select("ts", F.coalesce("c", F.lit(0)).alias("n"))


@query("inline_frame_join", "SELECT s.label AS label, count(*) AS n FROM orders o JOIN (VALUES ('O', 'open'), ('F', 'filled'), ('P', 'partial')) s(st, label) "
       "ON o.o_orderstatus = s.st GROUP BY 1")
def _(spark, sf):
    s = io.inline_frame(spark, [("O", "open"), ("F", "filled"), ("P", "partial")], "o_orderstatus string, label string")
    return table(spark, sf, "orders").join(s, "o_orderstatus").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ projections and predicates

@query("select_drop_patterns", "SELECT l_shipdate, l_quantity, l_extendedprice FROM lineitem WHERE l_quantity > 49")
def _(spark, sf):
    d = V.select(table(spark, sf, "lineitem"), V.ends_with("date"), V.col_range("l_quantity", "l_tax"), V.matches("^l_comment$"))
    return V.drop(d, V.contains("disc"), V.starts_with("l_tax")).where(F.col("l_quantity") > 49)


@query("mutate_case_across", "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'high' WHEN o_totalprice > 50000 THEN 'mid' ELSE 'low' END AS band, "
       "CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS is_open, round(ln(o_totalprice + 1), 6) AS o_totalprice, "
       "o_orderpriority LIKE '%URGENT%' AS urgent, 'actual' AS type FROM orders")
def _(spark, sf):
    d = table(spark, sf, "orders").withColumn("band", F.when(F.col("o_totalprice") > 200000, "high").when(F.col("o_totalprice") > 50000, "mid").otherwise("low"))
    d = V.across(d, V.matches("price$"), lambda c: F.round(F.log1p(c), 6))
    return d.select("o_orderkey", "band", F.when(F.col("o_orderstatus") == "O", 1).otherwise(0).alias("is_open"), "o_totalprice",
                    F.col("o_orderpriority").contains("URGENT").alias("urgent"), F.lit("actual").alias("type"))


@query("rename_filter_dropna", "SELECT o_orderkey AS lag_orderkey, o_totalprice AS lag_totalprice, nullif(o_orderstatus, 'P') AS status FROM orders "
       "WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'P'")
def _(spark, sf):
    d = table(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", "o_totalprice", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"))
    return V.rename_with(d, V.starts_with("o_"), lambda c: "lag_" + c[2:]).dropna(subset=["status"])


@query("coerce_and_parse_dates", "SELECT event_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts_h, CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts_s, CAST(value AS BIGINT) AS whole "
       "FROM (SELECT event_id, ts, trunc(value) AS value FROM events)")
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", S.ymd_h(F.date_format("ts", "yyyyMMddHH")).alias("ts_h"),
        S.ymd_hms(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts_s"), F.col("value").cast("bigint").alias("whole"))


# ------------------------------------------------------------------ time verbs

@query("summarise_by_day", "SELECT event_type AS id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, count(*) AS n, round(sum(value), 4) AS v FROM events GROUP BY 1, 2")
def _(spark, sf):
    d = table(spark, sf, "events").withColumnRenamed("event_type", "id")
    return T.summarise_by_time(d, "day", n=F.count(F.lit(1)), v=F.round(F.sum("value"), 4)).drop("k")


@query("summarise_by_week_sunday", "SELECT o_orderpriority AS id, CAST(date_trunc('week', o_orderdate + INTERVAL 1 DAY) AS TIMESTAMP) - INTERVAL 1 DAY AS ts, "
       "count(*) AS n, round(avg(o_totalprice), 5) AS mean, round(median(o_totalprice), 4) AS median, round(min(o_totalprice), 4) AS lo, round(max(o_totalprice), 4) AS hi "
       "FROM orders GROUP BY 1, 2")
def _(spark, sf):
    d = table(spark, sf, "orders").withColumnsRenamed({"o_orderpriority": "id", "o_orderdate": "ts"})
    base = T.summarise_by_time(d, "week", n=F.count(F.lit(1)), mean=F.round(F.avg("o_totalprice"), 5),
                               lo=F.round(F.min("o_totalprice"), 4), hi=F.round(F.max("o_totalprice"), 4))
    med = exact_quantiles(d.withColumn("k", step_index("ts", "week")), "o_totalprice", {"median": .5}, keys=["id", "k"])
    return base.join(med, ["id", "k"]).select("id", "ts", "n", "mean", r("median"), "lo", "hi")


@query("summarise_by_month_wide", "SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS ts, "
       "round(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 2) AS A, round(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END), 2) AS N, "
       "round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 2) AS R FROM lineitem GROUP BY 1")
def _(spark, sf):
    d = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("id"), F.col("l_shipdate").alias("ts"), "l_quantity")
    m = T.summarise_by_time(d, "month", q=F.round(F.sum("l_quantity"), 2))
    return V.pivot_wider(m, ["ts"], "id", "q", ["A", "N", "R"])


@query("pad_by_day_zero", f"WITH {P.ORDER_DAYS} SELECT id, ts, n, round(y, 4) AS y FROM od")
def _(spark, sf):
    return P.order_days(spark, sf).select("id", "ts", "n", r("y"))


@query("pad_by_day_null_extended", "WITH s AS (SELECT event_type AS id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, count(*) AS n FROM events GROUP BY 1, 2), "
       "g AS (SELECT id, unnest(generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-02-03', INTERVAL 1 DAY)) AS ts FROM (SELECT DISTINCT id FROM s)) "
       "SELECT g.id, CAST(g.ts AS TIMESTAMP) AS ts, s.n FROM g LEFT JOIN s ON s.id = g.id AND s.ts = g.ts")
def _(spark, sf):
    d = table(spark, sf, "events").withColumnRenamed("event_type", "id")
    d = T.summarise_by_time(d, "day", n=F.count(F.lit(1)))
    return T.pad_by_time(d, "day", start="2023-12-25", end="2024-02-03").select("id", "ts", "n")


@query("spread_week_to_days", f"WITH {P.ORDER_WEEKS}, last AS (SELECT id, max(ts) AS hi FROM ow GROUP BY 1), "
       "days AS (SELECT ow.id, unnest(generate_series(ow.ts, CASE WHEN ow.ts = hi THEN ow.ts ELSE ow.ts + INTERVAL 6 DAY END, INTERVAL 1 DAY)) AS ts, y FROM ow JOIN last USING (id)) "
       "SELECT id, CAST(ts AS TIMESTAMP) AS ts, round(y / 7, 4) AS y FROM days")
def _(spark, sf):
    return T.spread_to_finer(P.order_weeks(spark, sf), "y", "week", "day").select("id", "ts", r("y"))


@query("filter_by_time_partial_dates", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-12-01' AND o_orderdate < TIMESTAMP '1998-01-01'")
def _(spark, sf):
    return T.filter_by_time(table(spark, sf, "orders"), "1996-12", "1997", ts="o_orderdate").select("o_orderkey", "o_orderdate")


@query("filter_by_time_plus_duration", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-17'")
def _(spark, sf):
    return T.filter_by_time(table(spark, sf, "events"), "2024-01-03", T.plus_time("2024-01-03", "2 weeks")).select("event_id", "ts")


@query("between_time_replace", f"WITH {P.ORDER_DAYS} SELECT id, ts, round(CASE WHEN ts BETWEEN TIMESTAMP '1997-11-01' AND TIMESTAMP '1997-11-30 23:59:59.999999' "
       "THEN ln(1 + y) ELSE y END, 4) AS y FROM od")
def _(spark, sf):
    d = P.order_days(spark, sf)
    return d.select("id", "ts", F.round(F.when(T.between_time("ts", "1997-11", "1997-11"), F.log1p("y")).otherwise(F.col("y")), 4).alias("y"))


@query("mutate_by_month", f"WITH {P.EVENT_DAYS} SELECT id, ts, n, round(avg(v) OVER w, 4) AS v_mean, max(n) OVER w AS n_max, min(n) OVER w AS n_min, round(median(v) OVER w, 4) AS v_med FROM ev "
       "WINDOW w AS (PARTITION BY id, date_trunc('week', ts + INTERVAL 1 DAY))")
def _(spark, sf):
    # A week has seven days here, so an exact median per cell stays small.
    d = T.mutate_by_time(P.event_days(spark, sf), "week", v_mean=F.round(F.avg("v"), 4), n_max=F.max("n"), n_min=F.min("n"),
                         v_med=F.round(F.median("v"), 4))
    return d.select("id", "ts", "n", "v_mean", "n_max", "n_min", "v_med")


@query("join_by_time_left", f"WITH {P.ORDER_DAYS}, {P.SHIP_TOTAL} SELECT od.id, od.ts, od.n, round(st.x, 3) AS x FROM od LEFT JOIN st ON od.ts = st.ts")
def _(spark, sf):
    s = P.ship_total_days(spark, sf).select(F.col("ts").alias("ship_date"), "x")
    d = P.order_days(spark, sf)
    return d.join(s, d.ts == s.ship_date, "left").select("id", "ts", "n", r("x", 3))


@query("future_frame_56", f"WITH {P.ORDER_DAYS}, l AS (SELECT id, max(ts) AS hi FROM od GROUP BY 1) "
       "SELECT id, CAST(ts AS TIMESTAMP) AS ts, y FROM (SELECT id, unnest(generate_series(hi + INTERVAL 1 DAY, hi + INTERVAL 56 DAY, INTERVAL 1 DAY)) AS ts, CAST(NULL AS DOUBLE) AS y FROM l) "
       "UNION ALL SELECT id, ts, round(y, 4) FROM od")
def _(spark, sf):
    return T.future_frame(P.order_days(spark, sf).drop("n"), "day", "8 weeks", bind=True).select("id", "ts", r("y"))


@query("future_frame_inferred", f"WITH {P.EVENT_HOURS}, {P.ORDER_DAYS}, {P.ORDER_WEEKS}, {P.ORDER_MONTHS}, "
       "l AS (SELECT 'h ' || id AS id, max(ts) AS hi, 1344 AS n, INTERVAL 1 HOUR AS step FROM eh GROUP BY id UNION ALL SELECT 'd ' || id, max(ts), 56, INTERVAL 1 DAY FROM od GROUP BY id "
       "UNION ALL SELECT 'w ' || id, max(ts), 8, INTERVAL 7 DAY FROM ow GROUP BY id UNION ALL SELECT 'm ' || id, max(ts), 2, INTERVAL 1 MONTH FROM om GROUP BY id) "
       "SELECT id, CAST(h AS INTEGER) AS h, CAST(hi + CAST(h AS INTEGER) * step AS TIMESTAMP) AS ts FROM (SELECT *, unnest(range(1, n + 1)) AS h FROM l)")
def _(spark, sf):
    """Hourly, daily, weekly and monthly series go on for eight weeks, each in its own step."""
    kinds = {"h": P.event_hours, "d": P.order_days, "w": P.order_weeks, "m": P.order_months}
    parts = [f(spark, sf).select(F.concat(F.lit(f"{n} "), "id").alias("id"), "ts") for n, f in kinds.items()]
    return T.future_frame(parts[0].union(parts[1]).union(parts[2]).union(parts[3]), None, "8 weeks").select("id", "h", "ts")


@query("extend_monthly", f"WITH {P.ORDER_MONTHS}, l AS (SELECT id, max(ts) AS hi FROM om GROUP BY 1) "
       "SELECT id, CAST(unnest(generate_series(hi + INTERVAL 1 MONTH, hi + INTERVAL 6 MONTH, INTERVAL 1 MONTH)) AS TIMESTAMP) AS ts FROM l")
def _(spark, sf):
    return T.future_frame(P.order_months(spark, sf), "month", "2 quarters").select("id", "ts")


@query("summary_diagnostics", "WITH s AS (SELECT o_orderpriority AS id, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS ts FROM orders GROUP BY 1, 2), "
       "d AS (SELECT id, ts, CAST(date_diff('second', lag(ts) OVER (PARTITION BY id ORDER BY ts), ts) AS DOUBLE) AS gap FROM s) "
       "SELECT id, count(*) AS n_obs, min(ts) AS start, max(ts) AS \"end\", min(gap) AS diff_min, quantile_cont(gap, 0.25) AS diff_q1, median(gap) AS diff_median, "
       "round(avg(gap), 4) AS diff_mean, quantile_cont(gap, 0.75) AS diff_q3, max(gap) AS diff_max FROM d GROUP BY 1")
def _(spark, sf):
    d = table(spark, sf, "orders").withColumnsRenamed({"o_orderpriority": "id", "o_orderdate": "ts"})
    d = T.summarise_by_time(d, "day", n=F.count(F.lit(1)))
    return T.summary_diagnostics(d, "day").withColumn("diff_mean", F.round("diff_mean", 4))


@query("missing_profile", f"WITH {P.ORDER_DAYS_SPARSE}, c AS (SELECT count(*) AS n, count(*) - count(y) AS y, count(*) - count(id) AS id, count(*) - count(ts) AS ts FROM od) "
       "SELECT 'y' AS \"column\", y AS n_missing, n, round(y / n, 6) AS pct_missing FROM c UNION ALL SELECT 'id', id, n, round(id / n, 6) FROM c UNION ALL SELECT 'ts', ts, n, round(ts / n, 6) FROM c")
def _(spark, sf):
    return T.missing_profile(P.order_days_sparse(spark, sf), ["y", "id", "ts"]).withColumn("pct_missing", F.round("pct_missing", 6))


@query("two_digit_year_repair", "SELECT o_orderkey, CASE WHEN d > TIMESTAMP '2019-12-31' THEN d - INTERVAL 100 YEAR ELSE d END AS date FROM "
       "(SELECT o_orderkey, CASE WHEN year(o_orderdate) < 2000 THEN o_orderdate + INTERVAL 100 YEAR ELSE o_orderdate END AS d FROM orders)")
def _(spark, sf):
    text = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd-MM-yy HH:mm").alias("t"))
    return text.select("o_orderkey", C.repair_two_digit_year(S.dmy_hm("t")).alias("date"))


_PERIODS = ("CASE s_nationkey % 6 WHEN 0 THEN 'Hourly' WHEN 1 THEN 'Daily' WHEN 2 THEN 'Weekly' WHEN 3 THEN 'Monthly' WHEN 4 THEN 'Quarterly' ELSE 'Yearly' END")


def _long_positions(spark, sf):
    """Order days as 1-based positions per customer nation; the last quarter of 2001 plays the test part."""
    d = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    m = d.groupBy(F.col("c_nationkey").alias("id"), step_index("o_orderdate", "month").alias("m")).agg(F.sum("o_totalprice").alias("value"))
    m = m.withColumn("type", F.when(F.col("m") >= 2001 * 12, "test").otherwise("train"))
    return with_position(m.withColumn("ts", step_start("m", "month")), keys=("id", "type"), name="date").select("id", "type", "date", "value")


_LONG = ("m AS (SELECT c_nationkey AS id, date_trunc('month', o_orderdate) AS ts, sum(o_totalprice) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2), "
         "lp AS (SELECT id, CASE WHEN ts >= TIMESTAMP '2001-01-01' THEN 'test' ELSE 'train' END AS type, value, "
         "row_number() OVER (PARTITION BY id, ts >= TIMESTAMP '2001-01-01' ORDER BY ts) AS date FROM m), "
         "tr AS (SELECT id, count(*) AS n FROM lp WHERE type = 'train' GROUP BY 1), "
         "ci AS (SELECT lp.id, type, CASE WHEN type = 'test' THEN date + n ELSE date END AS date, value FROM lp LEFT JOIN tr USING (id))")


@query("continue_positional_index", f"WITH {_LONG} SELECT id, type, date, round(value, 2) AS value FROM ci")
def _(spark, sf):
    return C.continue_index(_long_positions(spark, sf)).select("id", "type", "date", r("value", 2))


@query("calendar_offset_by_frequency", f"WITH {_LONG}, p AS (SELECT ci.*, CASE id % 6 WHEN 0 THEN 'Hourly' WHEN 1 THEN 'Daily' WHEN 2 THEN 'Weekly' WHEN 3 THEN 'Monthly' WHEN 4 THEN 'Quarterly' ELSE 'Yearly' END AS period, "
       "CAST(date - 1 AS INTEGER) AS d, TIMESTAMP '1996-01-31' + id * INTERVAL 1 DAY AS start FROM ci) "
       "SELECT id, date, period, CASE period WHEN 'Hourly' THEN start + d * INTERVAL 1 HOUR WHEN 'Daily' THEN start + d * INTERVAL 1 DAY WHEN 'Weekly' THEN start + d * INTERVAL 7 DAY "
       "WHEN 'Monthly' THEN start + d * INTERVAL 1 MONTH WHEN 'Quarterly' THEN start + d * INTERVAL 3 MONTH ELSE start + d * INTERVAL 12 MONTH END AS ts FROM p")
def _(spark, sf):
    d = C.continue_index(_long_positions(spark, sf))
    names = F.array(*[F.lit(x) for x in ("Hourly", "Daily", "Weekly", "Monthly", "Quarterly", "Yearly")])
    d = d.withColumn("period", F.element_at(names, F.pmod("id", F.lit(6)) + 1)).withColumn(
        "start", F.lit("1996-01-31").cast("timestamp_ntz") + F.make_interval(days=F.col("id").cast("int")))
    return d.select("id", "date", "period", C.calendar_offset("start", "period", "date").alias("ts"))


@query("wide_matrix_to_long", f"WITH {_LONG} SELECT CAST(id AS VARCHAR) AS id, date, round(value, 2) AS value FROM ci")
def _(spark, sf):
    d = C.continue_index(_long_positions(spark, sf))
    columns = [f"V{i + 1}" for i in range(1, (d.agg(F.max("date")).first()[0] or 0) + 1)]
    wide = V.pivot_wider(d.withColumn("v", F.concat(F.lit("V"), F.col("date") + 1)), ["id"], "v", "value", columns)
    return C.wide_to_long(wide.withColumn("id", F.col("id").cast("string")).withColumnRenamed("id", "V1")).select("id", "date", r("value", 2))


# ------------------------------------------------------------------ joins

@query("natural_join", "SELECT n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def _(spark, sf):
    reg = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return V.natural_join(table(spark, sf, "nation"), reg).select("n_name", "r_name")


@query("semi_join_ids", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000)")
def _(spark, sf):
    ids = table(spark, sf, "customer").where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 5000)).select(F.col("c_custkey").alias("o_custkey"))
    return V.keep_ids(table(spark, sf, "orders"), ids, ["o_custkey"]).select("o_orderkey")


@query("right_join_labels", "SELECT o.o_orderkey, c.c_mktsegment AS cluster FROM (SELECT * FROM customer WHERE c_acctbal > 0) c RIGHT JOIN orders o ON c.c_custkey = o.o_custkey")
def _(spark, sf):
    lab = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("cluster"))
    return lab.join(table(spark, sf, "orders"), "o_custkey", "right").select("o_orderkey", "cluster")


@query("bind_cols_by_key", f"WITH {P.EVENT_DAYS} SELECT id, ts, n, round(v, 4) AS v, round(avg(n) OVER (PARTITION BY id), 6) AS n_mean FROM ev")
def _(spark, sf):
    d = P.event_days(spark, sf)
    a, m = d.select("id", "ts", "n"), d.groupBy("id").agg(F.round(F.avg("n"), 6).alias("n_mean"))
    return V.bind_cols(a, d.select("id", "ts", r("v")).join(m, "id"), ["id", "ts"])


@query("lead_time_join", "WITH f AS (SELECT o_orderpriority AS id, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS issue, 24 * (1 + o_orderkey % 3) AS hors, max(o_totalprice) AS ws FROM orders GROUP BY 1, 2, 3), "
       "v AS (SELECT id, issue, hors, ws, issue + CAST(hors AS INTEGER) * INTERVAL 1 HOUR AS ts FROM f), "
       "p AS (SELECT o_orderpriority AS id, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS ts, count(*) AS n FROM orders GROUP BY 1, 2), "
       "b AS (SELECT *, row_number() OVER (PARTITION BY id, ts ORDER BY issue DESC) AS rn FROM v WHERE issue <= ts - INTERVAL 36 HOUR) "
       "SELECT p.id, p.ts, p.n, b.issue, b.hors, b.ws FROM p LEFT JOIN b ON b.id = p.id AND b.ts = p.ts AND b.rn = 1")
def _(spark, sf):
    d = table(spark, sf, "orders").withColumnsRenamed({"o_orderpriority": "id", "o_orderdate": "ts"})
    f = d.groupBy("id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("issue"), (24 * (1 + F.col("o_orderkey") % 3)).alias("hors")).agg(
        F.max("o_totalprice").alias("ws"))
    power = T.summarise_by_time(d, "day", n=F.count(F.lit(1))).drop("k")
    return C.lead_time_join(power, f, F.col("ts") - F.make_interval(hours=F.lit(36)))


# ------------------------------------------------------------------ aggregates

@query("count_by", "SELECT o_orderpriority AS id, o_orderstatus AS type, count(*) AS n FROM orders GROUP BY 1, 2")
def _(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("id"), F.col("o_orderstatus").alias("type")).agg(F.count(F.lit(1)).alias("n"))


@query("knot_quantiles", "SELECT l_returnflag AS id, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25, round(quantile_cont(l_extendedprice, 0.5), 4) AS q50, "
       "round(quantile_cont(l_extendedprice, 0.75), 4) AS q75, round(quantile_cont(l_extendedprice, 0.1), 4) AS q10, round(quantile_cont(l_extendedprice, 0.999), 4) AS q999 FROM lineitem GROUP BY 1")
def _(spark, sf):
    d = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "id")
    q = exact_quantiles(d, "l_extendedprice", {"q25": .25, "q50": .5, "q75": .75, "q10": .1, "q999": .999}, keys=["id"])
    return q.select("id", *[r(c) for c in ("q25", "q50", "q75", "q10", "q999")])


@query("distinct_ids", "SELECT DISTINCT user_id FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("user_id").distinct()


@query("row_sums", "SELECT l_orderkey, l_linenumber, round(l_quantity + l_discount + l_tax, 4) AS total, round((l_quantity + l_discount + l_tax) / 3, 4) AS mean FROM lineitem")
def _(spark, sf):
    c = ("l_quantity", "l_discount", "l_tax")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(V.row_sum(*c), 4).alias("total"), F.round(V.row_mean(*c), 4).alias("mean"))


@query("user_aggregate", "SELECT event_type AS id, round(avg(value) * 2, 4) AS my_mean, round(max(value) - min(value), 4) AS spread FROM events GROUP BY 1")
def _(spark, sf):
    V.register_aggregate("my_mean", lambda c: F.avg(c) * 2)
    V.register_aggregate("spread", lambda c: F.max(c) - F.min(c))
    d = table(spark, sf, "events").withColumnRenamed("event_type", "id")
    return d.groupBy("id").agg(*[F.round(V.AGGREGATES[n](F.col("value")), 4).alias(n) for n in ("my_mean", "spread")])


# ------------------------------------------------------------------ order, slices, reshape

@query("arrange", f"WITH {_LONG} SELECT id, type, date FROM ci ORDER BY id, type DESC, date")
def _(spark, sf):
    return C.continue_index(_long_positions(spark, sf)).select("id", "type", "date").orderBy("id", F.desc("type"), "date")


@query("slice_max_with_ties", "SELECT id, ts, n FROM (SELECT event_type AS id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, count(*) AS n, rank() OVER (PARTITION BY event_type ORDER BY count(*) DESC) AS rk FROM events GROUP BY 1, 2) WHERE rk <= 3")
def _(spark, sf):
    d = T.summarise_by_time(table(spark, sf, "events").withColumnRenamed("event_type", "id"), "day", n=F.count(F.lit(1)))
    return V.slice_ranked(d, "n", 3, largest=True, by=["id"]).select("id", "ts", "n")


@query("slice_rows_head_tail", "WITH s AS (SELECT o_orderpriority AS id, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS ts FROM orders GROUP BY 1, 2), "
       "p AS (SELECT id, ts, row_number() OVER (PARTITION BY id ORDER BY ts) AS pos, row_number() OVER (PARTITION BY id ORDER BY ts DESC) AS back FROM s) "
       "SELECT 'slice' AS what, id, ts FROM p WHERE pos BETWEEN 2 AND 10 AND pos NOT IN (3, 5) UNION ALL SELECT 'tail', id, ts FROM p WHERE back <= 4 UNION ALL SELECT 'head', id, ts FROM p WHERE pos <= 2")
def _(spark, sf):
    d = table(spark, sf, "orders").withColumnsRenamed({"o_orderpriority": "id", "o_orderdate": "ts"})
    p = with_position(T.summarise_by_time(d, "day", n=F.count(F.lit(1))).drop("k", "n"), name="pos")
    mid = V.slice_drop(V.slice_rows(p, 2, 10, pos="pos"), 3, 5, pos="pos")
    tag = lambda w, x: x.select(F.lit(w).alias("what"), "id", "ts")
    return io.bind_rows(tag("slice", mid), tag("tail", V.slice_tail(p, 4, order="pos")), tag("head", V.slice_head(p, 2, order=["pos"])))


@query("split_known_and_future", f"WITH {P.EVENT_DAYS}, h AS (SELECT id, max(ts) AS hi FROM ev GROUP BY 1), f AS (SELECT id, CAST(unnest(generate_series(hi + INTERVAL 1 DAY, hi + INTERVAL 7 DAY, INTERVAL 1 DAY)) AS TIMESTAMP) AS ts FROM h) "
       "SELECT 'known' AS part, id, ts FROM ev UNION ALL SELECT 'future', id, ts FROM f")
def _(spark, sf):
    d = T.future_frame(P.event_days(spark, sf), "day", 7, bind=True)
    known, future = V.split_by_target(d, "v")
    assert V.to_forecast(d, "v").columns == future.columns
    return known.select(F.lit("known").alias("part"), "id", "ts").union(future.select(F.lit("future").alias("part"), "id", "ts"))


@query("stratified_sample", "SELECT c_mktsegment, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(concat(CAST(c_custkey AS VARCHAR), '|', '123')), c_custkey) AS rn FROM customer) WHERE rn <= 20")
def _(spark, sf):
    return C.sample_per_stratum(table(spark, sf, "customer"), "c_mktsegment", "c_custkey", 20, 123).select("c_mktsegment", "c_custkey")


@query("bind_rows_fill", "SELECT c_nationkey AS nation, c_acctbal AS bal, c_mktsegment AS seg FROM customer UNION ALL SELECT s_nationkey, s_acctbal, NULL FROM supplier")
def _(spark, sf):
    return io.bind_rows(table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg")),
                        table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("bal")))


@query("pivot_longer", f"WITH {P.SHIP_DAYS} SELECT id, ts, 'q' AS name, round(q, 3) AS value FROM sd UNION ALL SELECT id, ts, 'x', round(x, 3) FROM sd")
def _(spark, sf):
    d = V.pivot_longer(P.ship_days(spark, sf), V.matches("^[qx]$"), ["id", "ts"])
    return d.withColumn("value", F.round("value", 3))


@query("nest_unnest", f"WITH {P.EVENT_DAYS} SELECT id, ts, n, count(*) OVER (PARTITION BY id) AS len FROM ev")
def _(spark, sf):
    n = V.nest(P.event_days(spark, sf).select("id", "ts", "n"), ["id"])
    return V.unnest(n.withColumn("len", F.size("data").cast("bigint")))


# ------------------------------------------------------------------ transforms and windows

@query("log_transforms", f"WITH {P.ORDER_DAYS} SELECT id, ts, round(ln(1 + y), 6) AS l1p, round(CASE WHEN y > 0 THEN ln(y) END, 6) AS l, round(y, 4) AS back FROM od")
def _(spark, sf):
    return P.order_days(spark, sf).select("id", "ts", F.round(F.log1p("y"), 6).alias("l1p"), F.round(F.log("y"), 6).alias("l"),
                                          F.round(F.expm1(F.log1p("y")), 4).alias("back"))


_LAM = ", ".join(f"({-1 + i * 0.1:.1f})" for i in range(31))


@query("box_cox_auto", f"WITH {P.ORDER_DAYS}, l(lam) AS (VALUES {_LAM}), t AS (SELECT id, CAST(lam AS DOUBLE) AS lam, ln(y) AS ly, CASE WHEN lam = 0 THEN ln(y) ELSE (pow(y, lam) - 1) / lam END AS z FROM od, l WHERE y > 0), "
       "s AS (SELECT id, lam, -count(*) / 2.0 * ln(var_pop(z)) + (lam - 1) * sum(ly) AS ll FROM t GROUP BY 1, 2), b AS (SELECT id, arg_max(lam, ll) AS lam FROM s GROUP BY 1) "
       "SELECT od.id, ts, lam AS lambda, round(CASE WHEN y <= 0 THEN NULL WHEN lam = 0 THEN ln(y) ELSE (pow(y, lam) - 1) / lam END, 4) AS z FROM od JOIN b ON od.id = b.id")
def _(spark, sf):
    d = P.order_days(spark, sf)
    p = X.box_cox_lambda(d).select("id", "lambda")
    return d.join(p, "id").select("id", "ts", "lambda", F.round(F.when(F.col("y") > 0, S.box_cox("y", "lambda")), 4).alias("z"))


@query("normalize_standardize", f"WITH {P.ORDER_DAYS} SELECT id, ts, round((y - min(y) OVER w) / (max(y) OVER w - min(y) OVER w), 6) AS mm, round((y - avg(y) OVER w) / stddev_samp(y) OVER w, 6) AS z FROM od WINDOW w AS (PARTITION BY id)")
def _(spark, sf):
    d = X.standardize_vec(X.normalize_vec(P.order_days(spark, sf), out="mm"))
    return d.select("id", "ts", r("mm", 6), r("z", 6))


_LI = (f"WITH {P.ORDER_DAYS}, b AS (SELECT *, 1.1 * max(y) OVER (PARTITION BY id) + 1 AS u FROM od), z AS (SELECT *, ln((y + 1) / (u - (y + 1))) AS li FROM b)")


@query("log_interval_standardize", f"{_LI} SELECT id, ts, round((li - avg(li) OVER w) / stddev_samp(li) OVER w, 6) AS z FROM z WINDOW w AS (PARTITION BY id)")
def _(spark, sf):
    return X.log_interval_standardize(P.order_days(spark, sf))[0].select("id", "ts", r("z", 6))


@query("transform_inverse_round_trip", f"WITH {P.ORDER_DAYS} SELECT id, ts, round(y, 3) AS prediction, round(y, 3) AS hi FROM od")
def _(spark, sf):
    d, params = X.log_interval_standardize(P.order_days(spark, sf))
    fc = d.select("id", "ts", F.col("z").alias("prediction"), F.col("z").alias("hi"))
    return X.invert_forecast(fc, params, ["prediction", "hi"]).select("id", "ts", F.round(F.abs("prediction"), 3).alias("prediction"), F.round(F.abs("hi"), 3).alias("hi"))


def _loess_sql(half, degree):
    base = (f"WITH {P.ORDER_DAYS}, o AS (SELECT unnest(range(-{half}, {half} + 1)) AS j), w AS (SELECT j, pow(1 - pow(abs(j) / {half + 1}.0, 3), 3) AS wt FROM o), "
            "p AS (SELECT od.id, od.k - j AS k, j, wt, y FROM od, w), "
            "s AS (SELECT id, k, sum(wt) AS s0, sum(wt * j) AS s1, sum(wt * j * j) AS s2, sum(wt * y) AS t0, sum(wt * j * y) AS t1 FROM p GROUP BY 1, 2) ")
    value = "t0 / s0" if degree == 0 else "(s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1)"
    return base + f"SELECT od.id, od.ts, round({value}, 2) AS smooth FROM od JOIN s ON s.id = od.id AND s.k = od.k"


@query("loess_smooth_line", _loess_sql(15, 1))
def _(spark, sf):
    return W.augment(P.order_days(spark, sf), smooth=W.loess("y", 30, 1)).select("id", "ts", r("smooth", 2))


@query("loess_smooth_flat", _loess_sql(7, 0))
def _(spark, sf):
    return W.augment(P.order_days(spark, sf), smooth=W.loess("y", 14, 0)).select("id", "ts", r("smooth", 2))


@query("slidify_aligned", f"WITH {P.ORDER_DAYS} SELECT id, ts, "
       "CASE WHEN count(*) OVER c = 7 THEN round(avg(y) OVER c, 4) END AS mid7, CASE WHEN count(*) OVER t = 7 THEN round(max(y) OVER t, 4) END AS max7, "
       "CASE WHEN count(*) OVER l = 7 THEN round(min(y) OVER l, 4) END AS lead7, round(avg(y) OVER e, 4) AS even4 FROM od "
       "WINDOW c AS (PARTITION BY id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), t AS (PARTITION BY id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), "
       "l AS (PARTITION BY id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING), e AS (PARTITION BY id ORDER BY ts ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING)")
def _(spark, sf):
    d = W.augment(P.order_days(spark, sf), mid7=W.slide("y", 7, align="center"), max7=W.slide("y", 7, F.max),
                  lead7=W.slide("y", 7, F.min, "left"), even4=W.slide("y", 4, align="center", partial=True))
    return d.select("id", "ts", r("mid7"), r("max7"), r("lead7"), r("even4"))


@query("rolling_many_periods", f"WITH {P.ORDER_DAYS} SELECT id, ts, " + ", ".join(
    f"round(avg(y) OVER (PARTITION BY id ORDER BY ts ROWS BETWEEN {p - 1} PRECEDING AND CURRENT ROW) / 7, 4) AS y_roll_{p}" for p in (7, 14, 30, 90)) + " FROM od")
def _(spark, sf):
    return W.augment_slidify(P.order_days(spark, sf), "y", [7, 14, 30, 90]).select("id", "ts", *[r(F.col(f"y_roll_{p}") / 7, 4, f"y_roll_{p}") for p in (7, 14, 30, 90)])


@query("lags_leads_grouped", f"WITH {P.ORDER_DAYS} SELECT id, ts, " + ", ".join(
    f"{'lag' if l > 0 else 'lead'}({c}, {abs(l)}) OVER w AS {c}_{'lag' if l > 0 else 'lead'}{abs(l)}" for c in ("n",) for l in (1, 7, 14, 30, 365, -7)) +
    " FROM od WINDOW w AS (PARTITION BY id ORDER BY ts)")
def _(spark, sf):
    d = W.augment_lags(P.order_days(spark, sf), ["n"], [1, 7, 14, 30, 365, -7])
    return d.drop("k", "n", "y")


@query("differences", f"WITH {P.ORDER_DAYS} SELECT id, ts, round(y - lag(y) OVER w, 4) AS d1, round(y - lag(y, 7) OVER w, 4) AS d7, round(y - 2 * lag(y) OVER w + lag(y, 2) OVER w, 4) AS d11 FROM od WINDOW w AS (PARTITION BY id ORDER BY ts)")
def _(spark, sf):
    d = W.augment(P.order_days(spark, sf), d1=W.diff("y"), d7=W.diff("y", 7), d11=W.diff("y", 1, 2))
    return d.select("id", "ts", r("d1"), r("d7"), r("d11"))


@query("weighted_tail_mean", f"WITH {P.ORDER_DAYS} SELECT id, ts, round(0.6 * y + 0.3 * lag(y) OVER w + 0.1 * lag(y, 2) OVER w, 4) AS wm FROM od WINDOW w AS (PARTITION BY id ORDER BY ts)")
def _(spark, sf):
    return W.augment(P.order_days(spark, sf), wm=W.weighted_tail("y", [.1, .3, .6])).select("id", "ts", r("wm"))


@query("min_rank_models", "SELECT o_orderpriority AS id, c_mktsegment AS model, rank() OVER (PARTITION BY o_orderpriority ORDER BY count(*) DESC) AS rk FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2")
def _(spark, sf):
    d = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    d = d.groupBy(F.col("o_orderpriority").alias("id"), F.col("c_mktsegment").alias("model")).agg(F.count(F.lit(1)).alias("n"))
    return W.min_rank(d, "n", by=["id"], descending=True, name="rk").drop("n")
