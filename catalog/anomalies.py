"""Queries for anomaly detection, series features and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog import panels as P
from catalog.features import _BASE, _LIM, STL
from catalog.panels import r
from tidewheel.operators import anomaly as AN
from tidewheel.operators.spectrum import spectral_entropy
from tidewheel.operators.tsfeatures import cluster, ts_features


def _orders(spark, sf):
    return P.order_days(spark, sf).drop("n")


@query("anomaly_seasonal_remainder", f"{_BASE}{_LIM} SELECT stl.id, stl.ts FROM stl JOIN lim USING (id) WHERE NOT remainder BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1)")
def _(spark, sf):
    d = _orders(spark, sf)
    return AN.seasonal_remainder(d).join(d, ["id", "k"]).select("id", "ts")


_GESD = (f"WITH {P.ORDER_DAYS}, c AS (SELECT id, ts, k, n - avg(n) OVER (PARTITION BY id) AS c, count(*) OVER (PARTITION BY id) AS n FROM od), "
         "t AS (SELECT *, sum(c * c) OVER (PARTITION BY id) AS ss, row_number() OVER (PARTITION BY id ORDER BY abs(c) DESC, k) AS i FROM c), "
         "g AS (SELECT *, coalesce(sum(c) OVER w, 0) AS gone, coalesce(sum(c * c) OVER w, 0) AS gone2, CAST(n - i + 1 AS DOUBLE) AS lft FROM t WHERE i <= floor(n * 0.2) WINDOW w AS (PARTITION BY id ORDER BY abs(c) DESC, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), "
         "v AS (SELECT *, -gone / lft AS mu, (ss - gone2 - gone * gone / lft) / (lft - 1) AS var, sqrt(-2 * ln(0.05 / (2 * lft))) AS q FROM g), "
         "z AS (SELECT *, q - (2.515517 + 0.802853 * q + 0.010328 * q * q) / (1 + 1.432788 * q + 0.189269 * q * q + 0.001308 * q * q * q) AS z, lft - 2 AS df FROM v), "
         "s AS (SELECT *, z + (z * z * z + z) / (4 * df) + (5 * pow(z, 5) + 16 * pow(z, 3) + 3 * z) / (96 * df * df) AS tq FROM z), "
         "o AS (SELECT *, var > 0 AND abs(c - mu) / sqrt(var) > (lft - 1) * tq / sqrt((lft - 2 + tq * tq) * lft) AS over FROM s), "
         "l AS (SELECT id, max(CASE WHEN over THEN i END) AS last FROM o GROUP BY 1) SELECT o.id, o.ts FROM o JOIN l USING (id) WHERE i <= last")


@query("anomaly_gesd_counts", _GESD)
def _(spark, sf):
    d = P.order_days(spark, sf).withColumn("x", F.col("n").cast("double"))
    return AN.gesd(d, "x").join(d, ["id", "k"]).select("id", "ts")


@query("anomaly_decompose_gesd")
def _(spark, sf):
    return AN.decompose_gesd(_orders(spark, sf)).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query("anomaly_sd_ewma", f"WITH RECURSIVE {P.EVENT_HOURS}, b AS (SELECT id, ts, y, row_number() OVER (PARTITION BY id ORDER BY k) AS i, least(floor(count(*) OVER (PARTITION BY id) * 0.15), 750) AS nt FROM eh), "
       "f AS (SELECT id, avg(y) AS mean, var_pop(y) AS var FROM b WHERE i <= nt GROUP BY 1), "
       "rr AS (SELECT id, CAST(0 AS BIGINT) AS i, CAST(NULL AS TIMESTAMP) AS ts, mean AS z, var AS v, 0 AS flag FROM f UNION ALL "
       "SELECT rr.id, b.i, b.ts, z + 0.2 * (y - z), 0.05 * (y - z) * (y - z) + 0.95 * v, CASE WHEN b.i - 1 >= nt AND abs(y - z) > 3 * sqrt(greatest(v, 1e-12)) THEN 1 ELSE 0 END FROM rr JOIN b ON b.id = rr.id AND b.i = rr.i + 1) "
       "SELECT id, ts FROM rr WHERE flag = 1")
def _(spark, sf):
    d = P.event_hours(spark, sf)
    return AN.sd_ewma_charts(d).where("sd_ewma = 1").join(d, ["id", "k"]).select("id", "ts")


def charts_sql(base, train="least(floor(count(*) OVER (PARTITION BY id) * 0.15), 750)"):
    """The three charts over CTE ``eh`` (id, ts, k, y): each step, the state before (s1, s2, z, v) meets the next value."""
    return (f"WITH RECURSIVE {base}, b AS (SELECT id, ts, y, row_number() OVER w AS i, {train} AS nt, "
            "count(y) OVER p AS c5, avg(y) OVER p AS m5, stddev_samp(y) OVER p AS s5 FROM eh WINDOW w AS (PARTITION BY id ORDER BY k), p AS (PARTITION BY id ORDER BY k ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)), "
            "f AS (SELECT id, coalesce(avg(y) FILTER (i <= nt), 0) AS mean, coalesce(var_pop(y) FILTER (i <= nt), 0) AS var FROM b GROUP BY 1), "
            "rr AS (SELECT id, CAST(0 AS BIGINT) AS i, CAST(NULL AS TIMESTAMP) AS ts, mean AS s1, var + mean * mean AS s2, mean AS z, var AS v, 0 AS pewma, 0 AS sd_ewma, 0 AS two_stage FROM f UNION ALL "
            "SELECT id, i, ts, a * s1 + (1 - a) * y, a * s2 + (1 - a) * y * y, z + 0.2 * (y - z), 0.05 * (y - z) * (y - z) + 0.95 * v, CASE WHEN ready AND abs(dist) > 3 THEN 1 ELSE 0 END, "
            "CASE WHEN ready AND abs(y - z) > 3 * sqrt(greatest(v, 1e-12)) THEN 1 ELSE 0 END, CASE WHEN ready AND abs(y - z) > 3 * sqrt(greatest(v, 1e-12)) AND c5 = 5 AND abs(y - m5) > 3 * s5 THEN 1 ELSE 0 END "
            "FROM (SELECT *, 0.95 * (1 - 0.5 * exp(-0.5 * least(dist * dist, 700.0)) / sqrt(2 * pi())) AS a FROM (SELECT b.id, b.i, b.ts, y, s1, s2, z, v, c5, m5, s5, b.i - 1 >= nt AS ready, "
            "(y - s1) / sqrt(greatest(s2 - s1 * s1, 1e-12)) AS dist FROM rr JOIN b ON b.id = rr.id AND b.i = rr.i + 1))) ")


_CHARTS = charts_sql(P.EVENT_HOURS)


@query("anomaly_pewma", f"{_CHARTS} SELECT id, sum(pewma) AS pewma, sum(two_stage) AS two_stage FROM rr WHERE i > 0 GROUP BY 1")
def _(spark, sf):
    return AN.ewma_charts(P.event_hours(spark, sf)).groupBy("id").agg(*[F.sum(c).alias(c) for c in ("pewma", "two_stage")])


@query("anomaly_two_stage", f"{_CHARTS} SELECT id, ts FROM rr WHERE two_stage = 1")
def _(spark, sf):
    d = P.event_hours(spark, sf)
    return AN.sd_ewma_charts(d).where("two_stage = 1").join(d, ["id", "k"]).select("id", "ts")


@query("anomaly_knn_conformal")
def _(spark, sf):
    return AN.knn_conformal(P.event_hours(spark, sf)).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query("anomaly_point_cost", f"WITH {P.EVENT_HOURS}, m AS (SELECT id, median(y) AS med, count(*) AS n FROM eh GROUP BY 1), a AS (SELECT eh.*, med, n, abs(y - med) AS a FROM eh JOIN m USING (id)), d AS (SELECT id, median(a) AS mad FROM a GROUP BY 1), "
       "z AS (SELECT a.id, ts, n, pow((y - med) / (1.4826 * mad), 2) AS z2 FROM a JOIN d USING (id) WHERE mad > 0) SELECT id, ts FROM z WHERE z2 > 1 AND z2 - 1 - ln(z2) > 3 * ln(n)")
def _(spark, sf):
    d = P.event_hours(spark, sf)
    return AN.point_cost(d).join(d, ["id", "k"]).select("id", "ts")


# k is a tenth of the values: the best of the ranges of k + 1 neighbours in order of value that hold the point.
_KNN = (f"WITH {P.ORDER_DAYS}, x AS (SELECT id, ts, k, y, row_number() OVER (PARTITION BY id ORDER BY y, k) AS r, count(*) OVER (PARTITION BY id) AS n, "
        "greatest(CAST(floor(count(*) OVER (PARTITION BY id) * 0.1) AS BIGINT), 1) AS kk FROM od), "
        "g AS (SELECT l.id, l.r, l.y AS lo, h.y AS hi FROM x l JOIN x h ON h.id = l.id AND h.r = l.r + l.kk), "
        "d AS (SELECT x.id, x.ts, x.k, x.n, min(greatest(x.y - lo, hi - x.y)) AS d FROM x JOIN g ON g.id = x.id AND g.r BETWEEN x.r - x.kk AND x.r GROUP BY ALL)")


@query("anomaly_knn_distance", f"{_KNN} SELECT id, ts, round(d, 4) AS d FROM d")
def _(spark, sf):
    d = _orders(spark, sf)
    return AN.knn_distance(d).join(d.select("id", "k", "ts"), ["id", "k"]).select("id", "ts", r("_d", 4, "d"))


@query("anomaly_knn_gap", f"{_KNN}, s AS (SELECT *, row_number() OVER w AS r, d - lag(d) OVER w AS gap FROM d WINDOW w AS (PARTITION BY id ORDER BY d, k)), "
       "m AS (SELECT *, avg(gap) OVER (PARTITION BY id ORDER BY r ROWS BETWEEN 25 PRECEDING AND 1 PRECEDING) AS mean FROM s), "
       "b AS (SELECT id, min(r) AS b FROM m WHERE r > n / 2.0 AND mean > 0 AND gap > -ln(0.05) * mean GROUP BY 1) "
       "SELECT m.id, count(CASE WHEN r >= b THEN 1 END) AS n FROM m LEFT JOIN b USING (id) GROUP BY 1")
def _(spark, sf):
    d = _orders(spark, sf)
    f = AN.knn_gap(d).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return d.select("id").distinct().join(f, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))


@query("anomaly_vote")
def _(spark, sf):
    d = AN.detect(_orders(spark, sf), ranking=["anomaly", "forecast"])
    return d.withColumns({c: F.round(c, 6) for c in ("value", "score", "score_w")})


@query("ts_features")
def _(spark, sf):
    f = ts_features(_orders(spark, sf), custom={"my_mean": F.avg})
    whole = ("ts_n", "ts_frequency", "ts_nperiods", "ts_peak", "ts_trough")
    return f.select("id", *[F.col(c) if c in whole else r(c, 5) for c in f.columns if c != "id"])


@query("ts_features_spectrum", f"WITH {P.ORDER_DAYS}, s AS (SELECT id, min(k) AS k0, avg(y) AS mean, CAST(pow(ceil(sqrt(max(k) - min(k) + 1)), 2) AS BIGINT) AS l FROM od GROUP BY 1), "
       "x AS (SELECT id, k - k0 AS t, y - mean AS c, l FROM od JOIN s USING (id)), f AS (SELECT id, unnest(generate_series(1, l // 2)) AS j FROM s), "
       "p AS (SELECT id, j, pow(sum(c * cos(2 * pi() * ((j * t) % l) / l)), 2) + pow(sum(c * sin(2 * pi() * ((j * t) % l) / l)), 2) AS p FROM f JOIN x USING (id) GROUP BY 1, 2), "
       "q AS (SELECT id, p / sum(p) OVER (PARTITION BY id) AS q FROM p) SELECT id, round(-sum(CASE WHEN q > 0 THEN q * ln(q) ELSE 0 END) / ln(count(*)), 6) AS entropy, count(*) AS n_freq FROM q GROUP BY 1")
def _(spark, sf):
    return spectral_entropy(_orders(spark, sf)).select("id", r("entropy", 6), "n_freq")


_SHAPE = (f"WITH {P.ORDER_DAYS}, base AS (SELECT id, ts, k, y / 1e5 AS y FROM od)" + STL +
          ", n AS (SELECT id, count(*) AS n, min(k) AS k0 FROM stl GROUP BY 1), c AS (SELECT stl.*, CAST(n AS DOUBLE) AS n, k - k0 - (n - 1) / 2.0 AS c, remainder - avg(remainder) OVER (PARTITION BY id) AS e, "
          "y - lag(y) OVER w AS d1, y - 2 * lag(y) OVER w + lag(y, 2) OVER w AS d2 FROM stl JOIN n USING (id) WINDOW w AS (PARTITION BY id ORDER BY k)), "
          "z AS (SELECT id, k, e, d1 - avg(d1) OVER (PARTITION BY id) AS d1, d2 - avg(d2) OVER (PARTITION BY id) AS d2 FROM c), "
          "a AS (SELECT a.id, l, sum(a.e * b.e) AS e, sum(a.d1 * b.d1) AS d1, sum(a.d2 * b.d2) AS d2 FROM z a, (SELECT unnest(range(0, 11)) AS l) JOIN z b ON b.id = a.id AND b.k = a.k - l GROUP BY 1, 2), "
          "v AS (SELECT id, l, e / max(CASE WHEN l = 0 THEN e END) OVER p AS e, d1 / max(CASE WHEN l = 0 THEN d1 END) OVER p AS d1, d2 / max(CASE WHEN l = 0 THEN d2 END) OVER p AS d2 FROM a WINDOW p AS (PARTITION BY id)), "
          "w AS (SELECT id, " + ", ".join(f"max(CASE WHEN l = 1 THEN {c} END) AS {n}_acf1, sum(CASE WHEN l > 0 THEN {c} * {c} END) AS {n}_acf10" for c, n in (("e", "e"), ("d1", "diff1"), ("d2", "diff2"))) + " FROM v GROUP BY 1), "
          "t AS (SELECT id, sum(trend * c) / sqrt(max(n * (n * n - 1) / 12)) AS linearity, sum(trend * (c * c - (n * n - 1) / 12)) / sqrt(max(n * (n * n - 1) * (n * n - 4) / 180)) AS curvature FROM c GROUP BY 1), "
          "h AS (SELECT id, arg_max(p, season) + 1 AS peak, arg_min(p, season) + 1 AS trough FROM (SELECT id, CAST(k % 7 AS BIGINT) AS p, max(season) AS season FROM stl GROUP BY 1, 2) GROUP BY 1)")
_SHAPES = ["linearity", "curvature", "e_acf1", "e_acf10", "diff1_acf1", "diff1_acf10", "diff2_acf1", "diff2_acf10"]


@query("ts_features_shape", f"{_SHAPE} SELECT id, peak, trough, " + ", ".join(f"round({c}, 5) AS {c}" for c in _SHAPES) + " FROM w JOIN t USING (id) JOIN h USING (id)")
def _(spark, sf):
    f = ts_features(_orders(spark, sf).withColumn("y", F.col("y") / 1e5), scale=False, prefix="")
    return f.select("id", "peak", "trough", *[r(c, 5) for c in _SHAPES])


@query("cluster_series")
def _(spark, sf):
    f = ts_features(_orders(spark, sf))
    return cluster(f, ["ts_trend", "ts_seasonal_strength", "ts_entropy", "ts_x_acf1"]).select("id", "cluster")
