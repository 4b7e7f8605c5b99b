"""Anomaly detectors on padded panels ``id, k, ts, y`` and their vote.

Every detector returns the flagged rows ``id, k`` only: votes travel as a few rows, not as copies
of the panel.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.core import CHUNK, chunk_of, exact_quantiles, halo_select, join_params, running, value_bins, with_halo
from tidewheel.operators import decompose as DC
from tidewheel.session import cut_lineage


def training_length(n: Column, share: float = 0.15, most: int = 750) -> Column:
    return F.least(F.floor(n * share), F.lit(most))


def seasonal_remainder(df: DataFrame, period: int = 7) -> DataFrame:
    return DC.outlier_flags(df, "y", period).where("outlier = 1").select("id", "k")


def _normal_quantile(p_upper: Column) -> Column:
    """Upper-tail normal quantile by a rational approximation (error below 5e-4)."""
    t = F.sqrt(-2 * F.log(p_upper))
    # Fixed values of the published approximation.
    return t - (2.515517 + 0.802853 * t + 0.010328 * t * t) / (1 + 1.432788 * t + 0.189269 * t * t + 0.001308 * t * t * t)


def _t_quantile(p_upper: Column, v: Column) -> Column:
    z = _normal_quantile(p_upper)
    z3, z5 = z * z * z, z * z * z * z * z
    return z + (z3 + z) / (4 * v) + (5 * z5 + 16 * z3 + 3 * z) / (96 * v * v)


def gesd(df: DataFrame, x: str, alpha: float = 0.05, max_anomalies: float = 0.2) -> DataFrame:
    """Generalised extreme studentised deviate test per id on column ``x``.

    Values leave in order of their distance from the mean; mean and sd of the rest come from running
    sums over bins of that distance.  Only the farthest ``max_anomalies`` share (found by a sketch) is ranked.
    """
    s = df.groupBy("id").agg(F.count(x).alias("_n"), F.avg(x).alias("_m"))
    d = join_params(df.select("id", "k", x), s, ["id"]).withColumn("_c", F.col(x) - F.col("_m"))
    tot = d.groupBy("id").agg(F.sum(F.col("_c") * F.col("_c")).alias("_ss"),
                              F.percentile_approx(F.abs("_c"), max(0.0, 1 - max_anomalies - 0.01), 10000).alias("_cut"))
    far = join_params(d, tot, ["id"]).where(F.abs("_c") >= F.col("_cut"))
    far = cut_lineage(far.withColumn("_d", -F.abs("_c")))
    r = (running(far, "_d", rank="_i", sums={"_gone": F.col("_c"), "_gone2": F.col("_c") * F.col("_c")})
         .where(F.col("_i") <= F.floor(F.col("_n") * max_anomalies)))
    left = (F.col("_n") - F.col("_i") + 1).cast("double")
    mean = -F.col("_gone") / left
    var = F.try_divide(F.col("_ss") - F.col("_gone2") - left * mean * mean, left - 1)
    stat = F.try_divide(F.abs(F.col("_c") - mean), F.sqrt(F.greatest(var, F.lit(0.0))))
    t = _t_quantile(alpha / (2 * left), F.greatest(left - 2, F.lit(1.0)))
    crit = F.try_divide((left - 1) * t, F.sqrt((left - 2 + t * t) * left))
    r = r.withColumn("_over", F.coalesce((left > 2) & (var > 0) & (stat > crit), F.lit(False)))
    last = r.groupBy("id").agg(F.max(F.when(F.col("_over"), F.col("_i"))).alias("_last"))
    return r.join(last, "id").where(F.col("_i") <= F.col("_last")).select("id", "k")


def decompose_gesd(df: DataFrame, period: int = 7, alpha: float = 0.05) -> DataFrame:
    d = cut_lineage(DC.stl(df, "y", period, trend="median", trend_period=4 * period + 1).select("id", "k", "remainder"))
    return gesd(d, "remainder", alpha)


class Ewma:
    """Online state of the three control charts for one key; used by batch and stream alike."""

    def __init__(self, mean: float, var: float, n_train: int, state: Sequence[float] | None = None):
        # n, pewma s1, s2, ewma z, error variance, then the last values of the second stage
        self.n_train = n_train
        self.s = list(state) if state is not None else [0, mean, var + mean * mean, mean, var]

    def update(self, x: float, alpha: float = 0.95, beta: float = 0.5, lam: float = 0.2, theta: float = 0.05,
               limit: float = 3.0, m: int = 5) -> tuple[int, int, int]:
        n, s1, s2, z, v = self.s[:5]
        recent = self.s[5:]
        ready = n >= self.n_train
        sd = math.sqrt(max(s2 - s1 * s1, 1e-12))
        dist = (x - s1) / sd
        p = math.exp(-0.5 * min(dist * dist, 700.0)) / math.sqrt(2 * math.pi)
        a = alpha * (1 - beta * p)
        f1 = ready and abs(dist) > limit
        err = x - z
        f2 = ready and abs(err) > limit * math.sqrt(max(v, 1e-12))
        # Second stage: the point must also stand apart from the last m values.
        f3 = False
        if f2 and len(recent) == m:
            mu = sum(recent) / m
            spread = math.sqrt(sum((r - mu) ** 2 for r in recent) / (m - 1))
            f3 = abs(x - mu) > limit * spread
        self.s = [n + 1, a * s1 + (1 - a) * x, a * s2 + (1 - a) * x * x, z + lam * err,
                  theta * err * err + (1 - theta) * v, *(recent + [x])[-m:]]
        return int(f1), int(f2), int(f3)


def _scan(keep: float, add: np.ndarray, start: float, block: int = 64) -> np.ndarray:
    """``s[t] = keep * s[t - 1] + add[t]`` with ``start`` before the first: blocks by matrix, then a chain of block ends."""
    i = np.arange(block)
    lower = np.where(i[:, None] >= i, keep ** np.maximum(i[:, None] - i, 0.0), 0.0)
    local = np.concatenate([add, np.zeros(-len(add) % block)]).reshape(-1, block) @ lower.T
    starts, s = np.empty(len(local)), start
    for b, end in enumerate(local[:, -1]):
        starts[b], s = s, keep ** block * s + end
    return (local + starts[:, None] * keep ** (i + 1.0)).ravel()[:len(add)]


def _training(df: DataFrame, n_train: int | None = None) -> DataFrame:
    """``id, _nt, _mean, _var``: length, mean and variance of each id's training prefix (by share, or the first ``n_train`` cells)."""
    length = training_length(F.count("y")) if n_train is None else F.lit(n_train).cast("bigint")
    b = df.groupBy("id").agg(F.min("k").alias("_k0"), length.alias("_nt"))
    known = join_params(df.where("y IS NOT NULL").select("id", "k", F.col("y").cast("double").alias("y")), b, ["id"])
    first = known.where(F.col("k") - F.col("_k0") < F.col("_nt")).groupBy("id").agg(F.avg("y").alias("_mean"), F.var_pop("y").alias("_var"))
    return b.join(first, "id", "left").select("id", "_nt", F.coalesce("_mean", F.lit(0.0)).alias("_mean"), F.coalesce("_var", F.lit(0.0)).alias("_var"))


def sd_ewma_charts(df: DataFrame, n_train: int | None = None, *, lam: float = 0.2, theta: float = 0.05, limit: float = 3.0, m: int = 5, size: int = CHUNK) -> DataFrame:
    """``id, k, sd_ewma, two_stage`` (0/1) for every known row; a key of any length is many tasks' work.

    The mean z moves by an affine map along a chunk of rows, and the error variance by a map that is affine in itself and quadratic in
    the z that enters: a few numbers say what a whole chunk does to the state.  Chunks are summed up in parallel, chained
    per key over those numbers alone, and then replayed from their entry states for the flags.
    """
    key = df.schema["id"].dataType.simpleString()
    d = cut_lineage(df.where("y IS NOT NULL").select("id", "k", F.col("y").cast("double").alias("y"), chunk_of("k", size).alias("_chunk")))

    def sum_up(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("k")["y"].to_numpy()
        n = len(x)
        z = _scan(1 - lam, lam * x, 0.0)
        e, a = x - np.append(0.0, z[:-1]), (1 - lam) ** np.arange(n, dtype=float)
        w = theta * (1 - theta) ** np.arange(n - 1, -1, -1, dtype=float)
        return pd.DataFrame([(pdf["id"].iloc[0], pdf["_chunk"].iloc[0], n, (1 - lam) ** n, z[-1], (1 - theta) ** n, w @ (e * e), -2 * w @ (e * a), w @ (a * a), x[-m:])],
                            columns=["id", "_chunk", "n", "za", "zb", "vg", "c0", "c1", "c2", "tail"])

    maps = d.groupBy("id", "_chunk").applyInPandas(
        sum_up, f"id {key}, _chunk bigint, n bigint, za double, zb double, vg double, c0 double, c1 double, c2 double, tail array<double>")

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk")
        id_, nt, z, v = (pdf[c].iloc[0] for c in ("id", "_nt", "_mean", "_var"))
        n, tail, out = 0, [], []
        for chunk, rows, za, zb, vg, c0, c1, c2, ends in zip(*(pdf[c] for c in ("_chunk", "n", "za", "zb", "vg", "c0", "c1", "c2", "tail"))):
            out.append((id_, chunk, n, z, v, tail, nt))
            z, v = za * z + zb, vg * v + c0 + c1 * z + c2 * z * z
            n, tail = n + rows, [*tail, *ends][-m:]
        return pd.DataFrame(out, columns=["id", "_chunk", "n", "z", "v", "tail", "nt"])

    entry = join_params(maps, _training(df, n_train), ["id"]).groupBy("id").applyInPandas(
        chain, f"id {key}, _chunk bigint, n bigint, z double, v double, tail array<double>, nt bigint")

    def replay(rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        x, s = rows["y"].to_numpy(), start.iloc[0]
        err = x - np.append(s["z"], _scan(1 - lam, lam * x, s["z"])[:-1])
        var = np.append(s["v"], _scan(1 - theta, theta * err * err, s["v"])[:-1])
        over = (s["n"] + np.arange(len(x)) >= s["nt"]) & (np.abs(err) > limit * np.sqrt(np.maximum(var, 1e-12)))
        # Second stage: the point must also stand apart from the m values before it.
        stage, past = np.zeros(len(x), bool), np.concatenate([np.asarray(s["tail"], float), x])
        shift = len(past) - len(x)
        for i in np.flatnonzero(over):
            if i + shift >= m:
                near = past[i + shift - m:i + shift]
                stage[i] = abs(x[i] - near.mean()) > limit * near.std(ddof=1)
        return pd.DataFrame({"id": rows["id"], "k": rows["k"], "sd_ewma": over.astype("int32"), "two_stage": stage.astype("int32")})

    return d.groupBy("id", "_chunk").cogroup(cut_lineage(entry).groupBy("id", "_chunk")).applyInPandas(replay, f"id {key}, k bigint, sd_ewma int, two_stage int")


def pewma_chart(df: DataFrame, n_train: int | None = None) -> DataFrame:
    """``id, k, pewma`` (0/1) for every known row.

    The weight of a value depends on its own likelihood, so this recursion alone is sequential.  Rows stream through sorted by
    (id, k) in Arrow batches and only a handful of numbers per key is carried, so no series is ever held in memory.
    """
    d = join_params(df.where("y IS NOT NULL").select("id", "k", F.col("y").cast("double").alias("y")), _training(df, n_train), ["id"])
    d = d.repartition("id").sortWithinPartitions("id", "k")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, chart = object(), None
        for pdf in batches:
            flags = []
            for i, x, nt, mean, var in zip(pdf["id"], pdf["y"], pdf["_nt"], pdf["_mean"], pdf["_var"]):
                if i != key:
                    key, chart = i, Ewma(mean, var, nt)
                flags.append(chart.update(x)[0])
            yield pd.DataFrame({"id": pdf["id"], "k": pdf["k"], "pewma": np.array(flags, "int32")})

    return d.mapInPandas(run, f"id {df.schema['id'].dataType.simpleString()}, k bigint, pewma int")


def ewma_charts(df: DataFrame, n_train: int | None = None) -> DataFrame:
    """``id, k, pewma, sd_ewma, two_stage`` (0/1) for every known row; trained on a share of the series or its first ``n_train`` cells."""
    return pewma_chart(df, n_train).join(sd_ewma_charts(df, n_train), ["id", "k"])


def knn_conformal(df: DataFrame, threshold: float = 0.95, dim: int = 5, train: int = 750, share: float = 0.1,
                  size: int = 4096) -> DataFrame:
    """Conformal kNN on lag vectors: each point against the vectors of the training length before it.

    A point's score is the mean distance to its k nearest earlier vectors (k a ``share`` of the id's known values, at most what there
    is); it is flagged if at least ``threshold`` of the scores before it are lower.  The distances to all vectors d cells
    back are one moving sum along a diagonal, and the rank of a score is counted diagonal by diagonal as well, so the work is a few
    array operations per diagonal.  A NULL is no value: vectors that hold one have neither distance nor score.  Chunks with a halo of the
    reference window, so an id of any length is many tasks' work.
    """
    b = df.groupBy("id").agg(F.count("y").alias("_n"), F.min("k").alias("_k0"))
    d = join_params(df.where("y IS NOT NULL").select("id", "k", F.col("y").cast("double").alias("y")), b, ["id"])
    h = with_halo(d, 2 * train + dim, size=size)
    h = h.withColumn("_kk", F.greatest(F.floor(F.col("_n") * share), F.lit(1))).withColumn("_nt", F.greatest(training_length(F.col("_n"), most=train), F.lit(2)))

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        at = pdf["k"].to_numpy()
        first, kk, nt, k0 = int(at.min()), int(pdf["_kk"].iloc[0]), int(pdf["_nt"].iloc[0]), int(pdf["_k0"].iloc[0])
        n = int(at.max()) - first + 1
        x, own = np.full(n, np.nan), np.zeros(n, bool)
        x[at - first], own[at - first] = pdf["y"].to_numpy(), pdf["_own"].to_numpy()
        dist = np.full((min(nt, max(n - dim, 0)), n), np.inf)
        for d in range(1, len(dist) + 1):
            dist[d - 1, d + dim - 1:] = np.convolve((x[d:] - x[:-d]) ** 2, np.ones(dim), "valid")
        if not len(dist):
            return pd.DataFrame({"id": pdf["id"][:0], "k": at[:0]})
        dist = np.sqrt(np.where(np.isnan(dist), np.inf, np.maximum(dist, 0)))
        if kk < len(dist):
            dist = np.partition(dist, kk - 1, axis=0)[:kk]
        good = np.isfinite(dist)
        near = good.sum(0)
        s = np.where(near > 0, np.where(good, dist, 0).sum(0) / np.maximum(near, 1), np.nan)
        lower, seen = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for d in range(1, min(nt, n - 1) + 1):
            lower[d:] += s[:-d] < s[d:]
            seen[d:] += np.isfinite(s[:-d])
        flag = own & (np.arange(n) + first - k0 >= nt + dim) & np.isfinite(s) & (seen > 0) & (lower >= threshold * seen)
        return pd.DataFrame({"id": np.full(int(flag.sum()), pdf["id"].iloc[0], object), "k": np.flatnonzero(flag) + first})

    return h.groupBy("id", "_chunk").applyInPandas(score, f"id {df.schema['id'].dataType.simpleString()}, k bigint")


def point_cost(df: DataFrame, prefix_only: bool = False, penalty: float = 3.0) -> DataFrame:
    """Points whose cost saving ``z^2 - 1 - ln z^2`` beats ``penalty * ln n`` (median/MAD scale).

    ``prefix_only`` learns the scale on the training prefix, as the sequential form does.
    """
    n = df.groupBy("id").agg(F.count("y").alias("_n"), F.min("k").alias("_k0"))
    d = join_params(df.select("id", "k", F.col("y").cast("double").alias("y")), n, ["id"])
    learn = d.where(F.col("k") - F.col("_k0") < F.greatest(training_length(F.col("_n")), F.lit(10))) if prefix_only else d
    med = exact_quantiles(learn, "y", {"_med": .5}, keys=["id"])
    mad = exact_quantiles(join_params(learn, med, ["id"]).withColumn("_a", F.abs(F.col("y") - F.col("_med"))), "_a",
                          {"_mad": .5}, keys=["id"])
    z2 = F.pow(F.try_divide(F.col("y") - F.col("_med"), 1.4826 * F.col("_mad")), F.lit(2))
    j = join_params(join_params(d, med, ["id"]), mad, ["id"]).where("_mad > 0").withColumn("_z2", z2)
    return j.where((F.col("_z2") > 1) & (F.col("_z2") - 1 - F.log("_z2") > penalty * F.log("_n"))).select("id", "k")


def knn_distance(df: DataFrame, k: int | None = None, share: float = 0.1, rows: int = CHUNK) -> DataFrame:
    """``id, k, y, _d``: distance of each known value to its k-th nearest other value of the same id.

    ``k`` is ``share`` of the id's known values (at least one) unless given.  In order of value, the k nearest of a point and
    itself are k + 1 neighbours: those from rank r to r + k, where the point's value splits the midpoints (y[r] + y[r + k]) / 2.  So one
    join by rank makes the midpoints, and one merge of points and midpoints gives the best range on either side; the work
    does not grow with k, and no task holds an id.  Ids with a single value have no distance and are left out.
    """
    d = cut_lineage(running(cut_lineage(df.where("y IS NOT NULL").select("id", "k", F.col("y").cast("double").alias("y"))), "y", rank="_r", rows=rows))
    n = d.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    kk = F.least(F.greatest(F.floor(F.col("_n") * share), F.lit(1)) if k is None else F.lit(k), F.col("_n") - 1).cast("bigint")
    n = n.where("_n > 1").select("id", kk.alias("_kk"))
    high = join_params(d.select("id", "_r", F.col("y").alias("_hi")), n).select("id", (F.col("_r") - F.col("_kk")).alias("_r"), "_hi").where("_r > 0")
    mids = d.select("id", "_r", F.col("y").alias("_lo")).join(high, ["id", "_r"]).select(
        "id", F.col("_r").alias("k"), ((F.col("_lo") + F.col("_hi")) / 2).alias("_v"), F.lit(1).alias("_kind"), "_lo", "_hi")
    none = F.lit(None).cast("double")
    points = d.join(n, "id", "left_semi").select("id", "k", F.col("y").alias("_v"), F.lit(0).alias("_kind"), none.alias("_lo"), none.alias("_hi"))
    # At equal values points come before midpoints.
    both = value_bins(cut_lineage(points.unionByName(mids)), "_v", sub=F.col("_kind") * F.lit(1 << 40) + chunk_of("k"), rows=rows)
    per = both.groupBy("id", "_bin", "_sub").agg(F.max("_lo").alias("_lo0"), F.min("_hi").alias("_hi0"))
    up, down = (Window.partitionBy("id").orderBy(*o).rowsBetween(Window.unboundedPreceding, -1) for o in (("_bin", "_sub"), (F.desc("_bin"), F.desc("_sub"))))
    per = per.select("id", "_bin", "_sub", F.max("_lo0").over(up).alias("_lo0"), F.min("_hi0").over(down).alias("_hi0"))
    inner, order = Window.partitionBy("id", "_bin", "_sub"), ("_v", "_kind", "k")
    back, ahead = (inner.orderBy(*o).rowsBetween(Window.unboundedPreceding, -1) for o in (order, [F.desc(c) for c in order]))
    lo, hi = F.greatest(F.max("_lo").over(back), F.col("_lo0")), F.least(F.min("_hi").over(ahead), F.col("_hi0"))
    near = F.greatest(F.least(F.col("_v") - lo, hi - F.col("_v")), F.lit(0.0))
    return both.join(per, ["id", "_bin", "_sub"]).withColumn("_d", near).where("_kind = 0").select("id", "k", F.col("_v").alias("y"), "_d")


def knn_gap(df: DataFrame, k: int | None = None, alpha: float = 0.05, look: int = 25, share: float = 0.1) -> DataFrame:
    """Distance to the k-th nearest value (k a ``share`` of the values); the first gap in the upper half of the sorted
    distances that is ``ln(1/alpha)`` times the mean of the ``look`` gaps before it starts the outliers."""
    d = cut_lineage(knn_distance(df, k, share))
    d = cut_lineage(running(d.select("id", "k", "_d"), "_d", rank="_r"))
    d = halo_select(d, lambda w: {"_gap": F.col("_d") - F.lag("_d").over(w)}, 1, pos="_r")
    d = halo_select(d, lambda w: {"_mean": F.avg("_gap").over(w.rowsBetween(-look, -1))}, look, pos="_r")
    n = d.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    big = (F.col("_r") > F.col("_n") / 2) & (F.col("_gap") > math.log(1 / alpha) * F.col("_mean")) & (F.col("_mean") > 0)
    bound = join_params(d, n, ["id"]).where(big).groupBy("id").agg(F.min("_r").alias("_b"))
    return d.join(bound, "id").where(F.col("_r") >= F.col("_b")).select("id", "k")


# The groups of detectors by name and the columns they vote with.
GROUPS = {"forecast": ("forecast",), "anomalize": ("anomalize",), "otsad": ("otsad_cpp", "otsad_cpsd", "otsad_cpts"), "otsad_knn": ("otsad_knn",),
          "anomaly": ("anomaly_capa", "anomaly_scapa"), "stray": ("stray",)}
DEFAULT = ("forecast", "anomalize", "stray", "otsad", "anomaly")


def detect(df: DataFrame, methods: Sequence[str] = DEFAULT, ranking: Sequence[str] | None = None,
           period: int = 7) -> DataFrame:
    """``id, ts, value, score, score_w`` and one 0/1 column per detector.

    ``score`` is the mean vote; ``score_w`` weights the columns in order of ``ranking`` with
    ``m, m-1, .. 1`` over their sum.  Unknown method names and an empty choice are refused.
    """
    unknown = [m for m in methods if m not in GROUPS]
    if unknown or not methods:
        raise ValueError(f"choose methods from {sorted(GROUPS)}: {unknown or 'none given'}")
    d = cut_lineage(df.select("id", "k", "ts", F.col("y").cast("double").alias("y")))
    found: dict[str, DataFrame] = {}
    if "forecast" in methods:
        found["forecast"] = seasonal_remainder(d, period)
    if "anomalize" in methods:
        found["anomalize"] = decompose_gesd(d, period)
    if "otsad" in methods:
        found["otsad_cpp"] = pewma_chart(d).where("pewma = 1").select("id", "k")
        charts = cut_lineage(sd_ewma_charts(d).where("sd_ewma = 1"))
        for name, c in (("otsad_cpsd", "sd_ewma"), ("otsad_cpts", "two_stage")):
            found[name] = charts.where(F.col(c) == 1).select("id", "k")
    if "otsad_knn" in methods:
        found["otsad_knn"] = knn_conformal(d)
    if "anomaly" in methods:
        found["anomaly_capa"], found["anomaly_scapa"] = point_cost(d), point_cost(d, prefix_only=True)
    if "stray" in methods:
        found["stray"] = knn_gap(d)
    votes = None
    for name, f in found.items():
        f = f.select("id", "k", F.lit(name).alias("method"))
        votes = f if votes is None else votes.unionByName(f)
    wide = cut_lineage(votes).groupBy("id", "k").agg(
        *[F.max(F.when(F.col("method") == n, 1).otherwise(0)).alias(n) for n in found])
    out = d.join(wide, ["id", "k"], "left").withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in found})
    return score_votes(out, list(found), ranking or methods).select(
        "id", "ts", F.col("y").alias("value"), "score", "score_w", *found)


def score_votes(df: DataFrame, names: Sequence[str], ranking: Sequence[str]) -> DataFrame:
    ordered = [n for r in ranking for n in names if n.startswith(r)]
    ordered = list(dict.fromkeys(ordered + list(names)))
    m = len(ordered)
    total, weighted = F.lit(0.0), F.lit(0.0)
    for i, n in enumerate(ordered):
        total = total + F.col(n)
        weighted = weighted + F.col(n) * (m - i)
    return df.withColumn("score", total / m).withColumn("score_w", weighted / (m * (m + 1) / 2))
