"""One feature row per series, and k-means over those rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.core import join_params
from tidewheel.operators.decompose import stl
from tidewheel.operators.diagnostics import acf
from tidewheel.operators.spectrum import spectral_entropy
from tidewheel.operators.transforms import standardize_vec
from tidewheel.operators.windows import augment, diff
from tidewheel.session import cut_lineage, side_by_side


def _acf_features(d: DataFrame, y: str, name: str, also: int | None = None) -> DataFrame:
    """First autocorrelation and sum of the first ten squared; ``also`` adds that of one more lag as ``seas_acf1``."""
    a = acf(d.select("id", "k", y), y, max(10, also or 0))
    more = [] if also is None else [F.max(F.when(F.col("lag") == also, F.col("acf"))).alias("seas_acf1")]
    return a.groupBy("id").agg(F.max(F.when(F.col("lag") == 1, F.col("acf"))).alias(f"{name}_acf1"),
                               F.sum(F.when(F.col("lag").between(1, 10), F.col("acf") * F.col("acf"))).alias(f"{name}_acf10"), *more)


def ts_features(df: DataFrame, y: str = "y", period: int = 7, *, scale: bool = True, prefix: str = "ts_",
                custom: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """One row per id: frequency and number of seasons, strengths of trend and season, spike, linearity and curvature (coefficients of
    the trend on orthonormal polynomials of time), peak and trough phase (1 is the phase of ``k % period == 0``), autocorrelations of the series, its
    first and second differences and the remainder, spectral entropy, user aggregates.

    NULL where a feature is undefined (constant or too short series).  Rows must be one per grid cell.
    """
    d = df.select("id", "k", "ts", F.col(y).cast("double").alias("y"))
    if scale:
        d = standardize_vec(d, "y", "_z").withColumn("y", F.col("_z")).drop("_z")
    d = stl(d, "y", period).withColumn("detrended", F.col("y") - F.col("trend"))
    d = cut_lineage(augment(d, diff1=diff("y"), diff2=diff("y", 1, 2)))
    base = d.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.min("k").alias("_k0"), F.var_pop("remainder").alias("_vr"), F.var_pop("seasadj").alias("_vs"),
        F.var_pop("detrended").alias("_vd"), F.avg("remainder").alias("_mr"), *[f(F.col("y")).alias(n) for n, f in (custom or {}).items()],
        (1 - F.max(F.struct("season", (-F.pmod("k", F.lit(period))).alias("p")))["p"]).alias("peak"),
        (F.min(F.struct("season", F.pmod("k", F.lit(period)).alias("p")))["p"] + 1).alias("trough"))
    ratio = lambda a, b: F.greatest(F.lit(0.0), 1 - F.col(a) / F.nullif(F.col(b), F.lit(0.0)))
    one = base.select("id", "n", "_k0", "_vr", "_mr", *(custom or {}), F.lit(period).alias("frequency"), F.lit(int(period > 1)).alias("nperiods"),
                      ratio("_vr", "_vs").alias("trend"), ratio("_vr", "_vd").alias("seasonal_strength"), "peak", "trough")
    j = join_params(d.select("id", "k", "remainder", F.col("trend").alias("_t")), one.select("id", "n", "_k0", "_vr", "_mr"), ["id"])
    # Variance of the leave-one-out variances of the remainder.
    e2 = F.pow(F.col("remainder") - F.col("_mr"), F.lit(2))
    loo = F.try_divide(F.col("n") * F.col("_vr") - F.try_divide(e2 * F.col("n"), F.col("n") - 1), F.col("n") - 2)
    # Orthonormal polynomials of the cell number have closed forms on a full grid.
    n = F.col("n").cast("double")
    c = F.col("k") - F.col("_k0") - (n - 1) / 2
    line = F.try_divide(F.sum(F.col("_t") * c), F.sqrt(F.max(n * (n * n - 1) / 12)))
    bend = F.try_divide(F.sum(F.col("_t") * (c * c - (n * n - 1) / 12)), F.sqrt(F.greatest(F.max(n * (n * n - 1) * (n * n - 4) / 180), F.lit(0.0))))
    shape = j.groupBy("id").agg(F.var_samp(loo).alias("spike"), line.alias("linearity"), bend.alias("curvature"))
    out = one.drop("_k0", "_vr", "_mr").join(shape, "id")
    for col, name in (("y", "x"), ("diff1", "diff1"), ("diff2", "diff2"), ("remainder", "e")):
        out = out.join(_acf_features(d, col, name, period if name == "x" else None), "id", "left")
    out = out.join(spectral_entropy(d).select("id", "entropy"), "id", "left")
    return out.withColumnsRenamed({c: prefix + c for c in out.columns if c != "id"})


def cluster(features: DataFrame, cols: Sequence[str], k: int = 3, n_start: int = 100, seed: int = 123, workers: int = 4) -> DataFrame:
    """k-means on scaled feature rows; the cheapest of ``n_start`` seeds wins (``workers`` fits run side by side).

    Series with a NULL or NaN feature take no part in the fit and come back with a NULL ``cluster``.
    """
    rows = cut_lineage(features)
    v = VectorAssembler(inputCols=list(cols), outputCol="_raw").transform(rows.dropna(subset=list(cols)))
    v = cut_lineage(StandardScaler(inputCol="_raw", outputCol="_v", withMean=True).fit(v).transform(v))
    v = v.persist()  # one small row per series, read by every start
    fits = [lambda i=i: KMeans(featuresCol="_v", predictionCol="cluster", k=k, seed=seed + i).fit(v) for i in range(n_start)]
    best = min(side_by_side(v.sparkSession, fits, workers), key=lambda m: m.summary.trainingCost)
    v.unpersist()
    found = best.transform(v).drop("_raw", "_v")
    lost = rows.where(reduce(lambda a, c: a | c, [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in cols]))
    return found.unionByName(lost.withColumn("cluster", F.lit(None).cast("int")))
