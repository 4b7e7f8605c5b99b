"""Global learners over all series, boosted residuals, recursion, parameter grids."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PolynomialExpansion, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.core import chunk_of
from tidewheel.forecast import linear as L
from tidewheel.operators.windows import augment
from tidewheel.plans.resample import hash_bucket
from tidewheel.session import cut_lineage


class CompleteRows(Pipeline):
    """Pipeline that learns from the rows without NULL or NaN in ``need`` and transforms every row."""

    def __init__(self, stages, need: Sequence[str]):
        super().__init__(stages=stages)
        self.need = list(need)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        return super()._fit(dataset.dropna(subset=self.need))


def _known(xs: Sequence[str], out: str) -> SQLTransformer:
    """Set the prediction of rows with an incomplete regressor to NULL; no row is lost."""
    ok = " AND ".join(f"`{x}` IS NOT NULL AND NOT isnan(CAST(`{x}` AS DOUBLE))" for x in xs)
    return SQLTransformer(statement=f"SELECT * EXCEPT (`{out}`), CASE WHEN {ok} THEN `{out}` END AS `{out}` FROM __THIS__")


def _pipe(xs: Sequence[str], y: str, *stages, scale: bool = False) -> Pipeline:
    """Assemble ``xs``, optionally scale, then the estimator."""
    out = "_raw" if scale else "features"
    pre = [VectorAssembler(inputCols=list(xs), outputCol=out, handleInvalid="keep")]
    if scale:
        pre.append(StandardScaler(inputCol=out, outputCol="features", withMean=True))
    for s in stages:
        if s.hasParam("labelCol"):
            s.setLabelCol(y)
    return CompleteRows([*pre, *stages, _known(xs, stages[-1].getPredictionCol())], [*xs, y])


def linear(xs, y="y", penalty: float = 0.0, mixture: float = 0.0) -> Pipeline:
    """Plain, ridge (mixture 0), lasso (1) or elastic-net regression."""
    return _pipe(xs, y, LinearRegression(regParam=penalty, elasticNetParam=mixture, maxIter=50))


def forest(xs, y="y", trees: int = 20, depth: int = 6, min_n: int = 25, seed: int = 123, mtry: int | None = None) -> Pipeline:
    """Random forest; ``mtry`` regressors (at most all) are tried at each split, a third of them by default."""
    tried = "auto" if mtry is None else str(max(1, min(mtry, len(xs))))
    return _pipe(xs, y, RandomForestRegressor(numTrees=trees, maxDepth=depth, minInstancesPerNode=min_n, seed=seed, featureSubsetStrategy=tried))


def boosted(xs, y="y", trees: int = 20, depth: int = 4, rate: float = 0.1, seed: int = 123) -> Pipeline:
    return _pipe(xs, y, GBTRegressor(maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed))


def kernel_poly(xs, y="y", degree: int = 2, penalty: float = 0.01) -> Pipeline:
    """Polynomial feature map with a robust (Huber) linear fit; degree 1 is the linear kernel."""
    pre = [VectorAssembler(inputCols=list(xs), outputCol="_raw", handleInvalid="keep"),
           StandardScaler(inputCol="_raw", outputCol="_std", withMean=True)]
    if degree > 1:
        pre.append(PolynomialExpansion(degree=degree, inputCol="_std", outputCol="features"))
    fit = LinearRegression(featuresCol="features" if degree > 1 else "_std", labelCol=y, loss="huber", regParam=penalty, maxIter=50)
    return CompleteRows([*pre, fit, _known(xs, "prediction")], [*xs, y])


def hinge_columns(df: DataFrame, xs: Sequence[str], n_knots: int = 3) -> dict:
    """Hinge pairs at quantiles of each regressor (a bounded sketch: knots need no exactness)."""
    probs = [(i + 1) / (n_knots + 1) for i in range(n_knots)]
    q = df.agg(*[F.percentile_approx(F.col(x).cast("double"), probs, 1000).alias(x) for x in xs]).first()
    cols = {}
    for x in xs:
        for i, v in enumerate(sorted(set(q[x] or []))):
            # ``greatest`` passes over NULL: an unknown regressor must not become a zero.
            cols[f"{x}_up{i}"] = F.when(F.col(x).isNotNull(), F.greatest(F.col(x) - v, F.lit(0.0)))
            cols[f"{x}_dn{i}"] = F.when(F.col(x).isNotNull(), F.greatest(v - F.col(x), F.lit(0.0)))
    return cols


class MapThen:
    """Derived columns in front of a pipeline: fit and transform like one."""

    def __init__(self, columns: Callable[[DataFrame], dict], pipeline: Callable[[list[str]], Pipeline]):
        self.columns, self.pipeline = columns, pipeline

    def fit(self, train: DataFrame):
        cols = self.columns(train)
        model = self.pipeline(list(cols)).fit(train.withColumns(cols))
        return _Fitted(lambda d: model.transform(d.withColumns(cols)).drop(*cols))


class _Fitted:
    def __init__(self, fn):
        self.transform = fn


def hinge_regression(xs, y="y", n_knots: int = 3, penalty: float = 0.05):
    """Hinge basis, lasso picks the terms."""
    return MapThen(lambda d: hinge_columns(d, xs, n_knots), lambda c: linear(c, y, penalty, 1.0))


def kernel_rbf(xs, y="y", n: int = 50, gamma: float = 0.1, penalty: float = 0.01):
    """Random Fourier features of the Gaussian kernel with a robust linear fit."""
    def columns(train):
        one = train.agg(*[f(x).alias(f"{p}_{x}") for x in xs for p, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
        std = {x: (F.col(x) - one[f"m_{x}"]) / (one[f"s_{x}"] or 1.0) for x in xs}
        rng = np.random.default_rng(123)
        w, b = rng.normal(0, math.sqrt(2 * gamma), (n, len(xs))), rng.uniform(0, 2 * math.pi, n)
        return {f"_rbf{i}": math.sqrt(2 / n) * F.cos(
            reduce(lambda a, c: a + c, [std[x] * float(w[i, j]) for j, x in enumerate(xs)]) + float(b[i])) for i in range(n)}
    return MapThen(columns, lambda c: _pipe(c, y, LinearRegression(loss="huber", regParam=penalty, maxIter=50)))


class ModelTree:
    """Regression tree with a linear model per leaf, averaged over committees on hashed subsets."""

    def __init__(self, xs, y="y", committees: int = 2, depth: int = 3, min_n: int = 200, seed: int = 123):
        self.xs, self.y, self.n, self.depth, self.min_n, self.seed = list(xs), y, committees, depth, min_n, seed

    def fit(self, train: DataFrame):
        parts = []
        d0 = train.dropna(subset=[*self.xs, self.y])
        for i in range(self.n):
            d = d0 if self.n == 1 else d0.where(hash_bucket(["id", "k"], self.seed + i, 10) < 8)
            tree = _pipe(self.xs, self.y, DecisionTreeRegressor(maxDepth=self.depth, minInstancesPerNode=self.min_n,
                                                                leafCol="leaf", predictionCol="_tp", seed=self.seed + i)).fit(d)
            leaf = tree.transform(d).select("leaf", self.y, *self.xs)
            coef = cut_lineage(L.fit(leaf, self.y, self.xs, keys=("leaf",), ridge=1e-3))
            parts.append((tree, coef))
        xs, n = self.xs, self.n

        def transform(df):
            out = df
            for i, (tree, coef) in enumerate(parts):
                out = tree.transform(out).drop("features", "_tp")
                out = L.predict(out, coef, xs, keys=("leaf",), out=f"_c{i}").drop("leaf")
            total = reduce(lambda a, c: a + c, [F.col(f"_c{i}") for i in range(n)])
            return out.withColumn("prediction", total / n).drop(*[f"_c{i}" for i in range(n)])
        return _Fitted(transform)


def knn(train: DataFrame, query: DataFrame, xs: Sequence[str], k: int = 50, power: float = 10.0, y: str = "y",
        keys: Sequence[str] = ("id",), size: int = 1 << 14) -> DataFrame:
    """Weighted mean of the k nearest training rows of the same key (Minkowski distance).

    Each training chunk meets the key's query rows (the horizon) and keeps its k nearest; only
    those candidates travel to the final ranking.  Cannot extrapolate beyond the training values.
    Query rows with a NULL regressor, or of a key without training rows, stay with a NULL prediction.
    """
    t = train.dropna(subset=[*xs, y]).select(*keys, "k", F.array(*[F.col(x).cast("double") for x in xs]).alias("_x"),
                                             F.col(y).cast("double").alias("_y")).withColumn("_chunk", chunk_of("k", size))
    chunks = t.select(*keys, "_chunk").distinct()
    q = query.dropna(subset=list(xs)).select(*keys, F.col("k").alias("_qk"), F.array(*[F.col(x).cast("double") for x in xs]).alias("_qx"))
    q = q.join(chunks, list(keys)).select(*[F.col(c).alias(f"_q_{c}") for c in (*keys, "_chunk")], "_qk", "_qx")
    names = list(keys)
    fields = ", ".join(f"`{c}` {train.schema[c].dataType.simpleString()}" for c in keys)

    def nearest(key, left, right):
        out = []
        if len(left) and len(right):
            x, v = np.vstack(left["_x"].to_numpy()), left["_y"].to_numpy()
            q, qk = np.vstack(right["_qx"].to_numpy()), right["_qk"].to_numpy()
            block = max(1, (1 << 22) // x.size)
            for lo in range(0, len(q), block):
                d = (np.abs(x[None] - q[lo:lo + block, None]) ** power).sum(axis=2) ** (1 / power)
                near = np.argsort(d, axis=1, kind="stable")[:, :k]
                out.append(pd.DataFrame({"_qk": np.repeat(qk[lo:lo + block], near.shape[1]), "d": np.take_along_axis(d, near, 1).ravel(), "v": v[near].ravel()}))
        found = pd.concat(out) if out else pd.DataFrame({"_qk": [], "d": [], "v": []})
        for name, value in zip(names, key):
            found[name] = value
        return found[[*names, "_qk", "d", "v"]]

    cand = t.groupBy(*keys, "_chunk").cogroup(q.groupBy(*[f"_q_{c}" for c in (*keys, "_chunk")])).applyInPandas(
        nearest, f"{fields}, _qk bigint, d double, v double")
    w = Window.partitionBy(*keys, "_qk").orderBy("d", "v")
    top = cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    wt = 1 / (F.col("d") + 1e-9)
    fc = top.groupBy(*keys, F.col("_qk").alias("k")).agg((F.sum(wt * F.col("v")) / F.sum(wt)).alias("prediction"))
    return query.join(fc, [*keys, "k"], "left")


def importance(model: PipelineModel, xs: Sequence[str], spark) -> DataFrame:
    """Feature importance of the tree model at the end of a pipeline."""
    v = next(s for s in model.stages if hasattr(s, "featureImportances")).featureImportances.toArray()
    return spark.createDataFrame([(x, float(s)) for x, s in zip(xs, v)], "feature string, importance double")


# ------------------------------------------------------------------ composites

def boost_residuals(fitted: DataFrame, base_fc: DataFrame, future: DataFrame, xs: Sequence[str], y: str = "y",
                    learner=None) -> DataFrame:
    """Base model plus trees on its in-sample residual (``fitted`` column); NULL where either has no prediction."""
    d = fitted.withColumn("_res", F.col(y) - F.col("fitted")).dropna(subset=["_res", *xs])
    model = (learner or boosted(xs, "_res", trees=10, depth=3)).fit(d)
    extra = model.transform(future).select("id", "k", F.col("prediction").alias("_b"))
    return base_fc.join(extra, ["id", "k"], "left").select("id", "k", "ts", (F.col("prediction") + F.col("_b")).alias("prediction"))


def recursive(train: DataFrame, future: DataFrame, lags: Sequence[int], models: Sequence, features: Callable[[DataFrame], DataFrame],
              y: str = "y") -> DataFrame:
    """Feed predictions back into the lags, one stamp of *all* series per pass.

    ``models`` are fitted; several are averaged inside each step (recursive ensemble).  A series is one row with
    an array of its last ``max(lags)`` values, NULL where a stamp is missing; each pass reads the lags off it,
    predicts and moves it on.  A run of ``min(lags)`` stamps has no feedback inside it, so that many are predicted
    per pass.  Both the step and the array are written per pass: plans stay the same size however far the horizon.
    Every stamp after the data is returned; where a model has no complete regressors, prediction is NULL.
    """
    stride, deep = min(lags), max(lags)

    def values(h0: int, n: int) -> Column:
        return F.transform(F.sequence(F.lit(h0), F.lit(h0 + n - 1)), lambda h: F.try_element_at("_v", h))

    def by_step(d: DataFrame) -> DataFrame:
        return d.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("_h").cast("int"), F.col(y)))).alias("_v"))

    last = train.groupBy("id").agg(F.max("k").alias("_last"))
    hist = train.join(last, "id").where(F.col("k") > F.col("_last") - deep).select(
        "id", F.col(y).cast("double").alias(y), (F.col("k") - F.col("_last")).alias("_h"))
    state = cut_lineage(by_step(hist).select("id", values(1 - deep, deep).alias("_s")))
    fut = cut_lineage(future.join(last, "id").select("id", "k", "ts", (F.col("k") - F.col("_last")).alias("_h")).where("_h > 0"))
    horizon = fut.agg(F.max("_h")).first()[0] or 0
    steps = [fut.where("false").select("id", "k", "ts", F.lit(None).cast("double").alias(y), "_h")]
    for h in range(1, horizon + 1, stride):
        now = fut.where(F.col("_h").between(h, h + stride - 1)).withColumn(y, F.lit(None).cast("double")).join(state, "id")
        at = (F.col("_h") - h + deep + 1).cast("int")
        now = features(now.withColumns({f"{y}_lag{l}": F.try_element_at("_s", at - l) for l in lags}).drop("_s"))
        total = None
        for j, m in enumerate(models):
            now = m.transform(now).withColumnRenamed("prediction", f"_m{j}").drop("features", "_raw", "_std")
            total = F.col(f"_m{j}") if total is None else total + F.col(f"_m{j}")
        steps.append(cut_lineage(now.select("id", "k", "ts", (total / len(models)).alias(y), "_h")))
        moved = F.slice(F.concat("_s", values(h, stride)), stride + 1, deep)
        state = cut_lineage(state.join(by_step(steps[-1]), "id", "left").select("id", moved.alias("_s")))
    return reduce(DataFrame.unionByName, steps).select("id", "k", "ts", F.col(y).alias("prediction"))


def recursive_linear(train: DataFrame, future: DataFrame, lags: Sequence[int], y: str = "y",
                     keys: Sequence[str] = ("id",), horizon: int | None = None) -> DataFrame:
    """Per-series linear model on lags; the recursion folds over a short history array in the JVM.

    It reaches the last stamp asked of the series (or ``horizon`` cells).  Stamps of a series shorter than the
    lags, or without any training row, stay with a NULL prediction.
    """
    from tidewheel.operators.windows import lag
    d = augment(train.select(*keys, "k", F.col(y).cast("double").alias("_y")), keys=keys, **{f"_l{i}": lag("_y", i) for i in lags})
    model = L.fit(d, "_y", [f"_l{i}" for i in lags], keys=keys)
    deep = max(lags)
    last = train.groupBy(*keys).agg(F.max("k").alias("last_k"))
    tail = train.join(last, list(keys)).where(F.col("k") > F.col("last_k") - deep).groupBy(*keys, "last_k").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", F.col(y).cast("double").alias("y")))), lambda s: s["y"]).alias("_h"))
    ends = future.groupBy(*keys).agg(F.max("k").alias("_end"))
    t = tail.join(model, list(keys)).join(ends, list(keys)).withColumn(
        "_n", (F.col("_end") - F.col("last_k") if horizon is None else F.lit(horizon)).cast("int")).where("_n > 0")

    def step(acc, _):
        n = F.size(acc)
        v = F.col("intercept")
        for i, l in enumerate(lags):
            v = v + F.col("coef")[i] * F.try_element_at(acc, (n - l + 1).cast("int"))
        return F.concat(acc, F.array(v))
    path = F.slice(F.aggregate(F.sequence(F.lit(1), F.col("_n")), F.col("_h"), step), F.size("_h") + 1, F.col("_n"))
    p = t.select(*keys, "last_k", path.alias("_p"))
    h = (F.col("k") - F.col("last_k")).cast("int")
    value = F.when(h > 0, F.try_element_at("_p", h))
    return future.join(p, list(keys), "left").select(*keys, "k", "ts", value.alias("prediction"))


# ------------------------------------------------------------------ tuning

def grid_points(ranges: dict[str, tuple[float, float]], size: int, kind: str = "latin", seed: int = 123,
                log: Sequence[str] = ()) -> list[dict[str, float]]:
    """Latin-hypercube, random, regular or max-entropy (farthest-point) parameter sets."""
    rng = np.random.default_rng(seed)
    p = len(ranges)
    if kind == "latin":
        u = np.column_stack([(rng.permutation(size) + rng.uniform(size=size)) / size for _ in range(p)])
    elif kind == "regular":
        axes = np.meshgrid(*[np.linspace(0, 1, size)] * p)
        u = np.column_stack([a.ravel() for a in axes])
    else:
        u = rng.uniform(size=(size if kind == "random" else 50 * size, p))
        if kind == "max_entropy":
            pick = [0]
            while len(pick) < size:
                gap = np.min(((u[:, None] - u[pick][None]) ** 2).sum(axis=2), axis=1)
                pick.append(int(gap.argmax()))
            u = u[pick]
    out = []
    for row in u:
        point = {}
        for (name, (lo, hi)), v in zip(ranges.items(), row):
            point[name] = float(10 ** (np.log10(lo) + v * (np.log10(hi) - np.log10(lo)))) if name in log else float(lo + v * (hi - lo))
        out.append(point)
    return out
