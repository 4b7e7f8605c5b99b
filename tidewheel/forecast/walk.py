"""Recursive forecasts in one pass: fitted models as arrays, whole horizons walked for many series at once.

A fitted pipeline of linear or tree models becomes a few numpy arrays.  Each Arrow batch of series then steps through its horizon:
state -> regressors -> prediction -> state.  One job, whatever the horizon and the shortest lag.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScalerModel, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Series that one step of a worker advances together.
SERIES = 1024

State = np.ndarray  # series x last values, oldest first; NaN where unknown
Transform = Callable[[State], dict[str, np.ndarray]]


@dataclass(frozen=True)
class Linear:
    coef: np.ndarray
    intercept: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x @ self.coef + self.intercept


@dataclass(frozen=True)
class Trees:
    """Regression trees as flat arrays; ``left`` and ``right`` of a leaf point to itself."""

    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    depth: int

    def __call__(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.root, (len(x), len(self.root)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.value[at] @ self.weight


def read_trees(text: str, weights: Sequence[float], mean: bool) -> Trees:
    """Trees from a model's published description (``toDebugString``), where numbers are written in full."""
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    open_: list[int] = []  # nodes whose second branch is still to come, innermost last
    fresh, side = True, "left"
    for line in text.splitlines()[1:]:
        line = line.strip()
        if line.startswith("Tree "):
            fresh, open_ = True, []
            continue
        if line.startswith("Else"):
            side = "right"
            continue
        if not line.startswith(("If", "Predict")):
            continue
        node = len(value)
        feature.append(0), threshold.append(0.0), left.append(node), right.append(node), value.append(0.0)
        if fresh:
            roots.append(node)
        elif side == "left":
            left[open_[-1]] = node
        else:
            right[open_.pop()] = node
        fresh = False
        if line.startswith("Predict"):
            value[node] = float(line.split(":")[1])
        else:
            head, sep, cut = line[line.index("(") + 1:line.rindex(")")].partition(" <= ")
            if not sep:
                raise ValueError(f"only numeric splits can be walked: {line}")
            feature[node], threshold[node] = int(head.split()[1]), float(cut)
            open_.append(node)
            side = "left"
    w = np.asarray(weights, float) / (len(roots) if mean else 1)
    ints = lambda v: np.array(v, np.int64)
    return Trees(ints(roots), ints(feature), np.array(threshold), ints(left), ints(right), np.array(value), w, max_depth(roots, left, right))


def max_depth(roots: Sequence[int], left: Sequence[int], right: Sequence[int]) -> int:
    depth, level = 0, list(roots)
    while True:
        level = [c for n in level if left[n] != n for c in (left[n], right[n])]
        if not level:
            return depth
        depth += 1


@dataclass(frozen=True)
class Walker:
    """A fitted pipeline as plain arrays: regressor names, scaling and the final model."""

    columns: tuple[str, ...]
    shift: np.ndarray
    scale: np.ndarray
    model: Linear | Trees

    def __call__(self, x: np.ndarray) -> np.ndarray:
        known = ~np.isnan(x).any(1)
        out = np.full(len(x), np.nan)
        if known.any():
            out[known] = self.model((x[known] - self.shift) * self.scale)
        return out


def walker(fitted: PipelineModel) -> Walker:
    """``fitted`` (assembler, optional scaler, linear or tree model) as arrays; other pipelines are refused."""
    columns, shift, scale, model = None, None, None, None
    for s in fitted.stages:
        if isinstance(s, VectorAssembler):
            columns = tuple(s.getInputCols())
            shift, scale = np.zeros(len(columns)), np.ones(len(columns))
        elif isinstance(s, StandardScalerModel):
            sd = s.std.toArray()
            shift = s.mean.toArray() if s.getWithMean() else shift
            scale = np.where(sd > 0, 1 / np.where(sd > 0, sd, 1), 0.0) if s.getWithStd() else scale
        elif isinstance(s, LinearRegressionModel):
            model = Linear(s.coefficients.toArray(), float(s.intercept))
        elif isinstance(s, GBTRegressionModel):
            model = read_trees(s.toDebugString, s.treeWeights, False)
        elif isinstance(s, RandomForestRegressionModel):
            model = read_trees(s.toDebugString, [1.0] * s.getNumTrees, True)
        elif isinstance(s, DecisionTreeRegressionModel):
            model = read_trees(s.toDebugString, [1.0], False)
        elif not isinstance(s, SQLTransformer):
            raise TypeError(f"{type(s).__name__} cannot be walked; use learners.recursive")
    if columns is None or model is None:
        raise TypeError("the pipeline has no assembler or no model")
    return Walker(columns, shift, scale, model)


def lag_transform(lags: Sequence[int], y: str = "y") -> Transform:
    """Regressors ``{y}_lag{l}`` from the last values."""
    return lambda state: {f"{y}_lag{l}": state[:, -l] for l in lags}


def walk(train: DataFrame, future: DataFrame, models: Sequence[PipelineModel], transform: Transform, depth: int, *,
         features: Callable[[DataFrame], DataFrame] = lambda d: d, y: str = "y", series: int = SERIES) -> DataFrame:
    """``id, k, ts, prediction``: predictions fed back step by step, several models averaged inside each step.

    ``transform`` turns the last ``depth`` values of many series (an array, oldest first, NaN where a stamp is missing) into named
    regressors: lags, rolling means, whatever the models were fitted on.  Regressors it does not give come from
    ``features(future)``, which may not depend on ``y``.  Every future stamp is returned, once per row asked; where a model lacks a regressor, the series has no
    training rows, or the stamp is not after them, prediction is NULL.  Only the last ``depth`` values and the asked stamps
    of a series meet in one row.
    """
    walkers = [walker(m) for m in models]
    given = set(transform(np.full((1, depth), np.nan)))
    outer = sorted({c for w in walkers for c in w.columns} - given)
    last = train.groupBy("id").agg(F.max("k").alias("_last"))
    h = (F.col("k") - F.col("_last")).cast("int")
    value = F.col(y).cast("double")
    hist = (train.join(last, "id").where(F.col("k") > F.col("_last") - depth)
            .groupBy("id").agg(F.collect_list(F.struct((h - 1 + depth).alias("i"), value.alias("v"))).alias("_hist")))
    asked = features(future).join(last, "id", "left").select(
        "id", F.struct(F.coalesce(h, F.lit(0)).alias("h"), "k", "ts", F.array(*[F.col(c).cast("double") for c in outer]).cast("array<double>").alias("x")).alias("_f"))
    rows = (asked.groupBy("id").agg(F.sort_array(F.collect_list("_f")).alias("_f")).join(hist, "id", "left")
            .select("id", F.transform("_f", lambda f: f["k"]).alias("k"), F.transform("_f", lambda f: f["ts"]).alias("ts"), F.transform("_f", lambda f: f["h"]).alias("h"),
                    F.flatten(F.transform("_f", lambda f: f["x"])).alias("x"), F.transform("_hist", lambda p: p["i"]).alias("i"), F.transform("_hist", lambda p: p["v"]).alias("v")))

    def floats(a: pa.Array) -> np.ndarray:
        return a.flatten().to_numpy(zero_copy_only=False).astype(float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), series):
                b = whole.slice(lo, series)
                n = len(b)
                width = lambda c: np.array([0 if x is None else x for x in b.column(c).value_lengths().to_pylist()], np.int64)
                count, past = width(3), width(5)
                step = b.column(3).flatten().to_numpy().astype(np.int64)
                own, before = np.repeat(np.arange(n), count), np.repeat(np.arange(n), past)
                x = floats(b.column(4)).reshape(len(step), len(outer))
                horizon = max(int(step.max(initial=0)), 0)
                state = np.full((n, depth + horizon), np.nan)
                state[before, b.column(5).flatten().to_numpy().astype(np.int64)] = floats(b.column(6))
                out = np.full(len(step), np.nan)
                ahead = np.flatnonzero(step > 0)
                order = ahead[np.argsort(step[ahead], kind="stable")]
                for at in np.split(order, np.flatnonzero(np.diff(step[order])) + 1):
                    if not len(at):
                        continue
                    t = int(step[at[0]]) - 1
                    regress = transform(state[own[at], t:t + depth])
                    columns = {**{c: x[at, j] for j, c in enumerate(outer)}, **regress}
                    total = sum(w(np.column_stack([columns[c] for c in w.columns])) for w in walkers) / len(walkers)
                    out[at] = total
                    state[own[at], depth + t] = total
                ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(ends), pa.array(out, pa.float64(), mask=np.isnan(out)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), found], ["id", "k", "ts", "p"])

    key, ts = train.schema["id"].dataType.simpleString(), asked.schema["_f"].dataType["ts"].dataType.simpleString()
    walked = rows.mapInArrow(run, f"id {key}, k array<bigint>, ts array<{ts}>, p array<double>")
    cell = F.explode(F.arrays_zip("k", "ts", "p")).alias("c")
    return walked.select("id", cell).select("id", "c.k", "c.ts", F.col("c.p").alias("prediction"))
