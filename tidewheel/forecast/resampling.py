"""Resampled learners: time slices or folds, metrics, tuning, leaderboard and stacking.

A resampled frame holds ``slice, role`` (``time_series_cv``: a row may serve several slices, and only the rows whose role is
``train`` are learned from) or ``fold`` (``vfold``: all other folds are learned from).  It is written once; every fit is a job of its own
and up to ``workers`` of them run side by side, so small fits do not wait for each other.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.plans.resample import vfold
from tidewheel.session import WORKERS, cut_lineage, side_by_side

#: Columns that estimators leave behind.
_LEFT = ("features", "_raw", "_std")
_METRICS = "slice int, set int, rmse double, mae double, mape double, smape double, rsq double, n long"


@dataclass(frozen=True)
class Resamples:
    """A resampled frame: ``names`` of its splits and their rows."""

    rows: DataFrame
    names: tuple[int, ...]
    timed: bool

    @staticmethod
    def of(df: DataFrame) -> Resamples:
        """The frame is written once; the splits' names (a handful by construction) are read off it."""
        timed = {"slice", "role"} <= set(df.columns)
        if not timed and "fold" not in df.columns:
            raise ValueError("needs the columns slice and role, or fold")
        d, by = cut_lineage(df), "slice" if timed else "fold"
        names = d.where(F.col(by).isNotNull()).select(by).distinct().orderBy(by).collect()
        return Resamples(d, tuple(int(r[0]) for r in names), timed)

    def train(self, name: int) -> DataFrame:
        if self.timed:
            return self.rows.where((F.col("slice") == name) & (F.col("role") == "train")).drop("slice", "role")
        return self.rows.where(F.col("fold") != name).drop("fold")

    def test(self, name: int) -> DataFrame:
        if self.timed:
            return self.rows.where((F.col("slice") == name) & (F.col("role") == "test")).drop("slice", "role")
        return self.rows.where(F.col("fold") == name).drop("fold")


def _predict(fitted, df: DataFrame, name: str) -> DataFrame:
    return fitted.transform(df).withColumnRenamed("prediction", name).drop(*_LEFT)


def out_of_fold(df: DataFrame, learners: dict[str, object], *, workers: int = WORKERS) -> DataFrame:
    """The test rows of every split with ``slice`` and one prediction column per learner, each from a fit on that split's training rows."""
    r = df if isinstance(df, Resamples) else Resamples.of(df)
    pairs = [(s, n) for s in r.names for n in learners]
    fits = dict(zip(pairs, side_by_side(r.rows.sparkSession, [lambda s=s, n=n: learners[n].fit(r.train(s)) for s, n in pairs], workers)))
    parts = [reduce(lambda d, n: _predict(fits[s, n], d, n), learners, r.test(s).withColumn("slice", F.lit(s))) for s in r.names]
    if not parts:
        return r.rows.where("false").withColumns({"slice": F.lit(None).cast("int"), **{n: F.lit(None).cast("double") for n in learners}})
    return reduce(DataFrame.unionByName, parts)


def fit_resamples(df: DataFrame, learners: dict[str, object], y: str = "y", keep: Sequence[str] = ("id", "k", "ts"), *, workers: int = WORKERS) -> DataFrame:
    """Long form of ``out_of_fold``: ``slice, model_id, *keep, y, prediction``."""
    wide = out_of_fold(df, learners, workers=workers)
    return wide.select("slice", *keep, F.col(y).cast("double").alias("y"), F.inline(F.array(*[
        F.struct(F.lit(n).alias("model_id"), F.col(n).cast("double").alias("prediction")) for n in learners])))


def _errors(y: Column, p: Column) -> list[Column]:
    """Metrics over the rows where both are known."""
    e = y - p
    return [F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), (100 * F.avg(F.abs(F.try_divide(e, y)))).alias("mape"),
            (100 * F.avg(F.try_divide(2 * F.abs(e), F.abs(y) + F.abs(p)))).alias("smape"), F.pow(F.corr(F.when(p.isNotNull(), y), F.when(y.isNotNull(), p)), F.lit(2)).alias("rsq"), F.count(e).alias("n")]


def resample_metrics(predictions: DataFrame, by: Sequence[str] = ("model_id",)) -> DataFrame:
    """Metrics per split, then their mean over splits with ``rmse_se`` and ``n_splits``."""
    one = predictions.groupBy(*by, "slice").agg(*_errors(F.col("y"), F.col("prediction")))
    return _mean(one, by)


def _mean(one: DataFrame, by: Sequence[str]) -> DataFrame:
    names = ("rmse", "mae", "mape", "smape", "rsq")
    return one.groupBy(*by).agg(*[F.avg(m).alias(m) for m in names], (F.stddev_samp("rmse") / F.sqrt(F.count("rmse").cast("double"))).alias("rmse_se"),
                                F.count("rmse").alias("n_splits"))


def tune(df: DataFrame, build: Callable[[dict], object], points: Sequence[dict], y: str = "y", *, workers: int = WORKERS) -> DataFrame:
    """``set, params`` (JSON) and mean metrics over the splits for every parameter set, best RMSE first.

    One fit per (set, split); only its few metric numbers come back.
    """
    r = df if isinstance(df, Resamples) else Resamples.of(df)
    spark = r.rows.sparkSession

    def one(i: int, point: dict, s: int) -> tuple:
        res = build(point).fit(r.train(s)).transform(r.test(s))
        return (s, i, *res.agg(*_errors(F.col(y).cast("double"), F.col("prediction"))).first())

    rows = side_by_side(spark, [lambda i=i, p=p, s=s: one(i, p, s) for i, p in enumerate(points) for s in r.names], workers)
    names = spark.createDataFrame([(i, json.dumps(p, sort_keys=True)) for i, p in enumerate(points)], "set int, params string")
    return names.join(_mean(spark.createDataFrame(rows, _METRICS), ["set"]), "set", "left").orderBy(F.asc_nulls_last("rmse"), "set")


def show_best(results: DataFrame, metric: str = "rmse", n: int = 1) -> DataFrame:
    from tidewheel.operators.verbs import slice_ranked
    return slice_ranked(results, metric, n, largest=metric == "rsq")


def best_params(results: DataFrame, metric: str = "rmse") -> dict:
    """The winning parameter set; ties go to the set that comes first."""
    order = F.desc_nulls_last(metric) if metric == "rsq" else F.asc_nulls_last(metric)
    top = results.orderBy(order, "set").select("params").first()
    if top is None:
        raise ValueError("no parameter set was tuned")
    return json.loads(top[0])


def finalize(build: Callable[[dict], object], results: DataFrame, metric: str = "rmse"):
    """The estimator with the winning parameters, ready to be fitted to all training rows."""
    return build(best_params(results, metric))


class Tuned:
    """An estimator that first chooses its own parameters over ``split(train)`` and then learns from all of ``train``."""

    def __init__(self, build: Callable[[dict], object], points: Sequence[dict], split: Callable[[DataFrame], DataFrame] | None = None, y: str = "y",
                 metric: str = "rmse", workers: int = WORKERS):
        self.build, self.points, self.y, self.metric, self.workers = build, list(points), y, metric, workers
        self.split = split or (lambda d: vfold(d, 3))

    def fit(self, train: DataFrame):
        results = tune(self.split(train), self.build, self.points, self.y, workers=self.workers)
        return finalize(self.build, results, self.metric).fit(train)


def leaderboard(df: DataFrame, candidates: dict[str, object], y: str = "y", include: Sequence[str] | None = None, exclude: Sequence[str] = (), *,
                workers: int = WORKERS) -> DataFrame:
    """Candidates by mean RMSE over the splits, best first."""
    names = [n for n in candidates if (include is None or n in include) and n not in exclude]
    t = tune(df, lambda p: candidates[p["model"]], [{"model": n} for n in names], y, workers=workers)
    return t.select(F.get_json_object("params", "$.model").alias("model"), *[c for c in t.columns if c not in ("set", "params")])


def refit(candidates: dict[str, object], train: DataFrame, name: str | DataFrame):
    """The named candidate, or the first of a leaderboard, fitted to ``train``."""
    return candidates[name if isinstance(name, str) else name.first()["model"]].fit(train)


@dataclass
class Stack:
    """Meta-learner over out-of-fold predictions of sub-models.

    ``split(train)`` gives the resampled frame the sub-models are tried on (time slices or folds); the meta-learner sees their
    predictions only for rows they were not learned from.  The sub-models then learn from all of ``train``.  A stack is an
    estimator itself, so stacks can be sub-models of the next level, and ``meta`` may be ``Tuned``.
    """

    learners: dict[str, object]
    meta: object
    split: Callable[[DataFrame], DataFrame]
    workers: int = WORKERS

    def fit(self, train: DataFrame) -> StackModel:
        oof = cut_lineage(out_of_fold(self.split(train), self.learners, workers=self.workers))
        return StackModel(self, self._submodels(train), self.meta.fit(oof))

    def _submodels(self, train: DataFrame) -> dict[str, object]:
        names = list(self.learners)
        return dict(zip(names, side_by_side(train.sparkSession, [lambda n=n: self.learners[n].fit(train) for n in names], self.workers)))


@dataclass
class StackModel:
    stack: Stack
    submodels: dict[str, object]
    meta: object

    def transform(self, df: DataFrame) -> DataFrame:
        wide = reduce(lambda d, n: _predict(self.submodels[n], d, n), self.submodels, df)
        return self.meta.transform(wide).drop(*_LEFT, *self.submodels)

    def refit(self, train: DataFrame, meta: bool = False) -> StackModel:
        """Sub-models learned anew from ``train``; the meta-learner as well if ``meta``."""
        return self.stack.fit(train) if meta else StackModel(self.stack, self.stack._submodels(train), self.meta)
