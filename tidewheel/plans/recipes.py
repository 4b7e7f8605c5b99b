"""Declarative feature plan: learn on training rows, apply anywhere.

Each step is a function ``prepare(train) -> apply(df, fitting)``; learned values are a handful of
scalars or the levels of a small factor, kept as literals in the projection.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators import features as FT
from tidewheel.operators.windows import augment, lag

Apply = Callable[[DataFrame, bool], DataFrame]
MAX_LEVELS = 1000


@dataclass(frozen=True)
class Recipe:
    outcome: str
    roles: dict[str, str] = field(default_factory=dict)
    steps: tuple[Callable[[DataFrame], Apply], ...] = ()

    def step(self, prepare: Callable[[DataFrame], Apply]) -> Recipe:
        """Extend with a custom step."""
        return replace(self, steps=(*self.steps, prepare))

    def update_role(self, col: str, role: str) -> Recipe:
        return replace(self, roles={**self.roles, col: role})

    def _plain(self, fn: Callable[[DataFrame], DataFrame]) -> Recipe:
        return self.step(lambda train: lambda df, fitting: fn(df))

    def step_mutate(self, **cols: Column) -> Recipe:
        return self._plain(lambda df: df.withColumns(cols))

    def step_mutate_at(self, regex: str, fn: Callable[[Column], Column]) -> Recipe:
        return self._plain(lambda df: df.withColumns({c: fn(F.col(c)) for c in df.columns if re.search(regex, c)}))

    def step_rm(self, regex: str) -> Recipe:
        return self._plain(lambda df: df.drop(*[c for c in df.columns if re.search(regex, c)]))

    def step_filter(self, cond: Column) -> Recipe:
        """Only while fitting: new rows are never dropped."""
        return self.step(lambda train: lambda df, fitting: df.where(cond) if fitting else df)

    def step_naomit(self, *cols: str) -> Recipe:
        return self.step(lambda train: lambda df, fitting: df.dropna(subset=list(cols) or None) if fitting else df)

    def step_signature(self, ts: str = "ts", parts: Sequence[str] | None = None) -> Recipe:
        return self._plain(lambda df: FT.augment_signature(df, ts, parts))

    def step_fourier(self, periods: Sequence[float], order: int, t: str = "k") -> Recipe:
        return self._plain(lambda df: df.withColumns(FT.fourier_terms(periods, order, t)))

    def step_lag(self, col: str, lags: Sequence[int]) -> Recipe:
        return self._plain(lambda df: augment(df, **{f"{col}_lag{k}": lag(col, k) for k in lags}))

    def step_interact(self, a: str, b: str) -> Recipe:
        """Products of all columns matching ``a`` and ``b``."""
        def apply(df):
            left = {c: F.col(c) for c in df.columns if re.search(a, c)}
            right = {c: F.col(c) for c in df.columns if re.search(b, c)}
            return df.withColumns(FT.interaction(left, right))
        return self._plain(apply)

    def step_normalize(self, regex: str) -> Recipe:
        def prepare(train):
            cols = [c for c in train.columns if re.search(regex, c)]
            one = train.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
            return lambda df, fitting: df.withColumns(
                {c: (F.col(c) - one[f"m_{c}"]) / (one[f"s_{c}"] or 1.0) for c in cols})
        return self.step(prepare)

    def step_dummy(self, *cols: str) -> Recipe:
        def prepare(train):
            levels = {}
            for c in cols:
                rows = train.select(c).distinct().orderBy(c).limit(MAX_LEVELS + 1).collect()
                if len(rows) > MAX_LEVELS:
                    raise ValueError(f"{c} has more than {MAX_LEVELS} levels")
                levels[c] = [x[0] for x in rows if x[0] is not None]
            return lambda df, fitting: df.withColumns(
                {n: e for c in cols for n, e in FT.dummies(c, levels[c]).items()}).drop(*cols)
        return self.step(prepare)

    def step_ns(self, x: str, deg_free: int = 2) -> Recipe:
        """Natural spline with inner knots at quantiles of the training rows."""
        def prepare(train):
            from tidewheel.core import exact_quantiles
            probs = {f"q{i}": i / deg_free for i in range(1, deg_free)}
            lo, hi = train.agg(F.min(x).cast("double"), F.max(x).cast("double")).first()
            q = exact_quantiles(train.select(F.col(x).cast("double").alias(x)), x, probs).first() if probs else {}
            knots = [(q[n] - lo) / (hi - lo) for n in probs]
            u = (F.col(x) - lo) / (hi - lo)
            return lambda df, fitting: df.withColumns(
                {f"{x}_ns{i + 1}": e for i, e in enumerate(FT.natural_spline(u, knots))})
        return self.step(prepare)

    def fit(self, train: DataFrame) -> FittedRecipe:
        applied, d = [], train
        for prepare in self.steps:
            f = prepare(d)
            d = f(d, True)
            applied.append(f)
        return FittedRecipe(self, tuple(applied), d)


@dataclass(frozen=True)
class FittedRecipe:
    recipe: Recipe
    applied: tuple[Apply, ...]
    juice: DataFrame
    """The prepared training rows."""

    def transform(self, df: DataFrame) -> DataFrame:
        for f in self.applied:
            df = f(df, False)
        return df

    def predictors(self) -> list[str]:
        special = {self.recipe.outcome, *self.recipe.roles}
        return [c for c in self.juice.columns if c not in special]

    def assembler(self, out: str = "features") -> VectorAssembler:
        return VectorAssembler(inputCols=self.predictors(), outputCol=out, handleInvalid="keep")
