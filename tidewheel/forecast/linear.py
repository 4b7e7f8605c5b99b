"""Least squares for every series at once: Spark sums the cross products, tiny solves follow."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.core import join_params
from tidewheel.session import cut_lineage

# Up to this many regressors the cross products are plain covariance aggregates.
NARROW = 5

_FIT = "struct<coef:array<double>,intercept:double,r2:double,sigma2:double,status:string>"


def _solver(k: int, ridge: Sequence[float] | float):
    lam = np.broadcast_to(np.asarray(ridge, dtype=float), (k,)).copy()

    def solve(n, means, cov):
        """``cov``: covariances of (x1..xk, y), row by row."""
        c = np.asarray(cov, dtype=float).reshape(k + 1, k + 1)
        m = np.asarray(means, dtype=float)
        sd = np.sqrt(np.clip(np.diag(c)[:k], 0, None))
        use = sd > 1e-12 * (1 + np.abs(m[:k]))
        beta = np.zeros(k)
        status = "ok"
        if use.any():
            s = np.where(use, sd, 1.0)[use]
            r = c[:k, :k][np.ix_(use, use)] / np.outer(s, s)
            b = c[:k, k][use] / s
            if np.linalg.matrix_rank(r, tol=1e-10) < use.sum():
                status = "rank deficient"
                sol = np.linalg.lstsq(r + np.diag(lam[use]), b, rcond=1e-12)[0]
            else:
                sol = np.linalg.solve(r + np.diag(lam[use]), b)
            beta[use] = sol / s
        if not use.all() and status == "ok":
            status = "constant regressor"
        sse = c[k, k] - 2 * beta @ c[:k, k] + beta @ c[:k, :k] @ beta
        r2 = 1 - sse / c[k, k] if c[k, k] > 0 else None
        return beta.tolist(), m[k] - beta @ m[:k], r2, max(sse, 0.0), status

    @F.pandas_udf(_FIT)
    def udf(n: pd.Series, means: pd.Series, cov: pd.Series) -> pd.DataFrame:
        rows = [solve(a, b, c) for a, b, c in zip(n, means, cov)]
        return pd.DataFrame(rows, columns=["coef", "intercept", "r2", "sigma2", "status"])
    return udf


def gram(df: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``keys, n, means, cov`` of (xs, y) over complete rows."""
    cols = [*xs, y]
    if len(xs) <= NARROW:
        d = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols)
        pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
        a = d.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in cols]).alias("means"),
            F.array(*[F.covar_pop(cols[i], cols[j]) for i, j in pairs]).alias("_c"))
        at = {p: q for q, p in enumerate(pairs)}
        full = F.array(*[F.col("_c")[at[(min(i, j), max(i, j))]]
                         for i in range(len(cols)) for j in range(len(cols))])
        return a.select(*keys, "n", "means", full.alias("cov"))
    # Wide: one array column; numpy works each Arrow batch, Spark adds the small arrays up.
    # Two passes, so that the products are centred.
    d = df.select(*keys, F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"))
    d = d.where(~F.exists("_x", lambda v: v.isNull() | F.isnan(v)))
    sums = _sum_arrays(d, keys, lambda x: np.append(len(x), x.sum(axis=0)))
    m = sums.select(*keys, F.col("_a")[0].cast("bigint").alias("n"), F.transform(
        F.slice("_a", 2, len(cols)), lambda v: v / F.col("_a")[0]).alias("means"))
    cent = join_params(d, m.select(*keys, "means"), keys).select(
        *keys, F.zip_with("_x", "means", lambda v, c: v - c).alias("_x"))
    prods = _sum_arrays(cent, keys, lambda x: (x.T @ x).ravel())
    return m.join(prods, list(keys)).select(*keys, "n", "means", F.transform(
        "_a", lambda v: v / F.col("n")).alias("cov"))


def _sum_arrays(d: DataFrame, keys: Sequence[str], fn) -> DataFrame:
    """Per key the element-wise sum of ``fn(rows)`` over all batches: combined before the shuffle."""
    by = list(keys)
    fields = ", ".join(f"`{k}` {d.schema[k].dataType.simpleString()}" for k in by)

    def part(batches):
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame([(*key, fn(np.vstack(g["_x"].to_numpy())).astype(float))
                                    for key, g in pdf.groupby(by, sort=False)], columns=[*by, "_a"])

    cells = (d.mapInPandas(part, f"{fields}, _a array<double>").select(*by, F.posexplode("_a").alias("p", "v"))
              .groupBy(*by, "p").agg(F.sum("v").alias("v")))
    return cells.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "v"))),
                                              lambda s: s["v"]).alias("_a"))


def fit(df: DataFrame, y: str, xs: Sequence[str], *, keys: Sequence[str] = ("id",),
        ridge: Sequence[float] | float = 0.0) -> DataFrame:
    """``keys, n, coef, intercept, r2, sigma2, status``; one row per series.

    ``sigma2`` is SSE / n.  ``ridge`` acts on the scaled regressors.  Failures show in ``status``.
    """
    g = gram(df, y, list(xs), list(keys))
    return g.select(*keys, "n", _solver(len(xs), ridge)("n", "means", "cov").alias("_f")).select(
        *keys, "n", "_f.*")


def value_of(coef: str, intercept: str, xs: Sequence[str]) -> Column:
    """``intercept + sum(coef x)``; NULL where a regressor is."""
    terms = F.zip_with(coef, F.array(*[F.col(x).cast("double") for x in xs]), lambda c, v: c * v)
    return F.col(intercept) + F.aggregate(terms, F.lit(0.0), lambda a, v: a + v)


def predict(df: DataFrame, model: DataFrame, xs: Sequence[str], *, keys: Sequence[str] = ("id",),
            out: str = "prediction") -> DataFrame:
    m = model.select(*keys, F.col("coef").alias("_coef"), F.col("intercept").alias("_b0"))
    return join_params(df, m, keys).withColumn(out, value_of("_coef", "_b0", xs)).drop("_coef", "_b0")


def coefficients(model: DataFrame, xs: Sequence[str], keys: Sequence[str] = ("id",)) -> DataFrame:
    """Long table ``keys, term, estimate``."""
    rows = F.array(F.struct(F.lit("intercept").alias("term"), F.col("intercept").alias("estimate")),
                   *[F.struct(F.lit(x).alias("term"), F.col("coef")[i].alias("estimate"))
                     for i, x in enumerate(xs)])
    return model.select(*keys, F.inline(rows))


def smooth_regression(df: DataFrame, y: str, xs: Sequence[str], *, keys: Sequence[str] = ("id",),
                      ridge: Sequence[float] | float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Fit and attach ``fitted`` to every row: (rows, model)."""
    model = fit(df, y, xs, keys=keys, ridge=ridge)
    return predict(df, model, xs, keys=keys, out="fitted"), model


def terms_of(df: DataFrame, formula: str, max_levels: int = 1000) -> tuple[str, dict[str, Column], bool]:
    """``(outcome, {name: column}, intercept)`` of ``"y ~ a + factor(b) + a:b - 1"``.

    A term is a Spark SQL expression; ``factor(e)`` gives one 0/1 column per level of ``e`` in ``df`` but the first, and ``a:b`` the
    products of the columns of both.  ``- 1`` leaves out the intercept.  Levels are read off ``df`` once: more than ``max_levels`` are refused.
    """
    left, sep, right = formula.partition("~")
    if not sep or not left.strip() or not right.strip():
        raise ValueError(f"not a formula: {formula!r}")
    intercept = True
    if re.search(r"-\s*1\s*$", right):
        right, intercept = re.sub(r"-\s*1\s*$", "", right), False

    def columns(part: str) -> dict[str, Column]:
        m = re.fullmatch(r"factor\((.+)\)", part)
        if not m:
            return {part: F.expr(part).cast("double")}
        e = F.expr(m[1])
        rows = df.select(e.alias("v")).where("v IS NOT NULL").distinct().orderBy("v").limit(max_levels + 1).collect()
        if len(rows) > max_levels:
            raise ValueError(f"{part} has more than {max_levels} levels")
        return {f"{m[1]}={r.v}": F.when(e.isNotNull(), (e == F.lit(r.v)).cast("double")) for r in rows[1:]}

    out: dict[str, Column] = {}
    # Plus signs and colons inside brackets belong to expressions.
    for term in (t.strip() for t in re.split(r"\+(?![^()]*\))", right)):
        if not term:
            raise ValueError(f"empty term in {formula!r}")
        parts = [columns(p.strip()) for p in re.split(r":(?![^()]*\))", term)]
        cells = parts[0]
        for more in parts[1:]:
            cells = {f"{a}:{b}": x * z for a, x in cells.items() for b, z in more.items()}
        out.update(cells)
    return left.strip(), out, intercept


def regress(df: DataFrame, formula: str, *, keys: Sequence[str] = ("id",), ridge: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Least squares by formula: (``df`` with ``fitted`` and ``residual``, long table ``keys, term, estimate, n, r2, status``).

    Every row comes back; where the outcome or a term is unknown, so are ``fitted`` or ``residual``.  Without an intercept the
    regressors and the outcome are mirrored, which centres them.
    """
    outcome, cols, intercept = terms_of(df, formula)
    names = {c: f"_x{i}" for i, c in enumerate(cols)}
    d = df.withColumns({"_y": F.expr(outcome).cast("double"), **{n: cols[c] for c, n in names.items()}})
    xs = list(names.values())
    d = cut_lineage(d)
    learn = d.select(*keys, "_y", *xs)
    if not intercept:
        learn = learn.unionByName(learn.select(*keys, *[(-F.col(c)).alias(c) for c in ("_y", *xs)]))
    model = cut_lineage(fit(learn, "_y", xs, keys=keys, ridge=ridge))
    m = model.select(*keys, F.col("coef").alias("_coef"), F.col("intercept").alias("_b0"))
    rows = d.join(m, list(keys), "left").withColumn("fitted", value_of("_coef", "_b0", xs)).withColumn("residual", F.col("_y") - F.col("fitted"))
    label = F.array(*([F.struct(F.lit("(intercept)").alias("term"), F.col("intercept").alias("estimate"))] if intercept else []),
                    *[F.struct(F.lit(c).alias("term"), F.col("coef")[i].alias("estimate")) for i, c in enumerate(cols)])
    n = F.col("n") if intercept else (F.col("n") / 2).cast("bigint")
    return rows.drop("_y", "_coef", "_b0", *xs), model.select(*keys, n.alias("n"), "r2", "status", F.inline(label)).select(*keys, "term", "estimate", "n", "r2", "status")
