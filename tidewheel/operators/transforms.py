"""Per-series transform parameters, learned by aggregation and attached by join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.core import join_params
from tidewheel.functions import scalars as S


def scale_params(df: DataFrame, y: str = "y", keys: Sequence[str] = ("id",)) -> DataFrame:
    """``mean, sd, lo, hi`` per key."""
    return df.groupBy(*keys).agg(F.avg(y).alias("mean"), F.stddev_samp(y).alias("sd"),
                                 F.min(y).alias("lo"), F.max(y).alias("hi"))


def standardize_vec(df, y="y", out="z", keys=("id",)):
    p = scale_params(df, y, keys).select(*keys, "mean", "sd")
    return join_params(df, p, keys).withColumn(out, S.standardize(y, "mean", "sd")).drop("mean", "sd")


def normalize_vec(df, y="y", out="z", keys=("id",)):
    p = scale_params(df, y, keys).select(*keys, "lo", "hi")
    return join_params(df, p, keys).withColumn(out, S.normalize(y, "lo", "hi")).drop("lo", "hi")


def log_interval_params(df: DataFrame, y: str = "y", lower: float = 0.0, upper: float | None = None,
                        offset: float = 1.0, keys: Sequence[str] = ("id",)) -> DataFrame:
    """``limit_lower, limit_upper, offset`` per key; automatic upper limit = 1.1 * max + offset."""
    top = F.lit(upper) if upper is not None else 1.1 * F.max(y) + offset
    return df.groupBy(*keys).agg(F.lit(lower).alias("limit_lower"), top.alias("limit_upper"),
                                 F.lit(offset).alias("offset"))


def log_interval_standardize(df: DataFrame, y: str = "y", out: str = "z", *, offset: float = 1.0,
                             keys: Sequence[str] = ("id",), train=None) -> tuple[DataFrame, DataFrame]:
    """Interval logit, then standardise.  Parameters come from the rows where ``train`` holds
    (default: all rows).  Returns the frame and the parameters the inverse needs."""
    learn = df.where(train) if train is not None else df
    lim = log_interval_params(learn, y, offset=offset, keys=keys)
    z = S.log_interval(y, "limit_lower", "limit_upper", "offset")
    ms = (join_params(learn, lim, keys).withColumn("_z", z).groupBy(*keys)
          .agg(F.avg("_z").alias("mean"), F.stddev_samp("_z").alias("sd")))
    params = lim.join(ms, list(keys))
    done = join_params(df, params, keys).withColumn(out, S.standardize(z, "mean", "sd"))
    return done.drop("limit_lower", "limit_upper", "offset", "mean", "sd"), params


def invert_forecast(fc: DataFrame, params: DataFrame, cols: Sequence[str],
                    keys: Sequence[str] = ("id",)) -> DataFrame:
    """Bring predictions and bounds back to the original scale; the residual is recomputed."""
    j = join_params(fc, params, keys)
    out = j.withColumns({c: S.std_logint_inv(c, "mean", "sd", "limit_lower", "limit_upper", "offset")
                         for c in cols})
    if "residual" in fc.columns:
        out = out.withColumn("residual", F.col("actual") - F.col("prediction"))
    return out.drop("mean", "sd", "limit_lower", "limit_upper", "offset")


def box_cox_lambda(df: DataFrame, y: str = "y", grid: Sequence[float] | None = None,
                   keys: Sequence[str] = ("id",)) -> DataFrame:
    """Maximum-likelihood lambda per key over a grid, in one aggregation pass."""
    lams = list(grid) if grid is not None else [round(-1 + 0.1 * i, 1) for i in range(31)]
    pos = df.where(F.col(y) > 0)
    a = pos.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.log(y)).alias("_sl"),
                               *[F.var_pop(S.box_cox(y, l)).alias(f"_v{i}") for i, l in enumerate(lams)])
    scored = F.array(*[F.struct((-F.col("_n") / 2 * F.log(f"_v{i}") + (l - 1) * F.col("_sl")).alias("loglik"),
                                F.lit(float(l)).alias("lambda")) for i, l in enumerate(lams)])
    return a.select(*keys, F.array_max(scored).alias("_b")).select(*keys, "_b.lambda", "_b.loglik")


def box_cox_vec(df, y="y", out="z", lam=None, keys=("id",)):
    if lam is not None:
        return df.withColumn(out, S.box_cox(y, lam))
    p = box_cox_lambda(df, y, keys=keys).select(*keys, "lambda")
    return join_params(df, p, keys).withColumn(out, S.box_cox(y, "lambda"))
