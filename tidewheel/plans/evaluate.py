"""Calibration, accuracy, intervals, selection and forecast tables.

Flat schema: ``model_id, id, k, ts, actual, prediction, residual``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.core import at_lag, exact_quantiles, halo_select, join_params
from tidewheel.operators.verbs import slice_ranked
from tidewheel.session import cut_lineage

# Two-sided standard normal quantiles.
Z = {80: 1.2815515655446004, 90: 1.6448536269514722, 95: 1.959963984540054, 99: 2.5758293035489004}


def normal_quantile(level: float) -> float:
    """Two-sided standard normal quantile of any level in percent."""
    return Z[level] if level in Z else NormalDist().inv_cdf(0.5 + level / 200)


METRICS = ("mae", "mape", "mase", "smape", "rmse", "rsq")


def calibrate(forecast: DataFrame, actual: DataFrame, y: str = "y") -> DataFrame:
    """Join forecasts with what happened; one row per (model, id, stamp)."""
    a = actual.select("id", "k", F.col(y).cast("double").alias("actual"))
    return forecast.join(a, ["id", "k"]).withColumn("residual", F.col("actual") - F.col("prediction"))


def accuracy(cal: DataFrame, by: Sequence[str] = ("model_id", "id"), *,
             series: Sequence[str] = ("model_id", "id")) -> DataFrame:
    """MAE, MAPE, MASE, SMAPE, RMSE, R2 per ``by``.

    MASE scales by the mean absolute step of the evaluated actuals; a zero actual is left out of
    MAPE and counted in ``n_zero``.
    """
    d = halo_select(cal, lambda w: {"_step": F.abs(F.col("actual") - at_lag("actual", 1, w))}, 1, keys=series)
    e, a, p = F.abs("residual"), F.col("actual"), F.col("prediction")
    g = d.groupBy(*by).agg(
        F.count(e).alias("n"), F.avg(e).alias("mae"), (100 * F.avg(F.when(a != 0, e / F.abs(a)))).alias("mape"),
        (F.avg(e) / F.nullif(F.avg("_step"), F.lit(0.0))).alias("mase"),
        (100 * F.avg(F.when(F.abs(a) + F.abs(p) > 0, 2 * e / (F.abs(a) + F.abs(p))))).alias("smape"),
        F.sqrt(F.avg(F.col("residual") * F.col("residual"))).alias("rmse"),
        F.covar_pop("actual", "prediction").alias("_c"), F.var_pop(a).alias("_va"), F.var_pop(p).alias("_vp"),
        F.count(F.when(a == 0, 1)).alias("n_zero"))
    # A flat forecast or flat actuals have no correlation.
    ok = (F.col("_va") > 1e-18) & (F.col("_vp") > 1e-18 * (1 + F.col("_va")))
    return g.withColumn("rsq", F.when(ok, F.col("_c") * F.col("_c") / (F.col("_va") * F.col("_vp")))).select(
        *by, "n", *METRICS, "n_zero")


def rmsse(cal: DataFrame, train: DataFrame, y: str = "y") -> DataFrame:
    """Per (model, id): RMSE over the root mean squared one-step change of the training rows."""
    t = halo_select(train.select("id", "k", F.col(y).alias("_y")),
                    lambda w: {"_d": F.col("_y") - at_lag("_y", 1, w)}, 1)
    q = t.groupBy("id").agg(F.avg(F.col("_d") * F.col("_d")).alias("_q"))
    m = cal.groupBy("model_id", "id").agg(F.avg(F.col("residual") * F.col("residual")).alias("_m"))
    return m.join(q, "id").select("model_id", "id", F.sqrt(F.col("_m") / F.nullif(F.col("_q"), F.lit(0.0))).alias("rmsse"))


def average_scores(scores: DataFrame, cols: Sequence[str], by: Sequence[str] = ("model_id",)) -> DataFrame:
    """Mean over series of per-series scores, as competitions report them."""
    return scores.groupBy(*by).agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("n_series"))


def root_sum_sq(truth: DataFrame, submission: DataFrame, series: Sequence[str], on: Sequence[str] = ("ts",),
                digits: int = 2) -> DataFrame:
    """Submission score: per column the root of the *sum* of squares, rounded, then the mean."""
    t = truth.select(*on, *[F.col(c).alias(f"_t_{c}") for c in series])
    d = submission.join(t, list(on))
    per = [F.round(F.sqrt(F.sum(F.pow(F.col(f"_t_{c}") - F.col(c), F.lit(2)))), digits).alias(c) for c in series]
    one = d.agg(*per)
    total = sum([F.col(c) for c in series[1:]], F.col(series[0]))
    return one.withColumn("score", total / len(series))


def select_best(acc: DataFrame, metric: str = "rmse", n: int = 1, by_id: bool = False,
                id_var: str | None = None) -> DataFrame:
    """Best ``n`` models (ties kept), overall or per id; R2 is maximised, the rest minimised."""
    if by_id and not id_var:
        raise ValueError("by_id needs id_var")
    best = slice_ranked(acc, metric, n, largest=metric == "rsq", by=[id_var] if by_id else [])
    return best.select(*([id_var] if by_id else []), "model_id", metric)


def best_forecast(forecast: DataFrame, best: DataFrame) -> DataFrame:
    """Each id's rows from its own best model; model_id breaks ties."""
    w = Window.partitionBy("id").orderBy("_m", "model_id")
    metric = [c for c in best.columns if c not in ("id", "model_id")][0]
    sign = -1 if metric == "rsq" else 1
    one = (best.withColumn("_m", sign * F.col(metric)).withColumn("_r", F.row_number().over(w))
               .where("_r = 1").select("id", "model_id"))
    return forecast.join(one, ["id", "model_id"], "left_semi")


def interval_normal(forecast: DataFrame, cal: DataFrame, levels: Sequence[int] = (95,),
                    by: Sequence[str] = ("model_id",)) -> DataFrame:
    """Prediction +- z * sd(residual); one row per level."""
    s = cal.groupBy(*by).agg(F.stddev_samp("residual").alias("_s"))
    lv = F.array(*[F.struct(F.lit(l).alias("level"), F.lit(normal_quantile(l)).alias("_z")) for l in levels])
    j = forecast.join(s, list(by)).select(*forecast.columns, "_s", F.inline(lv))
    return j.select(*forecast.columns, "level", (F.col("prediction") - F.col("_z") * F.col("_s")).alias("lo"),
                    (F.col("prediction") + F.col("_z") * F.col("_s")).alias("hi"))


def interval_conformal(forecast: DataFrame, cal: DataFrame, levels: Sequence[int] = (95,),
                       by: Sequence[str] = ("model_id",)) -> DataFrame:
    """Prediction +- the ceil((n + 1) level)-th smallest absolute residual (at most the n-th)."""
    q = exact_quantiles(cal.withColumn("_a", F.abs("residual")), "_a", {f"_q{l}": l / 100 for l in levels},
                        keys=by, kind="conformal")
    lv = F.array(*[F.struct(F.lit(l).alias("level"), F.col(f"_q{l}").alias("_q")) for l in levels])
    j = forecast.join(q.select(*by, lv.alias("_lv")), list(by)).select(*forecast.columns, F.inline("_lv"))
    return j.select(*forecast.columns, "level", (F.col("prediction") - F.col("_q")).alias("lo"),
                    (F.col("prediction") + F.col("_q")).alias("hi"))


def forecast_table(actual: DataFrame, forecast: DataFrame, y: str = "y", keep: Sequence[str] = ()) -> DataFrame:
    """Actual and predicted rows in one table with a ``key`` column."""
    a = actual.select(F.lit("actual").alias("key"), F.lit(None).cast("string").alias("model_id"), "id", "ts",
                      F.col(y).cast("double").alias("value"), *keep)
    p = forecast.select(F.lit("prediction").alias("key"), "model_id", "id", "ts", F.col("prediction").alias("value"),
                        *[c for c in forecast.columns if c in ("lo", "hi", "level")])
    return a.unionByName(p, allowMissingColumns=True)


def status_report(fits: DataFrame) -> DataFrame:
    """Series whose fit reported a problem."""
    return fits.where(F.col("status") != "ok").select("model_id", "id", "status")


def nested_forecast(models: dict[str, Callable[[DataFrame, DataFrame], DataFrame]], train: DataFrame, future: DataFrame, *,
                    needs: dict[str, int] | None = None, y: str = "y") -> tuple[DataFrame, DataFrame]:
    """Run every model on every series and keep what fails: (forecasts, report).

    ``models``: name -> ``f(train, future)``, which returns ``id, k, ts, prediction``.  ``forecasts`` (``model_id, id, k, ts, prediction``) has every
    asked stamp of every model.  ``report`` has one row per (model, id): ``status`` is ``ok``, ``partial`` or ``failed``, ``error`` says why, with
    ``n_known`` training values, ``n_asked`` and ``n_predicted`` stamps.  A model whose job raises fails for all ids with the
    exception's first line and does not stop the others; a series that cannot be fitted fails alone.  ``needs`` names the known
    values that a model asks for (1 by default).
    """
    spark, needs = train.sparkSession, needs or {}
    asked = cut_lineage(future.select("id", "k", "ts"))
    parts, raised = [], {}
    for name, f in models.items():
        try:
            got = cut_lineage(f(train, future).select("id", "k", F.col("prediction").cast("double").alias("prediction")))
        except Exception as e:  # noqa: BLE001 - whatever a model raises becomes its report
            raised[name] = f"{type(e).__name__}: {str(e).strip().splitlines()[0] if str(e).strip() else ''}"
            got = asked.select("id", "k", F.lit(None).cast("double").alias("prediction"))
        # One prediction per stamp: a NaN is none.
        got = got.groupBy("id", "k").agg(F.max(F.when(~F.isnan("prediction"), F.col("prediction"))).alias("prediction"))
        parts.append(asked.join(got, ["id", "k"], "left").select(F.lit(name).alias("model_id"), "id", "k", "ts", "prediction"))
    forecasts = cut_lineage(reduce(DataFrame.unionByName, parts))
    value = F.col(y).cast("double")
    value = F.when(~F.isnan(value), value)
    facts = train.groupBy("id").agg(F.count(value).alias("n_known"), (F.min(value) == F.max(value)).alias("_flat"))
    rows = spark.createDataFrame([(n, needs.get(n, 1), raised.get(n)) for n in models], "model_id string, _need int, _raised string")
    n = forecasts.groupBy("model_id", "id").agg(F.count(F.lit(1)).alias("n_asked"), F.count("prediction").alias("n_predicted"))
    d = n.join(rows, "model_id").join(facts, "id", "left").withColumn("n_known", F.coalesce("n_known", F.lit(0)))
    error = (F.when(F.col("n_predicted") == F.col("n_asked"), F.lit(None).cast("string")).when(F.col("_raised").isNotNull(), F.col("_raised"))
             .when(F.col("n_known") == 0, F.lit("no known value"))
             .when(F.col("n_known") < F.col("_need"), F.concat(F.col("n_known").cast("string"), F.lit(" known values, needs "), F.col("_need").cast("string")))
             .when(F.col("_flat"), F.lit("constant series")).otherwise(F.lit("no stable fit")))
    status = F.when(F.col("n_predicted") == F.col("n_asked"), "ok").when(F.col("n_predicted") > 0, "partial").otherwise("failed")
    return forecasts, d.select("model_id", "id", status.alias("status"), error.alias("error"), "n_known", "n_asked", "n_predicted")
