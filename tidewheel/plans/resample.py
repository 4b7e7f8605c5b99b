"""Splits, cross-validation slices and folds as columns; no data is copied."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.core import Step, join_params
from tidewheel.operators.timeverbs import horizon_cells


def time_series_split(df: DataFrame, by: str | Step, assess: int | str, *, initial: int | str | None = None,
                      cumulative: bool = True) -> DataFrame:
    """``segment``: the last ``assess`` cells *by date* are ``test`` for every id, the rest ``train``.

    Without ``cumulative`` only the ``initial`` cells before the cut are kept for training.
    """
    h = horizon_cells(assess, by)
    last = df.agg(F.max("k")).scalar()
    d = df.withColumn("segment", F.when(F.col("k") > last - h, "test").otherwise("train"))
    if not cumulative and initial is not None:
        d = d.where(F.col("k") > last - h - horizon_cells(initial, by))
    return d


def nested_split(df: DataFrame, length_test: int, keys: Sequence[str] = ("id",)) -> DataFrame:
    """``segment`` with the last ``length_test`` cells of *each id* as ``test``."""
    last = df.groupBy(*keys).agg(F.max("k").alias("_last"))
    return join_params(df, last, keys).withColumn(
        "segment", F.when(F.col("k") > F.col("_last") - length_test, "test").otherwise("train")).drop("_last")


def training(df: DataFrame) -> DataFrame:
    return df.where(F.col("segment") == "train").drop("segment")


def testing(df: DataFrame) -> DataFrame:
    return df.where(F.col("segment") == "test").drop("segment")


def time_series_cv(df: DataFrame, by: str | Step, *, initial: int | str, assess: int | str,
                   skip: int | str, cumulative: bool = False, slice_limit: int = 3) -> DataFrame:
    """Rows tagged with ``slice`` (1 = latest) and ``role``; a row may serve several slices.

    Membership is arithmetic on ``k``: no slice table, no range join.
    """
    n0, h, s = (horizon_cells(x, by) for x in (initial, assess, skip))
    lo, hi = df.agg(F.min("k")).scalar(), df.agg(F.max("k")).scalar()
    k = F.col("k")
    tags = []
    for i in range(slice_limit):
        test_end = hi - i * s
        test_start = test_end - h + 1
        first = lo if cumulative else test_start - n0
        role = F.when(k.between(test_start, test_end), "test").when((k >= first) & (k < test_start), "train")
        tags.append(F.when(role.isNotNull() & (test_start - n0 >= lo),
                           F.struct(F.lit(i + 1).alias("slice"), role.alias("role"))))
    d = df.withColumn("_t", F.explode(F.array_compact(F.array(*tags))))
    return d.select(*df.columns, "_t.slice", "_t.role")


def cv_plan(cv: DataFrame) -> DataFrame:
    return cv.groupBy("slice", "role").agg(F.min("ts").alias("start"), F.max("ts").alias("end"),
                                           F.count(F.lit(1)).alias("n"))


def hash_bucket(cols: Sequence[str | Column], seed: int, v: int) -> Column:
    """Stable bucket 0..v-1 from the row's own key: survives re-runs and lost executors."""
    text = F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c for c in cols], F.lit(str(seed)))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(v))


def vfold(df: DataFrame, v: int = 10, seed: int = 123, cols: Sequence[str] = ("id", "k")) -> DataFrame:
    return df.withColumn("fold", hash_bucket(cols, seed, v))
