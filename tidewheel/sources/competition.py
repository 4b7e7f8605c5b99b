"""Layouts used by forecasting competitions: positional wide matrices and lead-time forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.core import col, step_index


def wide_to_long(df: DataFrame, id_col: str = "V1", prefix: str = "V") -> DataFrame:
    """``V1, V2 .. Vn`` -> ``id, date, value``; position 1 is the first value, NULLs dropped."""
    values = [c for c in df.columns if c != id_col]
    return (df.unpivot([id_col], values, "name", "value").where(F.col("value").isNotNull())
              .select(F.col(id_col).alias("id"),
                      (F.replace("name", F.lit(prefix), F.lit("")).cast("bigint") - 1).alias("date"),
                      "value"))


def repair_two_digit_year(d: str | Column, last: str = "2019-12-31") -> Column:
    """Dates after ``last`` belong to the century before."""
    c = col(d)
    return F.when(c > F.lit(last).cast("timestamp_ntz"), c - F.make_interval(years=F.lit(100))).otherwise(c)


def sample_per_stratum(df: DataFrame, stratum: str, id_col: str, n: int, seed: int) -> DataFrame:
    """Seeded sample of ``n`` rows per stratum, the same rows on every run."""
    order = F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))
    w = Window.partitionBy(stratum).orderBy(order, id_col)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def continue_index(df: DataFrame) -> DataFrame:
    """Shift the positions of ``type = 'test'`` rows behind the train rows of the same id."""
    n = df.where(F.col("type") == "train").groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    return (df.join(n, "id", "left")
              .withColumn("date", F.when(F.col("type") == "test", F.col("date") + F.col("_n"))
                                   .otherwise(F.col("date"))).drop("_n"))


def calendar_offset(start: str | Column, period: str | Column, date: str | Column) -> Column:
    """Time stamp of 1-based position ``date`` in a series of frequency ``period``.

    Month-based steps clamp to the month end; so do years (29 Feb -> 28 Feb).
    """
    c, p, n = col(start), col(period), (col(date) - 1).cast("int")
    return (F.when(p == "Hourly", c + F.make_interval(hours=n))
             .when(p == "Daily", c + F.make_interval(days=n))
             .when(p == "Weekly", c + F.make_interval(weeks=n))
             .when(p == "Monthly", c + F.make_interval(months=n))
             .when(p == "Quarterly", c + F.make_interval(months=n * 3))
             .when(p == "Yearly", c + F.make_interval(months=n * 12)))


def lead_time_join(power: DataFrame, issued: DataFrame, origin: str | Column | None = None,
                   keys: Sequence[str] = ("id",)) -> DataFrame:
    """Join measurements to forecasts issued at ``issue`` for ``issue + hors`` hours.

    Only issues at or before ``origin`` count (default: any issue before the valid time);
    the latest one wins.
    """
    f = issued.withColumn("ts", F.col("issue") + F.make_interval(hours=F.col("hors").cast("int")))
    bound = col(origin) if isinstance(origin, Column) else (
        F.lit(origin).cast("timestamp_ntz") if origin else F.col("ts"))
    values = [c for c in f.columns if c not in (*keys, "ts")]
    latest = (f.where(F.col("issue") <= bound).groupBy(*keys, "ts")
               .agg(F.max(F.struct("issue", *[c for c in values if c != "issue"])).alias("_f")))
    return power.join(latest, [*keys, "ts"], "left").select(*power.columns, "_f.*")


def hold_out_mask(ts: str | Column, first: str, blocks: Sequence[tuple[int, int]],
                  every_hours: int = 168) -> Column:
    """``test`` inside the repeating blocks ``(first hour, last hour)`` after ``first``, else ``train``."""
    c, t0 = col(ts), F.lit(first).cast("timestamp_ntz")
    hours = step_index(c, "hour") - step_index(t0, "hour")
    phase = F.pmod(hours, F.lit(every_hours))
    inside = F.lit(False)
    for lo, hi in blocks:
        inside = inside | phase.between(lo, hi)
    return F.when((hours >= 0) & inside, "test").otherwise("train")
