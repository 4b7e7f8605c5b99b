"""Time-aware verbs: summarise, pad, filter, extend and describe panels."""

from __future__ import annotations

import calendar
import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.core import (CHUNK, Step, chunk_of, col, epoch_day, epoch_second, exact_quantiles, parse_step, step_index,
                            step_start)


def summarise_by_time(df: DataFrame, by: str | Step, *, keys: Sequence[str] = ("id",), ts: str = "ts",
                      **aggs: Column) -> DataFrame:
    """Floor ``ts`` to ``by`` and aggregate.  Partial sums run before the one shuffle on (id, k)."""
    g = df.groupBy(*keys, step_index(ts, by).alias("k")).agg(*[c.alias(n) for n, c in aggs.items()])
    return g.select(*keys, "k", step_start("k", by).alias("ts"), *aggs)


def grid(bounds: DataFrame, by: str | Step, *, keys: Sequence[str] = ("id",), size: int = CHUNK) -> DataFrame:
    """All cells between ``_lo`` and ``_hi`` per key, made chunk by chunk."""
    b = bounds.withColumn("_c", F.explode(F.sequence(chunk_of("_lo", size), chunk_of("_hi", size))))
    first = F.greatest(F.col("_lo"), F.col("_c") * size)
    last = F.least(F.col("_hi"), F.col("_c") * size + size - 1)
    return b.select(*keys, F.explode(F.sequence(first, last)).alias("k"))


def pad_by_time(df: DataFrame, by: str | Step, *, keys: Sequence[str] = ("id",),
                fill: dict[str, float] | None = None, start: str | None = None,
                end: str | None = None) -> DataFrame:
    """Insert the missing cells of every series.  Only inserted rows take ``fill`` (else NULL)."""
    lo, hi = F.min("k"), F.max("k")
    if start:
        lo = F.least(lo, step_index(F.lit(start).cast("timestamp_ntz"), by))
    if end:
        hi = F.greatest(hi, step_index(F.lit(end).cast("timestamp_ntz"), by))
    bounds = df.groupBy(*keys).agg(lo.alias("_lo"), hi.alias("_hi"))
    values = [c for c in df.columns if c not in (*keys, "k", "ts")]
    j = grid(bounds, by, keys=keys).join(df.withColumn("_there", F.lit(True)), [*keys, "k"], "left")
    filled = [F.when(F.col("_there"), F.col(c)).otherwise(F.lit(fill[c])).alias(c)
              if fill and c in fill else F.col(c) for c in values]
    return j.select(*keys, "k", step_start("k", by).alias("ts"), *filled)


def expand_date(text: str, end: bool = False) -> dt.datetime:
    """``"2019"``, ``"2019-12"``, ``"2019-12-05"`` -> first (or last) instant it names."""
    m = re.fullmatch(r"(\d{4})(?:-(\d{1,2})(?:-(\d{1,2}))?)?", text.strip())
    if not m:
        return dt.datetime.fromisoformat(text)
    y, mo, d = (int(g) if g else None for g in m.groups())
    if not end:
        return dt.datetime(y, mo or 1, d or 1)
    mo = mo or 12
    d = d or calendar.monthrange(y, mo)[1]
    return dt.datetime(y, mo, d, 23, 59, 59, 999999)


def plus_time(text: str, interval: str) -> dt.datetime:
    """Date plus a duration, month ends clamped."""
    t, s = expand_date(text), parse_step(interval)
    if s.months:
        y, mo = divmod(t.year * 12 + t.month - 1 + s.months, 12)
        return t.replace(year=y, month=mo + 1, day=min(t.day, calendar.monthrange(y, mo + 1)[1]))
    return t + dt.timedelta(seconds=s.seconds)


def between_time(ts: str | Column, start: str | dt.datetime | None = None,
                 end: str | dt.datetime | None = None) -> Column:
    """Inclusive range with literal ends, so the predicate reaches the file scan."""
    c, p = col(ts), F.lit(True)
    lo = expand_date(start) if isinstance(start, str) else start
    hi = expand_date(end, end=True) if isinstance(end, str) else end
    if lo is not None:
        p = c >= F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz")
    if hi is not None:
        upper = c <= F.lit(hi.isoformat(sep=" ")).cast("timestamp_ntz")
        p = upper if lo is None else p & upper
    return p


def filter_by_time(df: DataFrame, start=None, end=None, ts: str = "ts") -> DataFrame:
    return df.where(between_time(ts, start, end))


def mutate_by_time(df: DataFrame, by: str | Step, *, keys: Sequence[str] = ("id",), ts: str = "ts",
                   **aggs: Column) -> DataFrame:
    """Keep every row and add its period's aggregates (aggregate + join, no wide window)."""
    d = df.withColumn("_p", step_index(ts, by))
    a = d.groupBy(*keys, "_p").agg(*[c.alias(n) for n, c in aggs.items()])
    return d.join(a, [*keys, "_p"]).drop("_p")


def spread_to_finer(df: DataFrame, y: str, coarse: str | Step, fine: str | Step, *,
                    keys: Sequence[str] = ("id",)) -> DataFrame:
    """Un-aggregate: spread each coarse cell's total evenly over its fine cells up to the last one."""
    c, f = parse_step(coarse), parse_step(fine)
    last = df.groupBy(*keys).agg(F.max("k").alias("_last"))
    first_fine = step_index("ts", f)
    next_fine = step_index(step_start(F.col("k") + 1, c), f)
    whole = next_fine - first_fine
    cells = (df.join(last, list(keys))
               .withColumn("_n", whole)
               .withColumn("_f", F.explode(F.sequence(
                   first_fine, F.when(F.col("k") == F.col("_last"), first_fine).otherwise(next_fine - 1)))))
    return cells.select(*keys, F.col("_f").alias("k"), step_start("_f", f).alias("ts"),
                        (F.col(y) / F.col("_n")).alias(y))


def horizon_cells(length_out: int | str, by: str | Step) -> int:
    """Number of steps in ``length_out`` (a count or an interval such as ``"8 weeks"``)."""
    if isinstance(length_out, int):
        return length_out
    want, s = parse_step(length_out), parse_step(by)
    if want.months and s.months:
        return want.months // s.months
    if want.months:  # average month, as in calendar-free step counts
        return round(want.months * 30.4375 * 86400 / s.seconds)
    if s.months:
        return round(want.seconds / (s.months * 30.4375 * 86400))
    return want.seconds // s.seconds


def infer_steps(df: DataFrame, *, keys: Sequence[str] = ("id",), ts: str = "ts") -> DataFrame:
    """``keys, last_ts, months, seconds, month_end, n_steps``: the commonest step between neighbouring stamps of each key.

    A step is a number of months where day of month and time of day stay (or both stamps end their months), else seconds; the other
    field is 0.  Ties go to the shorter step, repeated stamps count once, and keys without two different stamps have NULL steps.
    """
    d = df.where(F.col(ts).isNotNull()).select(*keys, F.col(ts).cast("timestamp_ntz").alias("ts"))
    facts = d.groupBy(*keys).agg(F.max("ts").alias("last_ts"), F.min((F.last_day("ts") == F.to_date("ts")).cast("int")).alias("_ends"))
    sec = epoch_second("ts")
    d = _with_previous(d.select(*keys, "ts", sec.alias("k"), sec.alias("_s")), keys).withColumn("_gap", F.col("_s") - F.col("_ps")).where("_gap > 0")
    before = step_start("_ps", "second")
    ends = lambda c: F.last_day(c) == F.to_date(c)
    whole = (F.pmod("_gap", F.lit(86400)) == 0) & ((F.dayofmonth("ts") == F.dayofmonth(before)) | (ends(F.col("ts")) & ends(before)))
    months = F.when(whole, step_index("ts", "month") - step_index(before, "month")).otherwise(F.lit(0)).cast("int")
    n = d.groupBy(*keys, months.alias("months"), F.when(months > 0, 0).otherwise(F.col("_gap")).alias("seconds")).agg(F.count(F.lit(1)).alias("n_steps"))
    size = F.col("months") * F.lit(30.4375 * 86400) + F.col("seconds")
    top = n.groupBy(*keys).agg(F.max(F.struct("n_steps", (-size).alias("_o"), "months", "seconds")).alias("_t"))
    return facts.join(top, list(keys), "left").select(*keys, "last_ts", "_t.months", "_t.seconds", ((F.col("_ends") == 1) & (F.col("_t.months") > 0)).alias("month_end"), "_t.n_steps")


def _cells(length_out: int | str) -> Column:
    """``horizon_cells`` as a column over ``months, seconds`` of each key's own step."""
    if isinstance(length_out, int):
        return F.lit(length_out)
    want, month = parse_step(length_out), 30.4375 * 86400
    if want.months:
        return F.when(F.col("months") > 0, F.floor(want.months / F.col("months"))).otherwise(F.round(want.months * month / F.col("seconds")))
    return F.when(F.col("months") > 0, F.round(want.seconds / (F.col("months") * month))).otherwise(F.floor(want.seconds / F.col("seconds")))


def future_frame(df: DataFrame, by: str | Step | None, length_out: int | str, *, keys: Sequence[str] = ("id",),
                 bind: bool = False, ts: str = "ts") -> DataFrame:
    """The next cells of every series; other columns are NULL when bound to the data.

    Without ``by`` every key goes on in its own commonest step, months as months: ``keys, ts, h`` for hourly, daily and
    monthly series in one plan.  ``length_out`` is a count or a span (each key gets the cells its step has in it).  Keys whose step
    is unknown (fewer than two stamps) get no future cells.
    """
    if by is None:
        n = _cells(length_out).cast("int")
        d = infer_steps(df, keys=keys, ts=ts).where(F.col("n_steps").isNotNull() & (n > 0)).withColumn("h", F.explode(F.sequence(F.lit(1), n)))
        day = F.add_months(F.to_date("last_ts"), F.col("h") * F.col("months"))
        day = F.when(F.col("month_end"), F.last_day(day)).otherwise(day)
        clock = epoch_second("last_ts") - epoch_day("last_ts") * 86400
        at = F.when(F.col("months") > 0, epoch_day(day) * 86400 + clock).otherwise(epoch_second("last_ts") + F.col("h") * F.col("seconds"))
        out = d.select(*keys, step_start(at.cast("bigint"), "second").alias(ts), "h")
        return df.unionByName(out.drop("h"), allowMissingColumns=True) if bind else out
    h = horizon_cells(length_out, by)
    last = df.groupBy(*keys).agg(F.max("k").alias("_k"))
    out = (last.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(h))))
               .select(*keys, (F.col("_k") + F.col("h")).alias("k"), "h")
               .withColumn("ts", step_start("k", by)))
    return df.unionByName(out.drop("h"), allowMissingColumns=True) if bind else out


def summary_diagnostics(df: DataFrame, by: str | Step, *, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Per id: count, first and last stamp, and min/quartiles/mean/max of the step in seconds.

    Works on sparse panels: the previous stamp comes from the chunk summary, not a full sort.
    """
    sec = epoch_second("ts")
    n = _with_previous(df.select(*keys, "k", "ts", sec.alias("_s")), keys)
    gap = n.withColumn("gap", (F.col("_s") - F.col("_ps")).cast("double"))
    base = gap.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_obs"), F.min("ts").alias("start"), F.max("ts").alias("end"),
        F.min("gap").alias("diff_min"), F.avg("gap").alias("diff_mean"), F.max("gap").alias("diff_max"))
    q = exact_quantiles(gap, "gap", {"diff_q1": .25, "diff_median": .5, "diff_q3": .75}, keys=keys)
    return base.join(q, list(keys), "left")


def _with_previous(d: DataFrame, keys: Sequence[str]) -> DataFrame:
    c = d.withColumn("_chunk", chunk_of("k"))
    top = c.groupBy(*keys, "_chunk").agg(F.max("_s").alias("_m"))
    w = Window.partitionBy(*keys).orderBy("_chunk")
    top = top.select(*keys, "_chunk", F.lag("_m").over(w).alias("_before"))
    inner = Window.partitionBy(*keys, "_chunk").orderBy("k")
    return (c.join(top, [*keys, "_chunk"])
             .withColumn("_ps", F.coalesce(F.lag("_s").over(inner), F.col("_before"))))


def missing_profile(df: DataFrame, what: Sequence[str] | None = None) -> DataFrame:
    """One pass: rows and NULLs per column, long form."""
    cols = list(what or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    return (one.unpivot(["_n"], cols, "column", "n_missing")
               .select("column", "n_missing", F.col("_n").alias("n"),
                       (F.col("n_missing") / F.col("_n")).alias("pct_missing")))
