"""Panel model: rows keyed by ``(id, ts)`` on a regular grid, numbered by ``k``.

``k`` is plain arithmetic on the time stamp (days since the epoch, months since year 0 ...), so
positions need no sort and no window over a whole series.  Everything that looks along a series
works on *chunks* of ``CHUNK`` grid steps: ``with_halo`` sends each row to its own chunk and copies
the few rows near a border to the neighbour, so bounded windows stay exact while no task ever holds
a whole series.  Unbounded looks (fill, running position) go through one summary row per chunk.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 1 << 16

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}
_MONTHS = {"month": 1, "quarter": 3, "year": 12}
_EPOCH = dt.date(1970, 1, 1)


@dataclass(frozen=True)
class Step:
    """A calendar step: either a number of seconds or a number of months."""

    seconds: int = 0
    months: int = 0
    weekly: bool = False

    def __mul__(self, n: int) -> Step:
        return Step(self.seconds * n, self.months * n, self.weekly)

    def sql_interval(self) -> str:
        return f"INTERVAL {self.months} MONTH" if self.months else f"INTERVAL {self.seconds} SECOND"


def parse_step(text: str | Step) -> Step:
    """``"day"``, ``"2 weeks"``, ``"3 months"`` -> :class:`Step`."""
    if isinstance(text, Step):
        return text
    m = re.fullmatch(r"\s*(\d+)?\s*([a-z]+?)s?\s*", text.lower())
    n, unit = (int(m.group(1) or 1), m.group(2)) if m else (0, "")
    if unit in _SECONDS:
        return Step(seconds=n * _SECONDS[unit], weekly=unit == "week")
    if unit in _MONTHS:
        return Step(months=n * _MONTHS[unit])
    raise ValueError(f"not an interval: {text!r}")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_day(ts: str | Column) -> Column:
    return F.datediff(F.to_date(col(ts)), F.lit(_EPOCH)).cast("bigint")


def epoch_second(ts: str | Column) -> Column:
    """Wall-clock seconds since 1970, independent of the session time zone."""
    c = col(ts)
    return epoch_day(c) * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def step_index(ts: str | Column, step: str | Step) -> Column:
    """Number of the grid cell that holds ``ts``.  Weeks start on Sunday."""
    s = parse_step(step)
    c = col(ts)
    if s.months:
        month = F.year(c).cast("bigint") * 12 + F.month(c) - 1
        return month if s.months == 1 else F.floor(month / s.months)
    if s.seconds % 86400:
        return F.floor(epoch_second(c) / s.seconds)
    days = s.seconds // 86400
    shifted = epoch_day(c) + (4 if s.weekly else 0)
    return shifted if days == 1 else F.floor(shifted / days)


def step_start(k: str | Column, step: str | Step) -> Column:
    """First instant of grid cell ``k`` as ``timestamp_ntz``; inverse of :func:`step_index`."""
    s = parse_step(step)
    c = col(k)
    if s.months:
        month = c * s.months
        return F.make_date(F.floor(month / 12).cast("int"), (F.pmod(month, F.lit(12)) + 1).cast("int"),
                           F.lit(1)).cast("timestamp_ntz")
    if s.seconds % 86400 == 0:
        days = c * (s.seconds // 86400) - (4 if s.weekly else 0)
        return F.date_add(F.lit(_EPOCH), days.cast("int")).cast("timestamp_ntz")
    sec = c * s.seconds
    day = F.floor(sec / 86400)
    return F.date_add(F.lit(_EPOCH), day.cast("int")).cast("timestamp_ntz") + F.make_dt_interval(
        secs=(sec - day * 86400).cast("decimal(18,6)"))


def floor_time(ts: str | Column, step: str | Step) -> Column:
    return step_start(step_index(ts, step), step)


def as_panel(df: DataFrame, step: str | Step, *, id: str | Column = "id", ts: str = "ts",
             **values: str | Column) -> DataFrame:
    """Rename to the canonical columns ``id, k, ts, <values>``."""
    k = step_index(ts, step)
    return df.select(col(id).alias("id"), k.alias("k"), col(ts).cast("timestamp_ntz").alias("ts"),
                     *[col(c).alias(name) for name, c in values.items()])


# ------------------------------------------------------------------ chunks

def chunk_of(k: str | Column = "k", size: int = CHUNK) -> Column:
    return F.floor(col(k) / size)


def with_halo(df: DataFrame, before: int, after: int = 0, *, pos: str = "k",
              size: int = CHUNK) -> DataFrame:
    """Add ``_chunk`` and ``_own``; copy rows near a border to the chunks that look at them."""
    own = chunk_of(pos, size)
    if before == 0 and after == 0:
        return df.withColumn("_chunk", own).withColumn("_own", F.lit(True))
    targets = F.sequence(F.floor((F.col(pos) - after) / size), F.floor((F.col(pos) + before) / size))
    return (df.withColumn("_chunk", F.explode(targets))
              .withColumn("_own", F.col("_chunk") == own))


def halo_select(df: DataFrame, build, before: int, after: int = 0, *, keys: Sequence[str] = ("id",),
                pos: str = "k", size: int = CHUNK) -> DataFrame:
    """Add the columns of ``build(window) -> {name: Column}``, all over one chunk window (one sort)."""
    h = with_halo(df, before, after, pos=pos, size=size)
    w = Window.partitionBy(*keys, "_chunk").orderBy(pos)
    return h.withColumns(build(w)).where("_own").drop("_chunk", "_own")


def at_lag(y: str | Column, k: int, w) -> Column:
    """Value exactly ``k`` positions back (ahead if negative) in a window ordered by position: NULL over a gap, whatever the chunks."""
    return F.first(col(y)).over(w.rangeBetween(-k, -k)) if k else col(y)


def with_position(df: DataFrame, order: str = "ts", *, keys: Sequence[str] = ("id",), step="day",
                  name: str = "k", tie: Sequence[str] = (), size: int = 1 << 10) -> DataFrame:
    """Exact 1-based row number per key without a window over the whole key.

    Rows are numbered inside time chunks; the running total of earlier chunks is added.
    """
    d = df.withColumn("_chunk", F.floor(step_index(order, step) / size))
    counts = d.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    w = Window.partitionBy(*keys, "_chunk").orderBy(order, *tie)
    return (d.join(offsets, [*keys, "_chunk"])
             .withColumn(name, F.row_number().over(w) + F.col("_off")).drop("_chunk", "_off"))


def with_neighbours(df: DataFrame, value: str, *, keys: Sequence[str] = ("id",), pos: str = "k",
                    size: int = CHUNK) -> DataFrame:
    """Add ``_prev`` and ``_next``: struct(pos, value) of the nearest known row on either side.

    Gaps may span chunks: one summary row per chunk carries the last/first known value across.
    """
    d = df.withColumn("_chunk", chunk_of(pos, size))
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(pos).alias("k"), F.col(value).alias("y")))
    summary = d.groupBy(*keys, "_chunk").agg(F.max(known).alias("_hi"), F.min(known).alias("_lo"))
    # Looking ahead is looking back in descending order: frames that end with the partition cost a square.
    over, later = (Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in ("_chunk", F.desc("_chunk")))
    summary = summary.select(*keys, "_chunk", F.last("_hi", True).over(over).alias("_carry_hi"),
                             F.last("_lo", True).over(later).alias("_carry_lo"))
    inner = Window.partitionBy(*keys, "_chunk")
    back, ahead = (inner.orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (pos, F.desc(pos)))
    return (d.join(summary, [*keys, "_chunk"])
             .withColumn("_prev", F.coalesce(F.last(known, True).over(back), F.col("_carry_hi")))
             .withColumn("_next", F.coalesce(F.last(known, True).over(ahead), F.col("_carry_lo")))
             .drop("_chunk", "_carry_hi", "_carry_lo"))


# ------------------------------------------------------------------ per-key parameters

def join_params(df: DataFrame, params: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Attach per-key parameters.  No hint: the runtime plan broadcasts them when they are small
    and splits the hot key of a shuffled join when they are not."""
    return df.join(params, list(keys))


# ------------------------------------------------------------------ order by value

def value_bins(df: DataFrame, value: str, *, keys: Sequence[str] = ("id",), sub: Column | None = None, rows: int = CHUNK,
               most: int = 4096) -> DataFrame:
    """Add ``_bin, _sub``: rows of a key ordered by ``value`` are ordered by (``_bin``, ``_sub``) first.

    Bins hold about ``rows`` rows of the largest key (a bounded sketch cuts them).  A value that fills whole bins by itself is
    split further by ``sub`` (chunk of ``k`` by default), which must follow the wanted order of ties.  ``value`` is never NULL here;
    ``df`` is read three times, so its lineage should be short.
    """
    keys = list(keys)
    largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    n = min(most, max(1, largest // rows))
    q = df.groupBy(*keys).agg(F.percentile_approx(value, [i / (n + 1) for i in range(1, n + 1)], max(1000, 8 * n)).alias("_q"))
    v, cuts = F.col(value), F.col("_q")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])
    below = F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(cuts, at + s - 1) < v, at + s).otherwise(at))
    heavy = (F.get(cuts, F.col("_bin")) == v) & (F.get(cuts, F.col("_bin") + 1) == v)
    split = F.when(heavy, chunk_of("k") if sub is None else sub).otherwise(F.lit(-(1 << 62))).cast("bigint")
    return join_params(df, q, keys).withColumn("_bin", below).withColumn("_sub", split).drop("_q")


def running(df: DataFrame, value: str, *, rank: str, sums: dict[str, Column] | None = None, keys: Sequence[str] = ("id",),
            rows: int = CHUNK) -> DataFrame:
    """``df`` with the 1-based ``rank`` by (``value``, ``k``) per key and exclusive running ``sums``; no task holds one key.

    Ranks and sums inside a bin come from a window, those of the bins before from one summary row each.
    """
    keys, sums = list(keys), sums or {}
    d = value_bins(df, value, keys=keys, rows=rows)
    place = [*keys, "_bin", "_sub"]
    per = d.groupBy(*place).agg(F.count(F.lit(1)).alias("_before"), *[F.sum(c).alias(f"_before_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*keys).orderBy("_bin", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    off = per.select(*place, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("_before", *[f"_before_{n}" for n in sums])])
    w = Window.partitionBy(*place).orderBy(value, "k")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    return (d.join(off, place)
             .withColumns({rank: F.row_number().over(w) + F.col("_before"),
                           **{n: F.coalesce(F.sum(c).over(past), F.lit(0.0)) + F.col(f"_before_{n}") for n, c in sums.items()}})
             .drop("_bin", "_sub", "_before", *[f"_before_{n}" for n in sums]))


# ------------------------------------------------------------------ exact order statistics

def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], *,
                    keys: Sequence[str] = (), accuracy: int = 10000,
                    kind: str = "linear") -> DataFrame:
    """Exact quantiles per key, one column per entry of ``probs``.

    ``kind="linear"`` interpolates at rank ``(n - 1) p``; ``"conformal"`` takes the value of rank
    ``min(n, ceil((n + 1) p))``.

    A bounded sketch brackets each wanted rank; one more pass counts the rows below the bracket and
    keeps only the distinct values inside it.  No task ever holds the values of one key.
    """
    if not keys:  # one group: its single summary row is broadcast
        return exact_quantiles(df.withColumn("_all", F.lit(0)), value, probs, keys=["_all"],
                               accuracy=accuracy, kind=kind).drop("_all")
    keys = list(keys)
    names = list(probs)
    eps = 4.0 / accuracy
    cuts = [min(1.0, max(0.0, p + s * eps)) for p in probs.values() for s in (-1, 1)]
    d = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    sketch = d.groupBy(*keys).agg(F.percentile_approx("_v", cuts, accuracy).alias("_q"),
                                  F.count(F.lit(1)).alias("_n"))
    j = d.join(F.broadcast(sketch) if keys == ["_all"] else sketch, keys)
    inside, below = [], []
    for i, name in enumerate(names):
        lo, hi = F.col("_q")[2 * i], F.col("_q")[2 * i + 1]
        inside.append(F.when((F.col("_v") >= lo) & (F.col("_v") <= hi), F.lit(i)))
        below.append(F.struct(F.lit(i).alias("i"),
                              F.count(F.when(F.col("_v") < lo, 1)).alias("nb"),
                              F.max(F.when(F.col("_v") < lo, F.col("_v"))).alias("vb"),
                              F.min(F.when(F.col("_v") > hi, F.col("_v"))).alias("va")))
    edge = (j.groupBy(*keys, "_n").agg(F.array(*below).alias("_e"))
             .select(*keys, "_n", F.inline("_e")))
    inner = (j.select(*keys, "_v", F.explode(F.array_compact(F.array(*inside))).alias("i"))
              .groupBy(*keys, "i", "_v").agg(F.count(F.lit(1)).alias("_c")))
    run = Window.partitionBy(*keys, "i").orderBy("_v")
    ranked = inner.withColumn("_hi", F.sum("_c").over(run))
    p = F.element_at(F.array(*[F.lit(float(x)) for x in probs.values()]), F.col("i") + 1)
    # Multiplying by counts first keeps ranks such as 0.1 * 30 whole.
    if kind == "linear":
        h = F.round((F.col("_n") - 1) * p, 9)
    else:
        h = F.least(F.col("_n"), F.ceil(F.round((F.col("_n") + 1) * p, 9))) - 1
    want = edge.withColumn("_r", F.floor(h) + 1).withColumn("_f", h - F.floor(h))
    m = want.join(ranked, [*keys, "i"])
    lo_rank, hi_rank = F.col("_hi") - F.col("_c") + F.col("nb") + 1, F.col("_hi") + F.col("nb")

    def at(rank: Column) -> Column:
        inside = F.max(F.when((rank >= lo_rank) & (rank <= hi_rank), F.col("_v")))
        just_below = F.max(F.when(rank == F.col("nb"), F.col("vb")))
        just_above = F.when(F.max(rank) == F.max(hi_rank) + 1, F.max("va"))
        return F.coalesce(inside, just_below, just_above)

    nxt = F.col("_r") + F.when(F.col("_f") > 0, 1).otherwise(0)
    got = m.groupBy(*keys, "i").agg(F.max("_f").alias("_f"), at(F.col("_r")).alias("_a"), at(nxt).alias("_b"))
    got = got.withColumn("_x", F.coalesce(
        F.col("_a") + F.col("_f") * (F.col("_b") - F.col("_a")),
        F.raise_error(F.lit("a quantile rank fell outside its bracket")).cast("double")))
    return got.groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, F.col("_x"))).alias(n)
                                    for i, n in enumerate(names)])
