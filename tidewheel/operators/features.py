"""Calendar, Fourier, spline, interaction and event features as built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.core import col, epoch_second

# English labels of weekdays (Sunday first) and months.
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September",
          "October", "November", "December")


def signature(ts: str | Column = "ts") -> dict[str, Column]:
    """Calendar parts of a time stamp; week numbers count 7-day blocks from 1 January."""
    c = col(ts)
    yday, mday, wday = F.dayofyear(c), F.dayofmonth(c), F.dayofweek(c)
    week = F.floor((yday - 1) / 7).cast("int") + 1
    hour = F.hour(c)
    label = lambda names, i: F.element_at(F.array(*[F.lit(n) for n in names]), i)
    return {
        "index_num": epoch_second(c), "year": F.year(c), "year_iso": F.extract(F.lit("YEAROFWEEK"), c),
        "half": F.when(F.month(c) <= 6, 1).otherwise(2), "quarter": F.quarter(c), "month": F.month(c),
        "month_lbl": label(MONTHS, F.month(c)), "day": mday, "hour": hour, "minute": F.minute(c),
        "second": F.second(c), "hour12": F.pmod(hour, F.lit(12)), "am_pm": F.when(hour < 12, 1).otherwise(2),
        "wday": wday, "wday_lbl": label(WEEKDAYS, wday), "mday": mday,
        "qday": F.datediff(F.to_date(c), F.trunc(F.to_date(c), "quarter")) + 1, "yday": yday,
        "mweek": F.floor((mday - 1) / 7).cast("int") + 1, "week": week, "week_iso": F.weekofyear(c),
        "week2": F.pmod(week, F.lit(2)), "week3": F.pmod(week, F.lit(3)), "week4": F.pmod(week, F.lit(4)),
        "mday7": F.floor((mday - 1) / 7).cast("int") + 1,
    }


def augment_signature(df: DataFrame, ts: str = "ts", parts: Sequence[str] | None = None) -> DataFrame:
    s = signature(ts)
    return df.withColumns({n: s[n] for n in (parts or s)})


def fourier(period: float, order: int, kind: str = "sin", t: str | Column = "k") -> Column:
    angle = col(t) * (2 * pi * order / period)
    return F.sin(angle) if kind == "sin" else F.cos(angle)


def fourier_terms(periods: Sequence[float], order: int, t: str | Column = "k") -> dict[str, Column]:
    return {f"{kind}{p:g}_k{j}".replace(".", "_"): fourier(p, j, kind, t)
            for p in periods for j in range(1, order + 1) for kind in ("sin", "cos")}


def unit_range(x: str | Column, lo: str | Column, hi: str | Column) -> Column:
    return F.try_divide(col(x) - col(lo), col(hi) - col(lo))


def b_spline(x: Column, knots: Sequence[Column | float] = (), degree: int = 3) -> list[Column]:
    """B-spline basis without the intercept column, ``x`` scaled to [0, 1]."""
    inner = [k if isinstance(k, Column) else F.lit(float(k)) for k in knots]
    t = [F.lit(0.0)] * (degree + 1) + inner + [F.lit(1.0)] * (degree + 1)
    first, last = degree, degree + len(inner)

    def basis(i: int, d: int) -> Column | None:
        if d == 0:
            if i < first or i > last:
                return None
            upper = x <= t[i + 1] if i == last else x < t[i + 1]
            return F.when((x >= t[i]) & upper, 1.0).otherwise(0.0)
        parts = []
        left, right = basis(i, d - 1), basis(i + 1, d - 1)
        if left is not None:
            parts.append((x - t[i]) / (t[i + d] - t[i]) * left)
        if right is not None:
            parts.append((t[i + d + 1] - x) / (t[i + d + 1] - t[i + 1]) * right)
        return sum(parts[1:], parts[0]) if parts else None

    return [basis(i, degree) for i in range(1, degree + 1 + len(inner))]


def natural_spline(x: Column, knots: Sequence[Column | float]) -> list[Column]:
    """Natural cubic spline basis with inner ``knots`` and boundaries 0 and 1 (``x`` in [0, 1])."""
    xi = [F.lit(0.0), *[k if isinstance(k, Column) else F.lit(float(k)) for k in knots], F.lit(1.0)]
    cube = lambda v: F.when(v > 0, v * v * v).otherwise(0.0)
    d = lambda j: (cube(x - xi[j]) - cube(x - xi[-1])) / (xi[-1] - xi[j])
    return [x, *[d(j) - d(len(xi) - 2) for j in range(len(xi) - 2)]]


def interaction(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    return {f"{n}_x_{m}": x * y for n, x in a.items() for m, y in b.items()}


def dummies(c: str, levels: Sequence, prefix: str | None = None) -> dict[str, Column]:
    """0/1 column per level; levels are given (calendar parts) or learned by a recipe."""
    return {f"{prefix or c}_{v}": F.when(F.col(c) == v, 1.0).otherwise(0.0) for v in levels}


def join_events(df: DataFrame, events: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Left join a calendar; cells without an event count 0."""
    return df.join(events, list(on), "left").withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})
