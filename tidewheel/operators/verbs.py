"""Column and row verbs, joins, reshaping, top-k: thin names over the DataFrame API."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# ------------------------------------------------------------------ choosing columns

def starts_with(prefix: str) -> Callable[[list[str]], list[str]]:
    return lambda cols: [c for c in cols if c.startswith(prefix)]


def ends_with(suffix: str) -> Callable[[list[str]], list[str]]:
    return lambda cols: [c for c in cols if c.endswith(suffix)]


def contains(text: str) -> Callable[[list[str]], list[str]]:
    return lambda cols: [c for c in cols if text in c]


def matches(regex: str) -> Callable[[list[str]], list[str]]:
    return lambda cols: [c for c in cols if re.search(regex, c)]


def col_range(first: str, last: str) -> Callable[[list[str]], list[str]]:
    return lambda cols: cols[cols.index(first):cols.index(last) + 1]


def pick(df: DataFrame, *what) -> list[str]:
    out: list[str] = []
    for w in what:
        out += [c for c in ([w] if isinstance(w, str) else w(df.columns)) if c not in out]
    return out


def select(df: DataFrame, *what) -> DataFrame:
    return df.select(*pick(df, *what))


def drop(df: DataFrame, *what) -> DataFrame:
    return df.drop(*pick(df, *what))


def across(df: DataFrame, what, fn: Callable[[Column], Column], names: str = "{}") -> DataFrame:
    """Apply ``fn`` to every chosen column in one projection."""
    return df.withColumns({names.format(c): fn(F.col(c)) for c in pick(df, what)})


def rename_with(df: DataFrame, what, fn: Callable[[str], str]) -> DataFrame:
    return df.withColumnsRenamed({c: fn(c) for c in pick(df, what)})


def to_forecast(df: DataFrame, y: str = "y") -> DataFrame:
    """Rows whose target is still unknown."""
    return df.where(F.col(y).isNull())


# ------------------------------------------------------------------ joins

def natural_join(a: DataFrame, b: DataFrame, how: str = "left") -> DataFrame:
    return a.join(b, sorted(set(a.columns) & set(b.columns)), how)


def keep_ids(df: DataFrame, ids: DataFrame, on: Sequence[str] = ("id",)) -> DataFrame:
    """``id %in% ids`` with the list as a one-column frame: nothing is collected."""
    return df.join(ids.select(*on), list(on), "left_semi")


def bind_cols(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Column bind by key: rows of distributed frames have no position to bind on."""
    return a.join(b, list(on))


# ------------------------------------------------------------------ ranking and slices

def slice_ranked(df: DataFrame, metric: str, n: int = 1, *, largest: bool = False,
                 by: Sequence[str] = ()) -> DataFrame:
    """Best ``n`` rows per group, ties kept.  Runs on metric tables (one row per model and id)."""
    order = F.desc_nulls_last(metric) if largest else F.asc_nulls_last(metric)
    w = Window.partitionBy(*by).orderBy(order)
    return df.withColumn("_r", F.rank().over(w)).where(F.col("_r") <= n).drop("_r")


def slice_head(df: DataFrame, n: int, *, order: Sequence, by: Sequence[str] = ("id",)) -> DataFrame:
    """First ``n`` rows per group; the rank limit is applied before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def slice_tail(df: DataFrame, n: int, *, order: str = "k", by: Sequence[str] = ("id",)) -> DataFrame:
    return slice_head(df, n, order=[F.desc(order)], by=by)


def slice_rows(df: DataFrame, first: int, last: int, *, pos: str) -> DataFrame:
    """Rows ``first..last`` by a position column (see ``core.with_position``)."""
    return df.where(F.col(pos).between(first, last))


def slice_drop(df: DataFrame, *rows: int, pos: str) -> DataFrame:
    return df.where(~F.col(pos).isin(*rows))


def split_by_target(df: DataFrame, y: str = "y") -> tuple[DataFrame, DataFrame]:
    """(rows to learn from, rows to forecast) by the target, not by counting rows."""
    return df.where(F.col(y).isNotNull()), df.where(F.col(y).isNull())


# ------------------------------------------------------------------ reshape

def pivot_longer(df: DataFrame, what, ids: Sequence[str], name: str = "name",
                 value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), pick(df, what), name, value)


def pivot_wider(df: DataFrame, ids: Sequence[str], names_from: str, values_from: str,
                names: Sequence) -> DataFrame:
    """One column per entry of ``names`` (given, so no extra pass to find them)."""
    return df.groupBy(*ids).agg(*[
        F.max(F.when(F.col(names_from) == v, F.col(values_from))).alias(str(v)) for v in names])


def nest(df: DataFrame, by: Sequence[str], chunk: str | None = None, name: str = "data") -> DataFrame:
    """List column of the remaining fields; ``chunk`` keeps the lists of long series bounded."""
    keys = [*by, *([chunk] if chunk else [])]
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias(name))


def unnest(df: DataFrame, name: str = "data") -> DataFrame:
    return df.select(*[c for c in df.columns if c != name], F.inline(name))


# ------------------------------------------------------------------ user aggregates

AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "count": F.count, "sum": F.sum, "mean": F.avg, "median": F.median, "min": F.min, "max": F.max,
    "sd": F.stddev_samp,
}


def register_aggregate(name: str, fn: Callable[[Column], Column]) -> None:
    """User aggregate: any ``Column -> Column`` expression."""
    AGGREGATES[name] = fn


def row_mean(*cols: str) -> Column:
    return row_sum(*cols) / len(cols)


def row_sum(*cols: str) -> Column:
    total = F.lit(0.0)
    for c in cols:
        total = total + F.col(c)
    return total
