"""Scalar helpers: date parsing and transforms with exact inverses, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewheel.core import col


def ymd_h(c: str | Column) -> Column:
    return F.to_timestamp_ntz(col(c).cast("string"), F.lit("yyyyMMddHH"))


def ymd_hms(c: str | Column) -> Column:
    return F.to_timestamp_ntz(col(c), F.lit("yyyy-MM-dd HH:mm:ss"))


def dmy_hm(c: str | Column) -> Column:
    """``31-01-18 12:00``: a two-digit year always reads as 20yy (see ``repair_two_digit_year``)."""
    return F.to_timestamp_ntz(col(c), F.lit("dd-MM-yy HH:mm"))


def log_interval(y, lower, upper, offset=0.0) -> Column:
    """NULL outside the open interval."""
    z = col(y) + _c(offset)
    return F.when((z > _c(lower)) & (z < _c(upper)), F.log(F.try_divide(z - _c(lower), _c(upper) - z)))


def log_interval_inv(z, lower, upper, offset=0.0) -> Column:
    return _c(lower) + (_c(upper) - _c(lower)) / (1 + F.exp(-col(z))) - _c(offset)


def standardize(y, mean, sd) -> Column:
    """NULL for a constant series."""
    return F.try_divide(col(y) - _c(mean), _c(sd))


def standardize_inv(z, mean, sd) -> Column:
    return col(z) * _c(sd) + _c(mean)


def normalize(y, lo, hi) -> Column:
    """NULL for a constant series."""
    return F.try_divide(col(y) - _c(lo), _c(hi) - _c(lo))


def normalize_inv(z, lo, hi) -> Column:
    return col(z) * (_c(hi) - _c(lo)) + _c(lo)


def std_logint_inv(z, mean, sd, lower, upper, offset) -> Column:
    """Undo standardisation, then the interval logit."""
    return log_interval_inv(standardize_inv(z, mean, sd), lower, upper, offset)


def box_cox(y, lam) -> Column:
    c = col(y)
    if isinstance(lam, (int, float)):
        return F.log(c) if lam == 0 else (F.pow(c, F.lit(float(lam))) - 1) / lam
    p = _c(lam)
    return F.when(p == 0, F.log(c)).otherwise((F.pow(c, p) - 1) / p)


def box_cox_inv(z, lam) -> Column:
    c = col(z)
    if isinstance(lam, (int, float)):
        return F.exp(c) if lam == 0 else F.pow(c * lam + 1, F.lit(1.0 / lam))
    p = _c(lam)
    return F.when(p == 0, F.exp(c)).otherwise(F.pow(c * p + 1, 1 / p))


def _c(x) -> Column:
    return F.lit(x) if isinstance(x, (int, float)) else col(x)
