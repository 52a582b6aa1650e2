"""Numeric guards. ANSI mode stays on, so division, casts and correlation never raise here."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def ieee_div(a: Column, b: Column) -> Column:
    """a / b with signed infinity for a zero divisor and NULL for 0/0."""
    by_zero = F.when(a > 0, F.lit(INF)).when(a < 0, F.lit(-INF))
    return F.when(b == 0, by_zero).otherwise(F.try_divide(a.cast("double"), b.cast("double")))


def finite(x: Column) -> Column:
    """NULL for NaN and both infinities."""
    return F.when(~F.isnan(x) & (F.abs(x) < INF), x)


def guarded_div(a: Column, b: Column, eps: float = 1e-6) -> Column:
    return F.try_divide(a.cast("double"), b + F.lit(eps))


def indicator(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; NULL instead of an error without variance."""
    xx = F.when(y.isNotNull(), x)
    yy = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(xx) * F.stddev_pop(yy))


def to_number(x: Column) -> Column:
    return x.try_cast("double")


def to_utc_timestamp(x: Column) -> Column:
    return F.try_to_timestamp(x.cast("string"))


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))
