"""Array-vector expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column, eps: float = 1e-12) -> Column:
    scale = l2_norm(v) + F.lit(eps)
    return F.transform(v, lambda x: x.cast("double") / scale)
