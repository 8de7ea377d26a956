"""Dense-vector expressions over array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    """Inner product of two numeric arrays, in double precision."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, value: total + value)


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two numeric arrays; 0 when either is absent or has no length."""
    norms = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return F.coalesce(F.try_divide(dot(left, right), norms), F.lit(0.0))
