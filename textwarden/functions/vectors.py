"""Vector functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine_sim(a: Column, b: Column) -> Column:
    """Cosine of two vector columns; 0.0 when either has no length."""
    norms = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.when(norms == 0, F.lit(0.0)).otherwise(_dot(a, b) / F.nullif(norms, F.lit(0.0)))
