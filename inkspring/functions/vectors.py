"""Vector expressions over arrays of floats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _d(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(_d(a), _d(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: str | Column) -> Column:
    return F.sqrt(dot(a, a))


def distance(a: str | Column, b: str | Column) -> Column:
    d = F.zip_with(_d(a), _d(b), lambda x, y: x.cast("double") - y.cast("double"))
    return F.sqrt(F.aggregate(d, F.lit(0.0), lambda s, x: s + x * x))


def normalized(a: str | Column) -> Column:
    """Unit length; null for a zero vector or one with NaN."""
    n = norm(a)
    return F.when((n > 0) & ~F.isnan(n), F.transform(_d(a), lambda x: x.cast("double") / n))
