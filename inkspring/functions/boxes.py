"""Rectangles as four columns with a common prefix: <p>x1, <p>y1, <p>x2, <p>y2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sides(p: str) -> tuple[Column, Column, Column, Column]:
    return F.col(f"{p}x1"), F.col(f"{p}y1"), F.col(f"{p}x2"), F.col(f"{p}y2")


def valid(p: str = "") -> Column:
    """Four finite numbers, not reversed."""
    x1, y1, x2, y2 = sides(p)
    finite = [c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")) for c in (x1, y1, x2, y2)]
    return F.coalesce(finite[0] & finite[1] & finite[2] & finite[3] & (x2 >= x1) & (y2 >= y1), F.lit(False))


def clipped(p: str, width: float, height: float) -> list[Column]:
    """The box inside a page: lower sides floored, upper sides ceiled."""
    x1, y1, x2, y2 = sides(p)
    inside = lambda c, most: F.greatest(F.lit(0), F.least(F.lit(int(most)), c.cast("int")))
    return [inside(F.floor(x1), width).alias("x1"), inside(F.floor(y1), height).alias("y1"), inside(F.ceil(x2), width).alias("x2"), inside(F.ceil(y2), height).alias("y2")]


def area(p: str) -> Column:
    x1, y1, x2, y2 = sides(p)
    return F.greatest(F.lit(0.0), x2 - x1) * F.greatest(F.lit(0.0), y2 - y1)


def intersects(a: str, b: str) -> Column:
    """Strict overlap: touching sides do not count."""
    ax1, ay1, ax2, ay2 = sides(a)
    bx1, by1, bx2, by2 = sides(b)
    return (F.least(ax2, bx2) > F.greatest(ax1, bx1)) & (F.least(ay2, by2) > F.greatest(ay1, by1))


def shared(a: str, b: str) -> Column:
    """Area of the intersection."""
    ax1, ay1, ax2, ay2 = sides(a)
    bx1, by1, bx2, by2 = sides(b)
    return F.greatest(F.lit(0.0), F.least(ax2, bx2) - F.greatest(ax1, bx1)) * F.greatest(F.lit(0.0), F.least(ay2, by2) - F.greatest(ay1, by1))


def iou(a: str, b: str) -> Column:
    return shared(a, b) / F.greatest(F.lit(1.0), area(a) + area(b) - shared(a, b))


def coverage(a: str, b: str) -> Column:
    """Share of ``a`` that ``b`` covers; 0 for an empty ``a``."""
    return F.when(area(a) > 0, shared(a, b) / area(a)).otherwise(0.0)


def gap(a: str, b: str) -> Column:
    """Euclidean distance between two rectangles, 0 if they meet."""
    ax1, ay1, ax2, ay2 = sides(a)
    bx1, by1, bx2, by2 = sides(b)
    dx = F.greatest(F.lit(0.0), bx1 - ax2, ax1 - bx2)
    dy = F.greatest(F.lit(0.0), by1 - ay2, ay1 - by2)
    return F.sqrt(dx * dx + dy * dy)
