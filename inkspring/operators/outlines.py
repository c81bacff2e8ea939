"""Rings around masks, and what their shape says. Edges come from runs; one mask's edges are linked in one small group."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from inkspring.operators import runs as R
from inkspring.operators.stateful import in_parts

Points = list[tuple[float, float]]


def linked(edges: list[tuple[int, int, int, int]]) -> list[Points]:
    """Closed rings of corners from directed edges, from the upper left corner on; where two rings meet, turn right.

    Turning right keeps pixels that only share a corner in rings of their own. Corners are where the direction changes.
    """
    leave: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for x1, y1, x2, y2 in sorted(edges):
        leave.setdefault((x1, y1), []).append((x2, y2))
    out = []
    for first in sorted(leave, key=lambda p: (p[1], p[0])):
        while leave.get(first):
            at, ring = leave[first].pop(), [first]
            while at != first:
                dx, dy = at[0] - ring[-1][0], at[1] - ring[-1][1]
                # the sign of the cross product is positive for a right turn, as y points down
                ways = leave[at]
                way = max(ways, key=lambda w: dx * (w[1] - at[1]) - dy * (w[0] - at[0]))
                ways.remove(way)
                ring.append(at)
                at = way
            out.append(corners(ring))
    return out


def corners(ring: Points) -> Points:
    """A ring without the points on a straight way between their neighbours."""
    n = len(ring)
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - q[1]) != (q[1] - p[1]) * (r[0] - q[0])
    return [ring[i] for i in range(n) if turn(ring[i - 1], ring[i], ring[(i + 1) % n])]


def area(ring: Points) -> float:
    """Positive for a ring around set pixels, negative for one around a hole."""
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def _far(p: tuple, a: tuple, b: tuple) -> float:
    long = math.dist(a, b)
    along = 0.0 if not long else max(0.0, min(1.0, ((p[0] - a[0]) * (b[0] - a[0]) + (p[1] - a[1]) * (b[1] - a[1])) / long**2))
    return math.dist(p, (a[0] + along * (b[0] - a[0]), a[1] + along * (b[1] - a[1])))


def simplified(ring: Points, tolerance: float) -> Points:
    """Fewer points, each dropped one within ``tolerance`` of the side that replaces it; a ring keeps three points at least.

    The ring is split at its first point and the one furthest from it; halves are split where they stray furthest.
    """
    if len(ring) <= 3:
        return ring
    middle = max(range(1, len(ring)), key=lambda i: math.dist(ring[0], ring[i]))
    keep, open_, closed = {0, middle}, [(0, middle), (middle, len(ring))], [*ring, ring[0]]
    while open_:
        i, j = open_.pop()
        far, k = max(((_far(closed[m], closed[i], closed[j]), m) for m in range(i + 1, j)), default=(0.0, i))
        if far > tolerance:
            keep.add(k)
            open_ += [(i, k), (k, j)]
    if len(keep) < 3:
        keep.add(max((m for m in range(1, len(ring)) if m != middle), key=lambda m: _far(ring[m], ring[0], ring[middle])))
    return [ring[i] for i in sorted(keep)]


def hull(points: Points) -> Points:
    """Convex hull, in the sense of rings here; no three points on a line."""
    out: list[Points] = []
    for way in (sorted(set(points)), sorted(set(points), reverse=True)):
        side: Points = []
        for p in way:
            while len(side) > 1 and (side[-1][0] - side[-2][0]) * (p[1] - side[-2][1]) - (side[-1][1] - side[-2][1]) * (p[0] - side[-2][0]) <= 0:
                side.pop()
            side.append(p)
        out.append(side[:-1])
    return out[0] + out[1]


def smallest_rectangle(points: Points) -> float:
    """Area of the smallest rectangle, turned at will: one side of it lies on a side of the hull."""
    h = np.array(hull(points), float)
    d = np.roll(h, -1, axis=0) - h
    d /= np.hypot(d[:, 0], d[:, 1])[:, None]
    along, across = h @ d.T, h @ np.stack([-d[:, 1], d[:, 0]])
    return float((np.ptp(along, axis=0) * np.ptp(across, axis=0)).min())


def acute(ring: Points, under: float = 65.0) -> int:
    """Corners of less than ``under`` degrees."""
    p = np.array(ring, float)
    a, b = np.roll(p, 1, axis=0) - p, np.roll(p, -1, axis=0) - p
    lengths = np.hypot(*a.T) * np.hypot(*b.T)
    cos = np.clip((a * b).sum(axis=1) / np.where(lengths > 0, lengths, 1), -1, 1)
    return int(((np.degrees(np.arccos(cos)) < under) & (lengths > 0)).sum())


def rings(runs: DataFrame, key: list[str], kind: str) -> DataFrame:
    """key, ring (from 1), hole, area, points, simple: every ring of every mask; ``kind`` is the type of the key columns.

    ``points`` are all corners: the rings of a mask, holes taken off, cover exactly its pixels. ``simple`` has a
    tolerance of one pixel.
    """
    point = pa.list_(pa.list_(pa.int32()))
    some = R.edges(runs, key).groupBy(*key).agg(F.collect_list(F.array("x1", "y1", "x2", "y2")).alias("edges"))
    names = ["ring", "hole", "area", "points", "simple"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_parts(batches, 500):
            rows, at = [], []
            for i, e in enumerate(b.column("edges").to_pylist()):
                for n, ring in enumerate(linked([tuple(x) for x in e]), 1):
                    size = area(ring)
                    rows.append((n, size < 0, abs(size), ring, simplified(ring, 1.0)))
                    at.append(i)
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            made = [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.bool_(), pa.float64(), point, point), strict=True)]
            yield pa.RecordBatch.from_arrays([*[b.column(k).take(pa.array(at, pa.int32())) for k in key], *made], [*key, *names])

    return some.mapInArrow(run, f"{kind}, ring int, hole boolean, area double, points array<array<int>>, simple array<array<int>>")


_MEASURES = StructType([*[StructField(c, DoubleType()) for c in ("solidity", "rectangularity", "circularity")], *[StructField(c, IntegerType()) for c in ("acute", "corners")]])


@F.udf(_MEASURES, useArrow=True)
def measures(points):
    """Solidity, rectangularity, circularity, acute corners and corners of a ring; null for one too small to judge."""
    ring = [tuple(p) for p in points]
    size = abs(area(ring))
    if len(ring) < 4 or size < 64:
        return None
    around = sum(math.dist(p, q) for p, q in zip(ring, ring[1:] + ring[:1], strict=True))
    clean = simplified(ring, max(1.5, math.sqrt(size) * 0.015))
    return {
        "solidity": size / max(1.0, abs(area(hull(ring)))), "rectangularity": size / max(1.0, smallest_rectangle(ring)),
        "circularity": 4 * math.pi * size / around**2, "acute": acute(clean), "corners": len(clean),
    }


def shape(m: Column) -> Column:
    """struct(shape, confidence) of a ring's measures; fixed thresholds, the first rule that holds decides."""
    s, r, c = m["solidity"], m["rectangularity"], m["circularity"]
    rules = [
        ((r >= 0.93) & (s >= 0.97), "rectangular", 0.85), ((m["acute"] >= 3) & (s < 0.92), "spiky", 0.75), ((s >= 0.94) & (c >= 0.65), "rounded", 0.80),
        ((s >= 0.80) & (s < 0.94) & (m["acute"] == 0) & (m["corners"] >= 12), "cloud", 0.60),
    ]
    out = lambda name, sure: F.struct(F.lit(name).alias("shape"), F.lit(sure).alias("confidence"))
    case = F.when(m.isNull(), out("unknown", 0.0))
    for when, name, sure in rules:
        case = case.when(when, out(name, sure))
    return case.otherwise(out("irregular", 0.40))


def hint(shape: Column) -> Column:
    """Style that a shape alone hints at: one only, or none."""
    return F.when(shape == "spiky", "shout").when(shape == "cloud", "thought").when(shape == "rectangular", "caption")


def rejections(fraction: Column, confidence: Column, hint: Column, most: float = 0.20, least: float = 0.80) -> Column:
    """Why a hint is not accepted, in a fixed order: boundary inferred, support too weak, a cloud alone, no style."""
    return F.array_compact(F.array(
        F.when(1 - fraction > most, "too_much_inferred_boundary"), F.when(confidence < least, "visual_support_below_acceptance"),
        F.when(hint == "thought", "cloud_shape_without_independent_border_evidence"), F.when(hint.isNull(), "no_distinctive_visual_style"),
    ))
