"""Masks as tables: a mask is the set of its row runs (key, y, a, b), set pixels a <= x < b of row y.

Everything here is joins, explodes and one sweep over the ends of runs, and no page is ever drawn. A mask's boxes or runs are
dealt to a task, and what a disk or a box makes of them is summed up there: only boxes and runs are shuffled. ``key`` names the columns that tell masks apart (a page, a page and a part, ...). Runs of
a row that come from an operator are disjoint and do not touch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Outweighs any number of rows of a disk.
_NEVER = -1_000_000


def dealt(rows: DataFrame, key: list[str]) -> DataFrame:
    """The rows of a key in one task, as many tasks as the session's shuffles have: what they are blown up to stays there."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)


def swept(spans: DataFrame, key: list[str], least: Column | int = 1, near: bool = False) -> DataFrame:
    """Runs of the pixels whose spans ``(key, y, a, b, v)`` add up to ``least``, a column of the key or a number.

    ``near``: the spans of a key are in one task already. Spans are dealt, never their ends, once for the sums and the rows.
    """
    spans = spans.where("a < b").withColumn("_least", least if isinstance(least, Column) else F.lit(least))
    spans = spans.select(*key, "y", "a", "b", "v", "_least")
    spans = spans if near else dealt(spans, key)
    ends = F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("v").alias("d")), F.struct(F.col("b").alias("x"), (-F.col("v")).alias("d")))).alias("e")
    ends = spans.select(*key, "y", "_least", ends).groupBy(*key, "y", "e.x").agg(F.sum("e.d").alias("d"), F.max("_least").alias("_least"))
    row = W.partitionBy(*key, "y").orderBy("x")
    on = ends.withColumn("on", F.sum("d").over(row) >= F.max("_least").over(row.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    turns = on.withColumn("was", F.lag("on", 1, False).over(row)).where("on <> was")
    return turns.withColumn("b", F.lead("x").over(row)).where("on").select(*key, "y", F.col("x").alias("a"), "b")


def valued(runs: DataFrame, v: int = 1) -> DataFrame:
    return runs.withColumn("v", F.lit(v))


def from_boxes(boxes: DataFrame, key: list[str]) -> DataFrame:
    """The union of half-open pixel boxes (key, x1, y1, x2, y2)."""
    boxes = dealt(boxes.where("x1 < x2 and y1 < y2").select(*key, "x1", "y1", "x2", "y2"), key)
    rows = boxes.select(*key, F.explode(F.sequence("y1", F.col("y2") - 1)).alias("y"), F.col("x1").alias("a"), F.col("x2").alias("b"))
    return swept(valued(rows), key, near=True)


def union(key: list[str], *masks: DataFrame) -> DataFrame:
    out = masks[0].select(*key, "y", "a", "b")
    for m in masks[1:]:
        out = out.unionByName(m.select(*key, "y", "a", "b"))
    return swept(valued(out), key)


def intersection(key: list[str], *masks: DataFrame) -> DataFrame:
    out = masks[0].select(*key, "y", "a", "b")
    for m in masks[1:]:
        out = out.unionByName(m.select(*key, "y", "a", "b"))
    return swept(valued(out), key, len(masks))


def minus(key: list[str], mask: DataFrame, *gone: DataFrame) -> DataFrame:
    out = valued(mask.select(*key, "y", "a", "b"))
    for m in gone:
        out = out.unionByName(valued(m.select(*key, "y", "a", "b"), _NEVER))
    return swept(out, key)


def _rows_of_disk(runs: DataFrame, radius: Column | int) -> DataFrame:
    """Every run once for each row of a disk around it, with ``_w``, the half width of that row; once without a radius."""
    r = radius if isinstance(radius, Column) else F.lit(radius)
    rows = runs.withColumn("_r", r.cast("int"))
    rows = rows.withColumn("_dy", F.explode(F.when(F.col("_r").isNull(), F.array(F.lit(0))).otherwise(F.sequence(-F.col("_r"), F.col("_r")))))
    return rows.withColumn("_w", F.coalesce(F.floor(F.sqrt(F.col("_r") * F.col("_r") - F.col("_dy") * F.col("_dy"))).cast("int"), F.lit(0)))


def eroded(runs: DataFrame, key: list[str], radius: Column | int, *gone: DataFrame) -> DataFrame:
    """Pixels with the whole disk of ``radius`` (a number or a column of the key) in the mask, without the masks ``gone``.

    What lies beyond the page is clear. A pixel stays where all rows of the disk around it lie in runs.
    """
    mask = runs.select(*key, "y", "a", "b", (radius if isinstance(radius, Column) else F.lit(radius)).cast("int").alias("_radius"))
    for m in gone:
        mask = mask.unionByName(m.select(*key, "y", "a", "b", F.lit(None).cast("int").alias("_radius")))
    rows = _rows_of_disk(dealt(mask, key), F.col("_radius"))
    off = F.col("_r").isNull()
    spans = rows.select(
        *key, (F.col("y") + F.col("_dy")).alias("y"), (F.col("a") + F.col("_w")).alias("a"), (F.col("b") - F.col("_w")).alias("b"),
        F.when(off, _NEVER).otherwise(1).alias("v"), F.when(off, 1).otherwise(2 * F.col("_r") + 1).alias("_need"),
    )
    return swept(spans, key, F.col("_need"), near=True)


def dilated(runs: DataFrame, key: list[str], radius: Column | int, width: int, height: int) -> DataFrame:
    """Pixels of the page with a set pixel within ``radius``."""
    runs = dealt(runs.withColumn("_radius", radius if isinstance(radius, Column) else F.lit(radius)).select(*key, "y", "a", "b", "_radius"), key)
    rows = _rows_of_disk(runs, F.col("_radius")).select(*key, (F.col("y") + F.col("_dy")).alias("y"), F.greatest(F.lit(0), F.col("a") - F.col("_w")).alias("a"), F.least(F.lit(width), F.col("b") + F.col("_w")).alias("b"))
    return swept(valued(rows.where((F.col("y") >= 0) & (F.col("y") < height))), key, near=True)


def spread(runs: DataFrame, key: list[str], steps: int, width: int, height: int) -> DataFrame:
    """Pixels of the page at most ``steps`` sideways or upright moves from a set one."""
    rows = dealt(runs.select(*key, "y", "a", "b"), key).withColumn("_dy", F.explode(F.sequence(F.lit(-steps), F.lit(steps)))).withColumn("_w", steps - F.abs("_dy"))
    rows = rows.select(*key, (F.col("y") + F.col("_dy")).alias("y"), F.greatest(F.lit(0), F.col("a") - F.col("_w")).alias("a"), F.least(F.lit(width), F.col("b") + F.col("_w")).alias("b"))
    return swept(valued(rows.where((F.col("y") >= 0) & (F.col("y") < height))), key, near=True)


def boundary(runs: DataFrame, key: list[str]) -> DataFrame:
    """Set pixels with a clear one beside, above or below them, or at the edge of the page."""
    return minus(key, runs, eroded(runs, key, 1))


def support(body: DataFrame, observed: DataFrame, inferred: DataFrame, key: list[str], width: int, height: int) -> DataFrame:
    """key, fraction: the share of a body's boundary that lies within 2 moves of the observed boundary and not within 3 of
    what was inferred."""
    own = boundary(body, key)
    seen = minus(key, intersection(key, own, spread(boundary(observed, key), key, 2, width, height)), spread(inferred, key, 3, width, height))
    area = lambda m, name: measured(m, key).select(*key, F.col("area").alias(name))
    return area(own, "_all").join(area(seen, "_seen"), key, "left").select(*key, (F.coalesce("_seen", F.lit(0)) / F.col("_all")).alias("fraction"))


def measured(runs: DataFrame, key: list[str]) -> DataFrame:
    """key, area and bounds (half-open) of every mask that has a pixel."""
    return runs.groupBy(*key).agg(F.sum(F.col("b") - F.col("a")).cast("long").alias("area"), F.min("a").alias("x1"), F.min("y").alias("y1"), F.max("b").alias("x2"), (F.max("y") + 1).alias("y2"))


def refined(observed: DataFrame, white: DataFrame, key: list[str], radius: int, width: int, height: int) -> DataFrame:
    """Pixels that closing adds to a mask and that are white: short gaps with support in the picture."""
    closed = eroded(dilated(observed, key, radius, width, height), key, radius)
    return minus(key, intersection(key, closed, white), observed)


def edges(runs: DataFrame, key: list[str]) -> DataFrame:
    """Directed edges (key, x1, y1, x2, y2) around a mask, the set pixels to their right: a run's two ends, and the parts of
    its upper and lower side where the next row is clear."""
    one = F.lit(1)
    lower = lambda step: runs.select(*key, (F.col("y") + step).alias("y"), "a", "b")
    upper_side = minus(key, runs, lower(1)).select(*key, F.col("a").alias("x1"), F.col("y").alias("y1"), F.col("b").alias("x2"), F.col("y").alias("y2"))
    lower_side = minus(key, runs, lower(-1)).select(*key, F.col("b").alias("x1"), (F.col("y") + one).alias("y1"), F.col("a").alias("x2"), (F.col("y") + one).alias("y2"))
    side = F.explode(F.array(F.struct(F.col("b").alias("x1"), F.col("y").alias("y1"), F.col("b").alias("x2"), (F.col("y") + one).alias("y2")), F.struct(F.col("a").alias("x1"), (F.col("y") + one).alias("y1"), F.col("a").alias("x2"), F.col("y").alias("y2")))).alias("s")
    return upper_side.unionByName(lower_side).unionByName(runs.select(*key, side).select(*key, "s.*"))


def nearest(pieces: DataFrame, bodies: DataFrame, key: list[str], piece: str, body: str) -> DataFrame:
    """key, piece, body, d2: the squared distance of the nearest two pixels, for every body of the piece's page.

    The two passes of a distance transform as joins: in a row, the nearest set pixel of a run is read off the ends of
    runs; over rows, the squares of both ways add up and the least wins. Rows of runs meet, never pixels.
    """
    p = pieces.select(*key, piece, F.col("y").alias("_y"), F.col("a").alias("_a"), F.col("b").alias("_b"))
    across = F.greatest(F.lit(0), F.col("a") - F.col("_b") + 1, F.col("_a") - F.col("b") + 1)
    down = F.col("y") - F.col("_y")
    return p.join(bodies.select(*key, body, "y", "a", "b"), key).groupBy(*key, piece, body).agg(F.min(across * across + down * down).cast("long").alias("d2"))
