"""Sequence operators: intervals, chunks, segments, spread, windows of expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkspring.functions import vectors as V


def intervals(rows: DataFrame, key: str, order: list[str], starts: Column, name: str) -> DataFrame:
    """``rows`` with ``name``, the number of start markers so far, and pos, the place in the key's sequence."""
    w = W.partitionBy(key).orderBy(*order)
    return rows.withColumn(name, F.sum(F.when(starts, 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("pos", F.row_number().over(w))


def chunked(rows: DataFrame, keys: list[str], order: list[str], size: int) -> DataFrame:
    """``rows`` with chunk: runs of at most ``size`` in order."""
    w = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("chunk", F.floor((F.row_number().over(w) - 1) / size))


def owner_segments(rows: DataFrame, key: str, order: list[str], owner: str) -> DataFrame:
    """``rows`` with segment: it grows where a known owner differs from the last known one."""
    w = W.partitionBy(key).orderBy(*order)
    before = F.last(owner, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    turned = rows.withColumn("_new", F.when(F.col(owner) != before, 1).otherwise(0))
    return turned.withColumn("segment", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def near_targets(rows: DataFrame, target: Column, key: str, order: str, radius: int) -> DataFrame:
    """Rows within ``radius`` places of a target row."""
    w = W.partitionBy(key).orderBy(order).rowsBetween(-radius, radius)
    return rows.withColumn("_near", F.max(F.when(target, 1).otherwise(0)).over(w)).where("_near = 1").drop("_near")


def even_cut(sizes: DataFrame, key: str, part: str, n: str) -> DataFrame:
    """key, cut: the part after which the running sum is nearest to half; ties to the first."""
    total = F.sum(n).over(W.partitionBy(key))
    run = F.sum(n).over(W.partitionBy(key).orderBy(part).rowsBetween(W.unboundedPreceding, 0))
    scored = sizes.select(key, part, F.abs(total - 2 * run).alias("_off"))
    return scored.groupBy(key).agg(F.min_by(part, F.struct("_off", part)).alias("cut"))


def spread(rows: DataFrame, key: str, order: list[str], count: int) -> DataFrame:
    """At most ``count`` rows of each key, evenly spaced, with pos (their place)."""
    w = W.partitionBy(key)
    placed = rows.withColumn("pos", (F.row_number().over(w.orderBy(*order)) - 1).cast("long")).withColumn("_n", F.count("*").over(w))
    wanted = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / (count - 1), 0).cast("long"))
    return placed.where((F.col("_n") <= count) | F.array_contains(wanted, F.col("pos"))).drop("_n")


def nearest_to_mean(rows: DataFrame, key: str, ident: str, vector: str, k: int) -> DataFrame:
    """key, ident, distance, place: the k rows of each key nearest to the key's mean vector."""
    each = rows.select(key, F.posexplode(vector).alias("i", "x")).groupBy(key, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    mean = each.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("m"))
    near = rows.join(mean, key).select(key, ident, F.round(V.distance(vector, "m"), 5).alias("distance"))
    w = W.partitionBy(key).orderBy("distance", ident)
    return near.withColumn("place", F.row_number().over(w).cast("long")).where(F.col("place") <= k)


def natural_key(c: str) -> Column:
    """Sort key of a name: digit runs padded so that they compare as numbers, other text folded to lower case."""
    pieces = F.regexp_extract_all(F.lower(c), F.lit(r"\d+|\D+"), F.lit(0))
    return F.transform(pieces, lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, 20, "0")).otherwise(p))


def pending(rows: DataFrame, keys: list[str], page: str, gap: int) -> DataFrame:
    """``rows`` with state: promoted by a row at most ``gap`` pages later, closed when none can come, else pending."""
    after = F.lead(page).over(W.partitionBy(*keys).orderBy(page))
    last = rows.agg(F.max(page).alias("_last"))
    out = rows.withColumn("_next", after).join(F.broadcast(last))
    state = F.when(F.col("_next") - F.col(page) <= gap, "promoted").when(F.col(page) < F.col("_last") - gap, "closed").otherwise("pending")
    return out.withColumn("state", state).drop("_next", "_last")


def fitted(rows: DataFrame, key: str, order: str, kind: str, cost: str, limit: int) -> DataFrame:
    """``rows`` with kept and fits: what a request may hold, its targets untouched.

    ``kind`` is target, support or context. If all is too much, the oldest support goes first; if that is not enough
    without any support, context goes as well; fits is false where the targets alone are too much.
    """
    w = W.partitionBy(key)
    part = lambda k: F.coalesce(F.sum(F.when(F.col(kind) == k, F.col(cost))).over(w), F.lit(0))
    newer = F.coalesce(F.sum(F.when(F.col(kind) == "support", F.col(cost))).over(w.orderBy(F.col(order).desc()).rangeBetween(W.unboundedPreceding, 0)), F.lit(0))
    all_but = part("target") + part("context")
    keep = F.when(F.col(kind) == "support", newer + all_but <= limit).when(F.col(kind) == "context", all_but <= limit).otherwise(True)
    return rows.withColumn("kept", keep).withColumn("fits", part("target") <= limit)
