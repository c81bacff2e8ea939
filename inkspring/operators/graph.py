"""Graph operators over edge tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkspring.operators.sequences import chunked


def _cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the session names; a temporary one only on one machine (master local, tests)."""
    spark: SparkSession = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint(eager=True)


def resolved(ids: DataFrame, redirects: DataFrame, rounds: int = 64) -> DataFrame:
    """id, root: redirects followed to their end by pointer doubling; a cycle is an error.

    ``redirects(id, to)`` has one row per redirected id. Every round halves the chains, so 64 rounds suffice for any
    table; more mean a cycle.
    """
    at = _cut(ids.join(redirects, "id", "left").select("id", F.coalesce("to", "id").alias("at")))
    for _ in range(rounds):
        step = at.select(F.col("id").alias("at"), F.col("at").alias("on"))
        new = _cut(at.join(step, "at", "left").select("id", F.col("at").alias("was"), F.coalesce("on", "at").alias("at")))
        if new.where("was <> at").isEmpty():
            if new.join(redirects.where("id <> to").select(F.col("id").alias("at")), "at", "left_semi").isEmpty():
                return new.select("id", F.col("at").alias("root"))
            break
        at = new.select("id", "at")
    raise ValueError("redirects have a cycle")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for ``edges(a, b)``: minimum exchange with pointer jumping."""
    both = _cut(edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(edges.select(F.col("b").alias("x"), F.col("a").alias("y"))).where("x <> y").distinct())
    label = both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("component"))
    while True:
        label = _cut(label)
        seen = both.join(label.select(F.col("node").alias("y"), "component"), "y").groupBy("x").agg(F.min("component").alias("c"))
        low = label.join(seen.withColumnRenamed("x", "node"), "node").select("node", F.col("component").alias("was"), F.least("component", "c").alias("component"))
        up = label.select(F.col("node").alias("component"), F.col("component").alias("top"))
        new = _cut(low.join(up, "component", "left").select("node", "was", F.coalesce(F.least("component", "top"), "component").alias("component")))
        label = new.select("node", "component")
        if new.where("component <> was").isEmpty():
            return label


def ancestors(edges: DataFrame) -> DataFrame:
    """step, ancestor: the transitive closure of ``edges(step, needs)``; steps may need themselves by a cycle.

    ``reach`` has the pairs that 1 to k edges join, ``exact`` those that exactly k do: a way of up to 2k edges is one of k
    and a shorter one, so each pair is met by few ways only. Joins sort both sides: no table is sent to the driver, however
    small a column is estimated.
    """
    exact = reach = _cut(edges.select("step", F.col("needs").alias("ancestor")).distinct())
    while True:
        first = exact.select("step", F.col("ancestor").alias("_by")).hint("merge")
        on = lambda then: first.join(then.withColumnRenamed("step", "_by").hint("merge"), "_by").select("step", "ancestor")  # noqa: E731, B023
        new, twice = reach.unionByName(on(reach)).distinct(), _cut(on(exact).distinct())
        if twice.isEmpty():
            return new
        new = _cut(new)
        if new.count() == reach.count():
            return new
        exact, reach = twice, new


def hierarchy(rows: DataFrame, key: str, scene: str, order: list[str], target: str, most: int) -> DataFrame:
    """Two levels: scenes and, within them, events of at most ``most`` targets in order."""
    parts = chunked(rows, [key, scene], order, most).groupBy(key, scene, "chunk").agg(F.array_sort(F.collect_list(F.struct(*order, F.col(target).alias("_t")))).alias("t"))
    name = F.concat(F.lit("scene:"), F.col(scene))
    return parts.select(key, name.alias("scene_id"), F.concat(name, F.lit(":event:"), F.col("chunk") + 1).alias("event_key"), F.array_join(F.transform("t", lambda x: x["_t"]), ",").alias("targets"), F.size("t").cast("long").alias("n"))


def connections(turns: DataFrame) -> DataFrame:
    """contains and next edges of conversations: type, src, dst; no loops, no repeats."""
    node = lambda c: F.concat_ws(":", F.lit("turn"), "conv_id", c)
    after = turns.select("conv_id", "turn", F.lead("turn").over(W.partitionBy("conv_id").orderBy("turn")).alias("next"))
    contains = turns.select(F.lit("contains").alias("type"), F.concat(F.lit("conv:"), "conv_id").alias("src"), node("turn").alias("dst"))
    return contains.unionByName(after.where("next is not null").select(F.lit("next").alias("type"), node("turn").alias("src"), node("next").alias("dst"))).where("src <> dst").distinct()


def halved(rows: DataFrame, key: str, order: str, cost: str, limit: int) -> DataFrame:
    """``rows`` with node: the part of their request in which they are answered.

    A request above the limit is cut in two halves by count, the halves again, until each fits or is one row; node names
    the way there. The rounds are as many as halvings; each is one window over the parts that are still too large.
    """
    live, done = rows.withColumn("node", F.lit("")), None
    while True:
        part = W.partitionBy(key, "node")
        sized = live.withColumn("_n", F.count("*").over(part)).withColumn("_sum", F.sum(cost).over(part)).withColumn("_k", F.row_number().over(part.orderBy(order)) - 1)
        over = (F.col("_sum") > limit) & (F.col("_n") > 1)
        fine = sized.where(~over).select(*live.columns)
        done = fine if done is None else done.unionByName(fine)
        cut = sized.where(over).withColumn("node", F.concat("node", F.when(F.col("_k") < F.floor(F.col("_n") / 2), ":split:0").otherwise(":split:1"))).select(*live.columns)
        live = _cut(cut)
        if live.isEmpty():
            return done


def numbered(rows: DataFrame, key: str, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``name``: their place (from 1) among the rows of their key, by a total ``order``.

    A key may hold any share of the rows: they are dealt by ranges of key and order, numbered in each range, and moved
    by the count of the ranges before it.
    """
    dealt = _cut(rows.repartitionByRange(F.col(key), *order).withColumn("_range", F.spark_partition_id()))
    own = F.row_number().over(W.partitionBy(key, "_range").orderBy(*order))
    counts = dealt.groupBy(key, "_range").agg(F.count("*").alias("_n"))
    before = counts.select(key, "_range", (F.sum("_n").over(W.partitionBy(key).orderBy("_range")) - F.col("_n")).alias("_before"))
    return dealt.withColumn("_own", own).join(before, [key, "_range"]).withColumn(name, (F.col("_own") + F.col("_before")).cast("long")).select(*rows.columns, name)
