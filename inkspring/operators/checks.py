"""Validation operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkspring.functions import text as T


def violations(rules: dict[str, Column]) -> Column:
    """Codes of the rules that are broken, in their order."""
    return F.array_compact(F.array(*[F.when(broken, code) for code, broken in rules.items()]))


def sequence_invariants(rows: DataFrame, key: str, order: str, most: int) -> DataFrame:
    """rule, n: places out of order, repeated places, gaps, and keys longer than ``most``."""
    placed = rows.select(key, order, (F.row_number().over(W.partitionBy(key).orderBy(order)) - 1).alias("_k"))
    per = placed.groupBy(key).agg(F.count("*").alias("n"), F.countDistinct(order).alias("d"), F.count_if(F.col(order) != F.col("_k")).alias("off"), F.min(order).alias("lo"), F.max(order).alias("hi"))
    total = per.agg(F.sum("off").alias("order"), F.sum(F.col("n") - F.col("d")).alias("duplicate"), F.count_if(F.col("n") != F.col("hi") - F.col("lo") + 1).alias("coverage"), F.count_if(F.col("n") > most).alias("size"))
    rules = ("order", "duplicate", "coverage", "size")
    return total.select(F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.coalesce(r, F.lit(0)).alias("n")) for r in rules])))


def field_diff(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, field, before, after for every field that differs (null-safe)."""
    j = before.select(key, *[F.col(f).cast("string").alias(f"_a_{f}") for f in fields]).join(after.select(key, *[F.col(f).cast("string").alias(f"_b_{f}") for f in fields]), key)
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_a_{f}").alias("before"), F.col(f"_b_{f}").alias("after")) for f in fields])
    return j.select(key, F.inline(F.filter(each, lambda x: ~x["before"].eqNullSafe(x["after"]))))


def sweep(rows: DataFrame, value: Column, thresholds: list[int], base: int) -> DataFrame:
    """threshold, accepted, rejected, changed against ``base``: one aggregate for all thresholds."""
    aggs = [F.struct(F.lit(t).alias("threshold"), F.count_if(value >= t).alias("accepted"), F.count_if(value < t).alias("rejected"), F.count_if((value >= t) != (value >= base)).alias("changed")) for t in thresholds]
    return rows.agg(F.array(*aggs).alias("r")).select(F.inline("r"))


def noise_rules(spark: SparkSession, supplied: dict[str, list[str]]) -> DataFrame:
    """category, ord, key: the default noise rules and a chapter's own; a short list, each key once a category.

    An unknown category, or a rule that is blank, is an error.
    """
    if wrong := set(supplied) - set(T.NOISE_RULES):
        raise ValueError(f"unknown noise rule category: {', '.join(sorted(wrong))}")
    rows = [(c, k, v) for k, (c, values) in enumerate(T.NOISE_RULES.items()) for v in [*values, *supplied.get(c, [])]]
    if any(not v or not v.strip() for _, _, v in rows):
        raise ValueError("noise rules must be texts that are not blank")
    rules = spark.createDataFrame(rows, "category string, ord int, value string")
    return rules.select("category", "ord", T.noise_key("value").alias("key")).distinct()


def noise(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows(t, key, ...)`` with action, kind and reason; rules are broadcast (a list that people write)."""
    per = rules.groupBy("key").agg(F.max(F.col("category") == "keep").alias("_keep"), F.min_by("category", F.when(F.col("category") != "keep", F.col("ord"))).alias("_drop"))
    per = per.withColumn("_drop", F.when(F.col("_drop") != "keep", F.col("_drop")))
    said = rows.join(F.broadcast(per), "key", "left").withColumn("_d", T.decide(F.col("t"), F.col("key"), F.coalesce("_keep", F.lit(False)), F.col("_drop")))
    return said.select("*", "_d.action", "_d.kind", "_d.reason").drop("_d", "_keep", "_drop")
