"""Stand-ins for chapter records over the star-schema tables, in both dialects.

Boxes: every line item is a rectangle on the page of its order. Utterances: conversation turns. Identities: customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspring.registry import table

WIDTH, HEIGHT = 60, 100


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page, ord, x1, y1, x2, y2, part: one box a line; odd lines are panels, even ones text boxes."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("page"), F.col("l_linenumber").cast("int").alias("line"), F.col("l_quantity").alias("x1"), (F.col("l_tax") * 1000.0).alias("y1"),
        (F.col("l_quantity") + F.col("l_linenumber") * 10.0).alias("x2"), (F.col("l_tax") * 1000.0 + F.col("l_discount") * 1000.0 + 5.0).alias("y2"), F.col("l_partkey").alias("part"), F.col("l_extendedprice").alias("price"),
    )
    return rows.groupBy("page", "line").agg(*[F.min(c).alias(c) for c in ("x1", "y1", "x2", "y2", "part", "price")]).withColumnRenamed("line", "ord")


BOXES = """boxes AS (
  SELECT l_orderkey AS page, l_linenumber::INT AS ord, min(l_quantity) AS x1, min(l_tax * 1000.0::DOUBLE) AS y1, min(l_quantity + l_linenumber * 10.0::DOUBLE) AS x2,
         min(l_tax * 1000.0::DOUBLE + l_discount * 1000.0::DOUBLE + 5.0::DOUBLE) AS y2, min(l_partkey) AS part, min(l_extendedprice) AS price
  FROM lineitem GROUP BY 1, 2)"""


def panels_and_texts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    b = boxes(spark, sf_dir).select("page", "ord", "x1", "y1", "x2", "y2")
    named = lambda p, odd: b.where(F.col("ord") % 2 == odd).select("page", *[F.col(c).alias(p + c) for c in ("ord", "x1", "y1", "x2", "y2")])
    return named("p_", 1), named("t_", 0)


#: In SQL: panels p and texts t, with the shared area of each pair on a page.
PAIRS = BOXES + """, p AS (SELECT page, ord AS p_ord, x1 AS p_x1, y1 AS p_y1, x2 AS p_x2, y2 AS p_y2 FROM boxes WHERE ord % 2 = 1),
t AS (SELECT page, ord AS t_ord, x1 AS t_x1, y1 AS t_y1, x2 AS t_x2, y2 AS t_y2 FROM boxes WHERE ord % 2 = 0),
pairs AS (SELECT *, greatest(0.0::DOUBLE, least(t_x2, p_x2) - greatest(t_x1, p_x1)) * greatest(0.0::DOUBLE, least(t_y2, p_y2) - greatest(t_y1, p_y1)) AS shared,
  greatest(0.0::DOUBLE, t_x2 - t_x1) * greatest(0.0::DOUBLE, t_y2 - t_y1) AS t_area, greatest(0.0::DOUBLE, p_x2 - p_x1) * greatest(0.0::DOUBLE, p_y2 - p_y1) AS p_area
  FROM t JOIN p USING (page))"""
