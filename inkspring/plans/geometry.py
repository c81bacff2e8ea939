"""Box expressions and spatial joins: every join is an equi-join on the page with the overlap as residual."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspring.functions import boxes as B
from inkspring.operators import spatial as S
from inkspring.plans._tables import BOXES, HEIGHT, PAIRS, WIDTH, boxes, panels_and_texts
from inkspring.registry import query


@query(
    "P1_clipped_box",
    oracle=f"""WITH {BOXES} SELECT page, ord, greatest(0, least({WIDTH}, floor(x1)::INT)) AS x1, greatest(0, least({HEIGHT}, floor(y1)::INT)) AS y1,
    greatest(0, least({WIDTH}, ceil(x2)::INT)) AS x2, greatest(0, least({HEIGHT}, ceil(y2)::INT)) AS y2 FROM boxes""",
)
def clipped_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes(spark, sf_dir).select("page", "ord", *B.clipped("", WIDTH, HEIGHT))


@query("P2_valid_box", oracle=f"WITH {BOXES} SELECT page, ord, (x1 - 30 <= x2 - 50 AND y1 <= y2) AS ok FROM boxes")
def valid_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes whose right side was moved by an error of 20: some are reversed."""
    return boxes(spark, sf_dir).withColumn("x2", F.col("x2") - 20).select("page", "ord", B.valid().alias("ok"))


@query("P3_intersects", oracle=f"WITH {PAIRS} SELECT page, t_ord, p_ord FROM pairs WHERE least(t_x2, p_x2) > greatest(t_x1, p_x1) AND least(t_y2, p_y2) > greatest(t_y1, p_y1)")
def intersects(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, t = panels_and_texts(spark, sf_dir)
    return t.join(p, "page").where(B.intersects("t_", "p_")).select("page", "t_ord", "p_ord")


@query(
    "P4_box_overlap",
    oracle=f"""WITH {PAIRS} SELECT page, t_ord, p_ord, round(shared, 6) AS shared, round(shared / greatest(1.0::DOUBLE, t_area + p_area - shared), 6) AS iou,
    round(CASE WHEN t_area > 0 THEN shared / t_area ELSE 0 END, 6) AS coverage FROM pairs""",
)
def box_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, t = panels_and_texts(spark, sf_dir)
    return t.join(p, "page").select("page", "t_ord", "p_ord", F.round(B.shared("t_", "p_"), 6).alias("shared"), F.round(B.iou("t_", "p_"), 6).alias("iou"), F.round(B.coverage("t_", "p_"), 6).alias("coverage"))


@query(
    "P5_rectangle_gap",
    oracle=f"""WITH {PAIRS}, g AS (SELECT *, greatest(0.0::DOUBLE, p_x1 - t_x2, t_x1 - p_x2) AS dx, greatest(0.0::DOUBLE, p_y1 - t_y2, t_y1 - p_y2) AS dy FROM pairs)
    SELECT page, t_ord, p_ord, round(sqrt(dx * dx + dy * dy), 6) AS gap FROM g""",
)
def rectangle_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, t = panels_and_texts(spark, sf_dir)
    return t.join(p, "page").select("page", "t_ord", "p_ord", F.round(B.gap("t_", "p_"), 6).alias("gap"))


@query("P6_crop_relative", oracle=f"""WITH {PAIRS} SELECT page, t_ord, p_ord, round((t_x1 - p_x1) * (100.0::DOUBLE / (p_x2 - p_x1)), 6) AS x, round((t_y1 - p_y1) * (100.0::DOUBLE / (p_y2 - p_y1)), 6) AS y FROM pairs""")
def crop_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page coordinates to those of a crop drawn 100 units wide and high."""
    p, t = panels_and_texts(spark, sf_dir)
    sx, sy = 100.0 / (F.col("p_x2") - F.col("p_x1")), 100.0 / (F.col("p_y2") - F.col("p_y1"))
    return t.join(p, "page").select("page", "t_ord", "p_ord", F.round((F.col("t_x1") - F.col("p_x1")) * sx, 6).alias("x"), F.round((F.col("t_y1") - F.col("p_y1")) * sy, 6).alias("y"))


@query(
    "P7_clipped_edges",
    oracle=f"""WITH {BOXES} SELECT page, ord, concat_ws(',', CASE WHEN x1 <= 1 THEN 'left' END, CASE WHEN y1 <= 1 THEN 'top' END,
    CASE WHEN x2 >= {WIDTH - 1} THEN 'right' END, CASE WHEN y2 >= {HEIGHT - 1} THEN 'bottom' END) AS edges FROM boxes""",
)
def clipped_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sides of the page that a box touches, within one pixel."""
    flags = F.array(F.when(F.col("x1") <= 1, "left"), F.when(F.col("y1") <= 1, "top"), F.when(F.col("x2") >= WIDTH - 1, "right"), F.when(F.col("y2") >= HEIGHT - 1, "bottom"))
    return boxes(spark, sf_dir).select("page", "ord", F.array_join(F.array_compact(flags), ",").alias("edges"))


@query("J3_panel_for_box", oracle=f"""WITH {PAIRS}, b AS (SELECT page, t_ord, arg_max(p_ord, (shared, -p_ord)) AS panel FROM pairs WHERE shared > 0 GROUP BY 1, 2) SELECT t.page, t.t_ord, b.panel FROM t LEFT JOIN b USING (page, t_ord)""")
def panel_for_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, t = panels_and_texts(spark, sf_dir)
    return S.best_panel(t, p)


@query(
    "J4_panel_of_centre",
    oracle=f"""WITH {PAIRS}, b AS (SELECT page, t_ord, arg_min(p_ord, (p_area, p_ord)) AS panel FROM pairs
    WHERE (t_x1 + t_x2) / 2 BETWEEN p_x1 AND p_x2 AND (t_y1 + t_y2) / 2 BETWEEN p_y1 AND p_y2 GROUP BY 1, 2) SELECT t.page, t.t_ord, b.panel FROM t LEFT JOIN b USING (page, t_ord)""",
)
def panel_of_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, t = panels_and_texts(spark, sf_dir)
    return S.smallest_around_centre(t, p)


@query(
    "J5_panel_mapping",
    oracle=f"""WITH {PAIRS}, c AS (SELECT *, CASE WHEN t_area > 0 THEN shared / t_area ELSE 0 END AS cov FROM pairs),
    first_box AS (SELECT page, min(t_ord) AS t_ord FROM t GROUP BY 1),
    lead_panel AS (SELECT page, arg_max(p_ord, (shared, -p_ord)) AS panel FROM c JOIN first_box USING (page, t_ord) WHERE cov >= 0.1 GROUP BY 1),
    total AS (SELECT page, p_ord, sum(cov) AS s FROM c WHERE cov > 0 GROUP BY 1, 2),
    best AS (SELECT page, arg_max(p_ord, (round(s, 9), -p_ord)) AS panel, string_agg(p_ord::VARCHAR, ',' ORDER BY p_ord) AS panels FROM total GROUP BY 1)
    SELECT f.page, coalesce(l.panel, b.panel) AS panel, coalesce(b.panels, '') AS panels FROM first_box f LEFT JOIN lead_panel l USING (page) LEFT JOIN best b USING (page)""",
)
def panel_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, t = panels_and_texts(spark, sf_dir)
    return S.panel_mapping(t, p)


@query("J6_effect_overlap", oracle=f"WITH {PAIRS} SELECT page, t_ord, p_ord FROM pairs WHERE t_area > 0 AND shared / t_area >= 0.25")
def effect_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, t = panels_and_texts(spark, sf_dir)
    return t.join(p, "page").where(B.coverage("t_", "p_") >= 0.25).select("page", "t_ord", "p_ord")


@query(
    "J7_map_text",
    oracle=f"""WITH {PAIRS}, c AS (SELECT page, t_ord, p_ord, shared / t_area AS cov FROM pairs WHERE t_area > 0 AND shared / t_area >= 0.4),
    r AS (SELECT *, row_number() OVER w AS k, lead(cov) OVER w AS next, count(*) OVER (PARTITION BY page, t_ord) AS n,
          string_agg(p_ord::VARCHAR, ',') OVER (PARTITION BY page, t_ord ORDER BY p_ord ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS c FROM c WINDOW w AS (PARTITION BY page, t_ord ORDER BY cov DESC, p_ord))
    SELECT t.page, t.t_ord, CASE WHEN r.k IS NULL THEN 'unmatched' WHEN r.next IS NULL OR r.cov - r.next >= 0.15 THEN 'matched' ELSE 'ambiguous' END AS status,
           CASE WHEN r.next IS NULL OR r.cov - r.next >= 0.15 THEN r.p_ord END AS panel, coalesce(r.c, '') AS candidates
    FROM t LEFT JOIN (SELECT * FROM r WHERE k = 1) r USING (page, t_ord)""",
)
def map_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, t = panels_and_texts(spark, sf_dir)
    return S.map_with_margin(t, p, 0.4, 0.15)


@query(
    "J8_match_bubble",
    oracle=f"""WITH {PAIRS}, r AS (SELECT page, t_ord, p_ord, shared / p_area AS cov, row_number() OVER (PARTITION BY page, p_ord ORDER BY shared / p_area DESC, t_ord) AS k FROM pairs WHERE p_area > 0 AND shared > 0)
    SELECT page, p_ord, t_ord, round(cov, 6) AS coverage FROM r WHERE k = 1 AND cov >= 0.3""",
)
def match_bubble(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, t = panels_and_texts(spark, sf_dir)
    pairs = t.join(p, "page").withColumn("cov", B.coverage("p_", "t_")).where("cov > 0")
    best = pairs.groupBy("page", "p_ord").agg(F.min_by(F.struct("t_ord", "cov"), F.struct(-F.col("cov"), "t_ord")).alias("b"))
    return best.where("b.cov >= 0.3").select("page", "p_ord", "b.t_ord", F.round("b.cov", 6).alias("coverage"))


@query(
    "J18_best_iou_match",
    oracle=f"""WITH {PAIRS}, i AS (SELECT page, t_ord, p_ord, shared / greatest(1.0::DOUBLE, t_area + p_area - shared) AS iou FROM pairs),
    b AS (SELECT page, p_ord, arg_max(t_ord, (iou, -t_ord)) AS t_ord, max(iou) AS iou FROM i GROUP BY 1, 2) SELECT page, p_ord, t_ord, round(iou, 6) AS iou FROM b WHERE iou >= 0.3""",
)
def best_iou_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, t = panels_and_texts(spark, sf_dir)
    scored = t.join(p, "page").withColumn("iou", B.iou("t_", "p_"))
    best = scored.groupBy("page", "p_ord").agg(F.max_by("t_ord", F.struct("iou", -F.col("t_ord"))).alias("t_ord"), F.max("iou").alias("iou"))
    return best.where("iou >= 0.3").withColumn("iou", F.round("iou", 6))


@query("A25_envelope", oracle=f"""WITH {BOXES} SELECT page, greatest(0, least({WIDTH}, floor(min(x1))::INT)) AS x1, greatest(0, least({HEIGHT}, floor(min(y1))::INT)) AS y1, greatest(0, least({WIDTH}, ceil(max(x2))::INT)) AS x2, greatest(0, least({HEIGHT}, ceil(max(y2))::INT)) AS y2 FROM boxes GROUP BY page""")
def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clipped box around all boxes of a page."""
    around = boxes(spark, sf_dir).groupBy("page").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))
    return around.select("page", *B.clipped("", WIDTH, HEIGHT))


@query(
    "A7_overlap_components",
    oracle=f"""WITH RECURSIVE {BOXES}, e AS (SELECT a.page, a.ord AS a, b.ord AS b FROM boxes a JOIN boxes b ON a.page = b.page AND a.ord <> b.ord
      WHERE greatest(0.0::DOUBLE, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0::DOUBLE, least(a.y2, b.y2) - greatest(a.y1, b.y1))
        >= 0.35 * greatest(1.0::DOUBLE, (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - greatest(0.0::DOUBLE, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0::DOUBLE, least(a.y2, b.y2) - greatest(a.y1, b.y1)))),
    r AS (SELECT page, ord AS a, ord AS c FROM boxes UNION SELECT r.page, e.b, r.c FROM r JOIN e ON e.page = r.page AND e.a = r.a)
    SELECT page, a AS ord, min(c) AS component FROM r GROUP BY 1, 2""",
)
def overlap_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes fused by IoU of 0.35 or more; a component is named by its smallest box."""
    return S.fused_boxes(boxes(spark, sf_dir).select("page", "ord", "x1", "y1", "x2", "y2"), 0.35)


@query("W13_ordered_boxes")
def ordered_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right-to-left reading order of the boxes of a page by greedy rows."""
    return S.reading_order(boxes(spark, sf_dir).select("page", "ord", "x1", "y1", "x2", "y2"))


@query("W14_suppress_duplicates")
def suppress_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy suppression: boxes by falling price, dropped if they overlap a kept one by IoU of 0.3 or more."""
    return S.suppressed(boxes(spark, sf_dir).select("page", "ord", "x1", "y1", "x2", "y2", F.col("price").alias("confidence")), 0.3)


@query("A22_overlap_audit", oracle=f"""WITH {BOXES}, x AS (SELECT a.page, count(*) AS n FROM boxes a JOIN boxes b ON a.page = b.page AND a.ord < b.ord AND least(a.x2, b.x2) > greatest(a.x1, b.x1) AND least(a.y2, b.y2) > greatest(a.y1, b.y1) GROUP BY 1)
SELECT (SELECT count(DISTINCT page) FROM boxes) AS pages, (SELECT count(*) FROM boxes) AS boxes, coalesce(sum(n), 0)::BIGINT AS overlapping_pairs, count(*) AS pages_with_overlap FROM x""")
def overlap_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of overlapping box pairs over all pages."""
    b = boxes(spark, sf_dir)
    side = lambda p: b.select("page", *[F.col(c).alias(p + c) for c in ("ord", "x1", "y1", "x2", "y2")])
    pairs = side("a_").join(side("b_"), "page").where((F.col("a_ord") < F.col("b_ord")) & B.intersects("a_", "b_")).groupBy("page").agg(F.count("*").alias("n"))
    per = b.groupBy("page").agg(F.count("*").alias("boxes")).join(pairs, "page", "left")
    return per.agg(F.count("*").alias("pages"), F.sum("boxes").alias("boxes"), F.coalesce(F.sum("n"), F.lit(0)).alias("overlapping_pairs"), F.count("n").alias("pages_with_overlap"))
