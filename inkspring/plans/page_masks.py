"""Masks of whole pages as runs: safe parts, text regions, slots, rings, shapes, gaps and growth.

The stand-in draws a bubble for every turn on the page of its conversation (160 x 224 pixels). Turns 2k and 2k + 1 are the
two lobes of body k; where lobes meet is a bridge, the foot of every third bubble a tail; a text box lies in each bubble.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkspring.operators import outlines as O
from inkspring.operators import page_geometry as PG
from inkspring.operators import regions as G
from inkspring.operators import runs as R
from inkspring.operators import stateful as S
from inkspring.registry import query, table

WIDTH, HEIGHT = 160, 224
MARGIN, RATIO = 3, 0.12
PART = ["page", "part"]


def bubbles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page, ord, part, x1, y1, x2, y2, text: one bubble a turn."""
    t = table(spark, sf_dir, "conversations").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    n, k = F.coalesce(F.char_length("text"), F.lit(0)), F.col("turn").cast("int")
    t = t.select(F.col("conv_id").cast("long").alias("page"), k.alias("ord"), F.floor(k / 2).cast("int").alias("part"), (4 + (k * 37 + n) % 84).cast("int").alias("x1"), (4 + (k * 53 + n) % 128).cast("int").alias("y1"), n.alias("n"), "text")
    return t.select("page", "ord", "part", "x1", "y1", (F.col("x1") + 24 + F.col("n") % 45).cast("int").alias("x2"), (F.col("y1") + 20 + F.floor(F.col("n") / 7) % 40).cast("int").alias("y2"), "text")


BUBBLES = """t AS (SELECT conv_id AS page, turn AS ord, min(text) AS text FROM conversations GROUP BY 1, 2),
u AS (SELECT page, ord, coalesce(length(text), 0) AS n, text FROM t),
v AS (SELECT page, ord, ord // 2 AS part, 4 + (ord * 37 + n) % 84 AS x1, 4 + (ord * 53 + n) % 128 AS y1, n, text FROM u),
bubbles AS (SELECT page, ord::INT AS ord, part::INT AS part, x1::INT AS x1, y1::INT AS y1, (x1 + 24 + n % 45)::INT AS x2, (y1 + 20 + (n // 7) % 40)::INT AS y2, text FROM v)"""


def bodies(b: DataFrame) -> DataFrame:
    return R.from_boxes(b, PART)


def bridges(b: DataFrame) -> DataFrame:
    """Where the two lobes of a body meet."""
    key = [*PART, "ord"]
    return R.swept(R.valued(R.from_boxes(b, key).drop("ord")), PART, 2).drop("part")


def tails(b: DataFrame) -> DataFrame:
    """The foot of every third bubble."""
    return R.from_boxes(b.where("ord % 3 = 0").select("page", "x1", (F.col("y2") - 3).alias("y1"), (F.col("x1") + 12).alias("x2"), "y2"), ["page"])


def text_boxes(b: DataFrame) -> DataFrame:
    """page, source, part, x1, y1, x2, y2, reading_order: every fifth box knows no part."""
    inner = [(F.col("x1") + 5.5).alias("x1"), (F.col("y1") + 4.5).alias("y1"), (F.col("x2") - 5.5).alias("x2"), (F.col("y2") - 4.5).alias("y2")]
    return b.select("page", F.col("ord").alias("source"), F.when(F.col("ord") % 5 != 4, F.col("part")).alias("part"), *inner, F.col("ord").alias("reading_order"))


def safe(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    b = bubbles(spark, sf_dir)
    return G.safe_parts(bodies(b), [bridges(b), tails(b)], text_boxes(b), MARGIN, RATIO)


#: In SQL, pixel by pixel: half is how far a pixel's row is set on both sides; a disk needs its half width in every row.
SAFE = BUBBLES + f""", cells AS (SELECT page, part, ord, y, unnest(range(x1, x2)) AS x FROM (SELECT *, unnest(range(y1, y2)) AS y FROM bubbles)),
body AS (SELECT DISTINCT page, part, y, x FROM cells),
off AS (SELECT page, y, x FROM cells GROUP BY page, part, y, x HAVING count(*) = 2
        UNION SELECT page, y, unnest(range(x1, x1 + 12)) AS x FROM (SELECT *, unnest(range(y2 - 3, y2)) AS y FROM bubbles WHERE ord % 3 = 0)),
size AS (SELECT page, part, min(x)::INT AS x1, min(y)::INT AS y1, max(x)::INT + 1 AS x2, max(y)::INT + 1 AS y2 FROM body GROUP BY 1, 2),
marg AS (SELECT *, greatest({MARGIN}, round_even(least(x2 - x1, y2 - y1) * {RATIO}::DOUBLE, 0))::INT AS margin FROM size),
isle AS (SELECT page, part, y, x, x - row_number() OVER (PARTITION BY page, part, y ORDER BY x) AS g FROM body),
half AS (SELECT page, part, y, x, least(x - min(x) OVER w, max(x) OVER w - x) AS half FROM isle WINDOW w AS (PARTITION BY page, part, y, g)),
kept AS (SELECT h.page, h.part, h.y + d.dy AS y, h.x FROM half h JOIN marg m USING (page, part), range(-20, 21) d(dy)
         WHERE abs(d.dy) <= margin AND half >= floor(sqrt(margin * margin - d.dy * d.dy)) GROUP BY 1, 2, 3, 4, margin HAVING count(*) = 2 * margin + 1),
safe AS (SELECT * FROM kept k WHERE NOT EXISTS (SELECT 1 FROM off o WHERE o.page = k.page AND o.y = k.y AND o.x = k.x)),
src AS (SELECT page, ord AS source, CASE WHEN ord % 5 <> 4 THEN part END AS part, x1 + 5.5::DOUBLE AS x1, y1 + 4.5::DOUBLE AS y1, x2 - 5.5::DOUBLE AS x2, y2 - 4.5::DOUBLE AS y2 FROM bubbles),
own AS (SELECT page, part, avg((x1 + x2) / 2) AS ax, avg((y1 + y2) / 2) AS ay, min(source) AS rank FROM src WHERE part IS NOT NULL GROUP BY 1, 2),
whole AS (SELECT page, avg((x1 + x2) / 2) AS ax, avg((y1 + y2) / 2) AS ay, min(source) AS rank FROM src GROUP BY 1),
parts AS (SELECT m.*, coalesce(o.ax, w.ax) AS ax, coalesce(o.ay, w.ay) AS ay, coalesce(o.rank, w.rank)::INT AS reading_order,
          (SELECT count(*) FROM safe s WHERE s.page = m.page AND s.part = m.part) AS area
          FROM marg m LEFT JOIN own o USING (page, part) LEFT JOIN whole w USING (page))"""


@query("M14_safe_parts", oracle=f"WITH {SAFE} SELECT *, (row_number() OVER (PARTITION BY page ORDER BY reading_order, y1, x1 DESC, part))::INT AS place FROM parts")
def safe_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every body within its margin, without bridges and tails: bounds, margin, anchor, place and pixels left."""
    return safe(spark, sf_dir)[0]


def _regions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    allowed = R.swept(R.valued(safe(spark, sf_dir)[1].drop("part")), ["page"])
    return *G.text_regions(allowed, text_boxes(bubbles(spark, sf_dir)), WIDTH, HEIGHT), allowed


@query("M14_text_regions", oracle=f"""WITH {SAFE}, free AS (SELECT DISTINCT page, y, x FROM safe),
box AS (SELECT page, source, ceil(x1)::INT AS x1, ceil(y1)::INT AS y1, floor(x2)::INT AS x2, floor(y2)::INT AS y2 FROM src),
per AS (SELECT b.page, b.source, f.y, f.x FROM box b JOIN free f ON f.page = b.page AND f.x >= b.x1 AND f.x < b.x2 AND f.y >= b.y1 AND f.y < b.y2),
hit AS (SELECT DISTINCT page, source FROM (SELECT page, source, min(source) OVER (PARTITION BY page, y, x) AS first FROM per) WHERE first < source),
n AS (SELECT page, source, count(*) AS usable FROM per GROUP BY 1, 2),
o AS (SELECT b.*, greatest(0, x2 - x1)::BIGINT * greatest(0, y2 - y1) AS rectangle, coalesce(usable, 0) AS usable, CASE WHEN h.source IS NOT NULL THEN 'overlaps' WHEN usable IS NULL THEN 'empty' END AS issue
  FROM box b LEFT JOIN n USING (page, source) LEFT JOIN hit h USING (page, source))
SELECT page, source, rectangle, usable, CASE WHEN sum(usable) OVER p > 0 THEN usable / sum(usable) OVER p END AS share, issue, arg_min(issue, source) FILTER (issue IS NOT NULL) OVER p AS page_issue FROM o WINDOW p AS (PARTITION BY page)""")
def text_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usable pixels of every text box, its share, and the first issue of its page."""
    return _regions(spark, sf_dir)[0].select("page", "source", "rectangle", "usable", "share", "issue", "page_issue")


#: Glyph sizes that are tried.
SIZES = (4, 14)


@query("M13_slots", oracle=f"""WITH {SAFE}, z AS (SELECT page, part, ax, size::INT AS size, ((size * 6 + 4) // 5)::INT AS height FROM parts, range(4, 15, 5) r(size)),
b AS (SELECT page, part, min(y) AS y1, max(y) + 1 AS y2 FROM safe GROUP BY 1, 2),
l AS (SELECT *, greatest(height, ceil(height * 1.6::DOUBLE)::INT) AS step FROM z JOIN b USING (page, part)),
k AS (SELECT *, y1 + greatest(0, (y2 - y1 - ((y2 - y1) // step - 1) * step - height) // 2) AS top FROM l WHERE (y2 - y1) // step > 0),
n AS (SELECT *, unnest(range((y2 - height - top) // step + 1)) AS line FROM k WHERE y2 - height >= top),
f AS (SELECT n.page, n.part, n.size, line, s.x FROM n JOIN safe s ON s.page = n.page AND s.part = n.part AND s.y >= top + line * step AND s.y < top + line * step + height GROUP BY 1, 2, 3, 4, 5, height HAVING count(*) = height),
g AS (SELECT *, x - row_number() OVER (PARTITION BY page, part, size, line ORDER BY x) AS g FROM f),
r AS (SELECT page, part, size, line, min(x) AS x1, max(x) + 1 AS x2 FROM g GROUP BY page, part, size, line, g),
c AS (SELECT r.*, height, top + r.line * step AS y, row_number() OVER (PARTITION BY page, part, size, r.line ORDER BY x2 - x1 DESC, abs((x1 + x2) / 2 - ax), x1) AS best FROM r JOIN k USING (page, part, size))
SELECT page, part, size, line::INT AS line, y::INT AS y, height, x1::INT AS x1, x2::INT AS x2 FROM c WHERE best = 1 AND x2 - x1 >= greatest(2.0, size / 2)""")
def slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that the safe parts have room for, at glyph sizes 4, 9 and 14."""
    parts, runs = safe(spark, sf_dir)
    return G.slots(runs, parts.withColumn("size", F.explode(F.sequence(F.lit(4), F.lit(14), F.lit(5)))), PART)


@query("W24_mask_fit")
def mask_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first words of a body's text at the largest glyph size that its safe part holds: size, lines and their places."""
    parts, runs = safe(spark, sf_dir)
    found = G.slots(runs, parts.withColumn("size", F.explode(F.sequence(F.lit(SIZES[0]), F.lit(SIZES[1])))), PART)
    words = F.concat_ws(" ", F.slice(F.split(F.min_by("text", "ord"), r"\s+"), 1, 6))
    texts = bubbles(spark, sf_dir).groupBy(*PART).agg(words.alias("text")).join(parts.select(*PART, "ay"), PART)
    return G.mask_fit(found, texts, PART, "page long, part int").withColumn("lines", F.to_json("lines"))


@query("M15_grown_layout")
def grown_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of every page without an issue, grown until the page's text fits: boxes, reasons of blocked sides, size."""
    regions, _, allowed = _regions(spark, sf_dir)
    text = bubbles(spark, sf_dir).where("text is not null").groupBy("page").agg(F.min_by("text", "ord").alias("text"))
    good = regions.where("page_issue is null").withColumn("region", F.col("source")).withColumn("usable", F.col("usable").cast("int")).join(text, "page")
    return G.grown_layout(good, allowed, lambda t, areas: S.allocate([len(w) for w in t.split()], [float(x) for x in areas]), (WIDTH, HEIGHT), SIZES)


def _rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.rings(bodies(bubbles(spark, sf_dir)), PART, "page long, part int")


@query("M5_rings", oracle=f"""WITH {SAFE}, q AS (SELECT page, part, y + dy AS y, x + dx AS x, sum(1) AS n, sum((1 - 2 * dx) * (1 - 2 * dy)) AS d FROM body, (VALUES (0), (1)) a(dx), (VALUES (0), (1)) b(dy) GROUP BY 1, 2, 3, 4),
e AS (SELECT page, part, sum(CASE WHEN n IN (1, 3) THEN 1 WHEN n = 2 AND abs(d) = 2 THEN 2 ELSE 0 END)::BIGINT AS corners, (sum(CASE WHEN n = 1 THEN 1 WHEN n = 3 THEN -1 WHEN n = 2 AND abs(d) = 2 THEN 2 ELSE 0 END) / 4)::INT AS outer_minus_holes FROM q GROUP BY 1, 2),
p AS (SELECT page, part, count(*)::DOUBLE AS area FROM body GROUP BY 1, 2),
s AS (SELECT a.page, a.part, count(*) AS sides FROM body a, (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) v(dx, dy) WHERE NOT EXISTS (SELECT 1 FROM body c WHERE c.page = a.page AND c.part = a.part AND c.x = a.x + dx AND c.y = a.y + dy) GROUP BY 1, 2)
SELECT page, part, area, corners, outer_minus_holes, sides FROM p JOIN e USING (page, part) JOIN s USING (page, part)""")
def rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings around the bodies, summed: pixels they enclose, corners, sides in pixels, outer rings less holes."""
    sign = F.when(F.col("hole"), -1).otherwise(1)
    long = F.expr("aggregate(sequence(0, size(points) - 1), 0L, (s, i) -> s + abs(points[i][0] - points[(i + 1) % size(points)][0]) + abs(points[i][1] - points[(i + 1) % size(points)][1]))")
    return _rings(spark, sf_dir).groupBy(*PART).agg(F.sum(F.col("area") * sign).alias("area"), F.sum(F.size("points")).alias("corners"), F.sum(sign).cast("int").alias("outer_minus_holes"), F.sum(long).alias("sides"))


def largest_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest outer ring of every body, simplified, as its contour."""
    best = F.row_number().over(W.partitionBy(*PART).orderBy(F.desc("area"), "ring"))
    return _rings(spark, sf_dir).where("not hole").withColumn("_best", best).where("_best = 1").select(*PART, F.col("simple").alias("points"))


@query("P32_shape_of_rings")
def shape_of_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Solidity, rectangularity, circularity and acute corners of every body's contour, and the shape they make."""
    m = largest_rings(spark, sf_dir).withColumn("m", O.measures("points"))
    return m.select(*PART, *[F.round(f"m.{c}", 4).alias(c) for c in ("solidity", "rectangularity", "circularity")], "m.acute", "m.corners", O.shape(F.col("m"))["shape"].alias("shape"), O.shape(F.col("m"))["confidence"].alias("confidence"))


@query("M9_hint_of_rings")
def hint_of_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Style hints of bodies from their contour, and why they are rejected; every other lobe was only inferred."""
    b = bubbles(spark, sf_dir)
    seen = bodies(b.where("ord % 2 = 0"))
    body = bodies(b)
    share = R.support(body, seen, R.minus(PART, body, seen), PART, WIDTH, HEIGHT)
    s = O.shape(O.measures("points"))
    m = largest_rings(spark, sf_dir).select(*PART, s["shape"].alias("shape"), s["confidence"].alias("confidence")).withColumn("hint", O.hint(F.col("shape")))
    return m.join(share, PART).select(*PART, "shape", F.round("fraction", 6).alias("fraction"), F.to_json(O.rejections(F.col("fraction"), F.col("confidence"), F.col("hint"))).alias("rejected"), F.when(F.size(O.rejections(F.col("fraction"), F.col("confidence"), F.col("hint"))) == 0, F.col("hint")).alias("hint"))


@query("M8_refined_runs", oracle=f"""WITH {SAFE}, disk AS (SELECT dx, dy FROM range(-2, 3) a(dx), range(-2, 3) b(dy) WHERE dx * dx + dy * dy <= 4),
seen AS (SELECT DISTINCT page, y, x FROM cells), wide AS (SELECT DISTINCT page, y + dy AS y, x + dx AS x FROM seen, disk WHERE y + dy BETWEEN 0 AND {HEIGHT - 1} AND x + dx BETWEEN 0 AND {WIDTH - 1}),
closed AS (SELECT page, y + dy AS y, x + dx AS x FROM wide, disk GROUP BY 1, 2, 3 HAVING count(*) = 13)
SELECT page, count(*) AS gained FROM closed c WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.page = c.page AND s.y = c.y AND s.x = c.x)
AND EXISTS (SELECT 1 FROM bubbles b WHERE b.page = c.page AND ord % 2 = 1 AND c.x BETWEEN x1 - 2 AND x2 + 1 AND c.y BETWEEN y1 - 2 AND y2 + 1) GROUP BY 1""")
def refined_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of a page that repairing short gaps adds to its bubbles, where the picture is white: around odd bubbles."""
    b = bubbles(spark, sf_dir)
    white = R.from_boxes(b.where("ord % 2 = 1").select("page", (F.col("x1") - 2).alias("x1"), (F.col("y1") - 2).alias("y1"), (F.col("x2") + 2).alias("x2"), (F.col("y2") + 2).alias("y2")), ["page"])
    return R.measured(R.refined(R.from_boxes(b, ["page"]), white, ["page"], 2, WIDTH, HEIGHT), ["page"]).select("page", F.col("area").alias("gained"))


@query("M4_distances", oracle=f"""WITH {BUBBLES}, k AS (SELECT page, ord AS piece, x1, y2 - 3 AS y1, x1 + 12 AS x2, y2 FROM bubbles WHERE ord % 3 = 0),
d AS (SELECT k.page, k.piece, b.part, greatest(0, b.x1 - k.x2 + 1, k.x1 - b.x2 + 1) AS dx, greatest(0, b.y1 - k.y2 + 1, k.y1 - b.y2 + 1) AS dy FROM k JOIN bubbles b USING (page))
SELECT page, piece, part, min(dx * dx + dy * dy)::BIGINT AS d2 FROM d GROUP BY 1, 2, 3""")
def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squared distance of every tail to every body of its page."""
    b = bubbles(spark, sf_dir)
    key = ["page", "piece"]
    pieces = R.from_boxes(b.where("ord % 3 = 0").select("page", F.col("ord").alias("piece"), "x1", (F.col("y2") - 3).alias("y1"), (F.col("x1") + 12).alias("x2"), "y2"), key)
    return R.nearest(pieces, bodies(b), ["page"], "piece", "part")


@query("A26_union_runs", oracle=f"WITH {BUBBLES}, px AS (SELECT DISTINCT page, y, unnest(range(x1, x2)) AS x FROM (SELECT *, unnest(range(y1, y2)) AS y FROM bubbles)) SELECT page, count(*) AS area, min(x)::INT AS x1, min(y)::INT AS y1, max(x)::INT + 1 AS x2, max(y)::INT + 1 AS y2 FROM px GROUP BY 1")
def union_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area and bounds of the union of a page's bubbles."""
    return R.measured(R.from_boxes(bubbles(spark, sf_dir), ["page"]), ["page"])


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a page: bubbles in narrow bars as candidates, panels of half a page, tails, and dark corners."""
    b = bubbles(spark, sf_dir)
    box = lambda *c: F.array(*[x.cast("int") for x in c])
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    # a candidate is a bubble, or two bars of it with a gap that can be repaired
    bars = F.when(F.col("ord") % 2 == 0, F.array(box(x1, y1, x2, y2))).otherwise(F.array(box(x1, y1, x1 + 12, y2), box(x1 + 9, y1, x2, y2 - 6)))
    some = lambda c, when=None: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", (c if when is None else F.when(when, c).otherwise(F.array().cast("array<array<int>>"))).alias("b")))), lambda s: s["b"]))
    return b.groupBy("page").agg(
        some(bars).alias("candidates"), some(F.array(box(x1, y2 - 3, x1 + 12, y2)), F.col("ord") % 3 == 0).alias("tails"), some(F.array(box(x1 - 2, y1 - 2, x1 + 4, y1 + 4)), F.col("ord") % 4 == 0).alias("dark"),
    ).withColumn("panels", F.array(F.array(F.lit(0), F.lit(0), F.lit(WIDTH), F.lit(HEIGHT // 2)), F.array(F.lit(0), F.lit(HEIGHT // 2), F.lit(WIDTH), F.lit(HEIGHT))))


@query("stage3_groups")
def stage3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bubble groups of every page with their parts, panels, repaired and bridged pixels, and accepted style hints."""
    found = PG.groups(_pages(spark, sf_dir), (WIDTH, HEIGHT))
    pixels = lambda c: F.aggregate(c, F.lit(0), lambda s, r: s + r[2] - r[1])
    styles = PG.hints(found, (WIDTH, HEIGHT)).groupBy("page", "group").agg(F.count("hint").alias("hints"))
    rows = found.select("page", "group", F.to_json("members").alias("members"), F.to_json("bounds").alias("bounds"), F.to_json("panels").alias("panels"), "links", F.size("parts").alias("parts"), *[pixels(c).alias(c) for c in ("refined", "observed", "inferred", "bridge", "tail")])
    return rows.join(styles, ["page", "group"], "left").withColumn("hints", F.coalesce("hints", F.lit(0)))


@query("stage3_bubble_geometry")
def stage3_bubble_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text box of a page with its group and parts, and the effects over it: stage 3 from candidates to links."""
    b = bubbles(spark, sf_dir)
    found = PG.groups(_pages(spark, sf_dir), (WIDTH, HEIGHT))
    texts = text_boxes(b).select("page", F.col("source").alias("text"), "x1", "y1", "x2", "y2")
    effects = b.where("ord % 4 = 1").select("page", "x1", "y1", (F.col("x1") + 20).alias("x2"), (F.col("y1") + 24).alias("y2"))
    out = PG.mapped(texts, found, (WIDTH, HEIGHT)).join(PG.effects_of(texts, effects), ["page", "text"], "left")
    return out.select("page", "text", "group", F.to_json("parts").alias("parts"), "status", "coverage", F.coalesce("effects", F.lit(0)).alias("effects"))
