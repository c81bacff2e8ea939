"""Where text may stand on a page: safe parts of bodies, regions of text boxes, line slots, and regions that grow.

Masks are tables of runs (``operators.runs``). What one page's text needs in order, region after region, is done on that
page's regions and runs in one group; a page is the unit that is bounded.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkspring.operators import runs as R

Box = list[int]
SIDES = ("left", "right", "up", "down")


def line_height(size: Column | int) -> Column | int:
    """Height of a line of glyphs of a size: six fifths of it, rounded up."""
    return F.ceil(size * 6 / 5).cast("int") if isinstance(size, Column) else -(-size * 6 // 5)


def text_width(chars: int, size: int) -> float:
    """Width of a text: half the size for every character."""
    return chars * size / 2


def safe_parts(bodies: DataFrame, gone: list[DataFrame], sources: DataFrame, margin: int = 10, ratio: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """(parts, runs): what is left of every body within its margin, and its anchor and place in reading order.

    ``bodies(page, part, y, a, b)``; ``gone``: masks (page, y, a, b) that no text may touch (bridges, tails);
    ``sources(page, part, x1, y1, x2, y2, reading_order)``: text boxes, with the part that they lie in or null. A body is
    eroded by a disk of ``ratio`` of its short side (half to even), ``margin`` at least. The anchor is the mean middle of
    the part's boxes, else of all boxes of the page, else of the body.
    """
    key = ["page", "part"]
    body = R.measured(bodies, key)
    short = F.least(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    body = body.withColumn("margin", F.greatest(F.lit(margin), F.rint(short * ratio)).cast("int"))
    ids = body.select(*key)
    off = [ids.join(m.select("page", "y", "a", "b"), "page") for m in gone]
    runs = R.eroded(bodies.join(body.select(*key, "margin"), key), key, F.col("margin"), *off)
    middle = lambda p, q: (F.col(p) + F.col(q)) / 2
    found = [F.avg(middle("x1", "x2")).alias("ax"), F.avg(middle("y1", "y2")).alias("ay"), F.min("reading_order").alias("rank")]
    own, whole = sources.where("part is not null").groupBy(*key).agg(*found), sources.groupBy("page").agg(*found)
    either = lambda c, last: F.coalesce(F.col(f"o.{c}"), F.col(f"w.{c}"), last)
    parts = body.alias("b").join(own.alias("o"), key, "left").join(whole.alias("w"), "page", "left").select(
        *[F.col(f"b.{c}").alias(c) for c in (*key, "margin", "x1", "y1", "x2", "y2")],
        either("ax", middle("b.x1", "b.x2")).alias("ax"), either("ay", middle("b.y1", "b.y2")).alias("ay"), either("rank", F.lit(0)).cast("int").alias("reading_order"),
    )
    place = F.row_number().over(W.partitionBy("page").orderBy("reading_order", "y1", F.desc("x1"), "part"))
    area = R.measured(runs, key).select(*key, F.col("area").alias("_area"))
    return parts.join(area, key, "left").withColumn("area", F.coalesce("_area", F.lit(0)).cast("long")).drop("_area").withColumn("place", place), runs


def text_regions(allowed: DataFrame, sources: DataFrame, width: int, height: int) -> tuple[DataFrame, DataFrame]:
    """(regions, runs): the part of every text box where text may stand, its share of the page's area, and what is wrong.

    ``allowed(page, y, a, b)``; ``sources(page, source, x1, y1, x2, y2, reading_order)`` may have fractions: boxes are cut
    to the whole pixels inside them. A box without usable pixels is ``empty``; one that shares usable pixels with a box
    before it in reading order ``overlaps``. ``page_issue`` is the first issue of the page in reading order.
    """
    key = ["page", "source"]
    low = lambda c, most: F.greatest(F.lit(0), F.least(F.lit(most), F.ceil(c))).cast("int")
    high = lambda c, most: F.greatest(F.lit(0), F.least(F.lit(most), F.floor(c))).cast("int")
    boxes = sources.select(*key, "reading_order", low("x1", width).alias("x1"), low("y1", height).alias("y1"), high("x2", width).alias("x2"), high("y2", height).alias("y2"), ((F.col("x1") + F.col("x2")) / 2).alias("ax"), ((F.col("y1") + F.col("y2")) / 2).alias("ay"))
    # rows of boxes meet the runs of their row; a run's part within a box is a run
    rows = boxes.where("x1 < x2 and y1 < y2").select("page", F.explode(F.sequence("y1", F.col("y2") - 1)).alias("y"), "x1", "x2", F.struct("reading_order", "source").alias("rank"))
    cut = rows.join(allowed.select("page", "y", "a", "b"), ["page", "y"]).where("a < x2 and x1 < b")
    ranked = cut.select("page", "y", "rank", F.greatest("a", "x1").alias("a"), F.least("b", "x2").alias("b"))
    runs = ranked.select("page", "rank.source", "y", "a", "b")
    # two runs of one row meet where the later begins within the earlier: their rows meet, never their pixels
    earlier = ranked.select("page", "y", F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("rank").alias("_rank"))
    clash = ranked.join(earlier, ["page", "y"]).where("_rank < rank and _a < b and a < _b").select("page", "rank.source").distinct().withColumn("clash", F.lit(True))
    area = R.measured(runs, key).select(*key, F.col("area").alias("usable"))
    out = boxes.join(area, key, "left").join(clash, key, "left").withColumn("usable", F.coalesce("usable", F.lit(0)).cast("long"))
    out = out.withColumn("issue", F.when(F.col("clash"), "overlaps").when(F.col("usable") == 0, "empty"))
    page = W.partitionBy("page")
    first = F.min(F.when(F.col("issue").isNotNull(), F.struct("reading_order", "source", "issue"))).over(page)
    rectangle = F.greatest(F.lit(0), F.col("x2") - F.col("x1")) * F.greatest(F.lit(0), F.col("y2") - F.col("y1"))
    return out.select(*key, "reading_order", "x1", "y1", "x2", "y2", "ax", "ay", rectangle.cast("long").alias("rectangle"), "usable", F.try_divide(F.col("usable"), F.sum("usable").over(page)).alias("share"), "issue", first["issue"].alias("page_issue")), runs


def slots(runs: DataFrame, parts: DataFrame, key: list[str], spacing: float = 1.6) -> DataFrame:
    """key, line, y, height, x1, x2: one run for every line of glyphs that a mask has room for.

    ``parts``: key, size (of glyphs), ax (anchor). Lines lie a step apart, as many as fit into the bounds, in their
    middle; a line's runs are those of all its rows together; it takes the widest, then the one nearest to the anchor,
    then the first. A run narrower than a glyph is none.
    """
    bounds = R.measured(runs, key).select(*key, "y1", "y2")
    height = line_height(F.col("size"))
    lines = parts.select(*key, "size", "ax").join(bounds, key).withColumn("height", height).withColumn("step", F.greatest("height", F.ceil(F.col("height") * spacing).cast("int")))
    lines = lines.withColumn("count", F.floor((F.col("y2") - F.col("y1")) / F.col("step")).cast("int")).where("count > 0")
    spare = F.col("y2") - F.col("y1") - (F.col("count") - 1) * F.col("step") - F.col("height")
    lines = lines.withColumn("top", F.col("y1") + F.greatest(F.lit(0), F.floor(spare / 2).cast("int")))
    # a row belongs to one line at most: no join on ranges is needed
    rows = runs.select(*key, "y", "a", "b").join(lines, key).withColumn("from", F.col("y") - F.col("top")).withColumn("line", F.floor(F.col("from") / F.col("step")).cast("int"))
    rows = rows.where((F.col("from") >= 0) & (F.pmod("from", "step") < F.col("height")) & (F.col("top") + F.col("line") * F.col("step") <= F.col("y2") - F.col("height")))
    full = [*key, "size", "line"]
    swept = R.swept(R.valued(rows.select(*full, F.lit(0).alias("y"), "a", "b", "height")), full, F.col("height")).drop("y")
    met = swept.join(lines.select(*key, "size", "ax", "top", "step", "height"), [*key, "size"])
    away = F.abs((F.col("a") + F.col("b")) / 2 - F.col("ax"))
    best = F.row_number().over(W.partitionBy(*full).orderBy(F.desc(F.col("b") - F.col("a")), away, "a"))
    chosen = met.withColumn("_best", best).where("_best = 1").where((F.col("b") - F.col("a")) >= F.greatest(F.lit(2.0), F.col("size") / 2))
    return chosen.select(*full, (F.col("top") + F.col("line") * F.col("step")).alias("y"), "height", F.col("a").alias("x1"), F.col("b").alias("x2"))


def placed(words: list[str], lines: list[tuple[int, int, int]], size: int, ay: float) -> list[tuple[str, float, int]] | None:
    """(text, x, y) of the lines of words, centred in slots ``(y, x1, x2)``; None where they do not fit.

    From every slot on, words fill slot after slot, with a pixel free on either side; the way with the fewest lines wins,
    then the one with its middle nearest to the anchor, then the first.
    """
    if not words:
        return []
    best = None
    for start in range(len(lines)):
        i, out = 0, []
        for y, x1, x2 in lines[start:]:
            j, chars = i, -1
            while j < len(words) and text_width(chars + 1 + len(words[j]), size) <= x2 - x1 - 2:
                chars += 1 + len(words[j])
                j += 1
            if j == i:
                break
            out.append((" ".join(words[i:j]), (x1 + x2 - text_width(chars, size)) / 2, y))
            i = j
            if i == len(words):
                score = (len(out), abs((out[0][2] + y + line_height(size)) / 2 - ay))
                if best is None or score < best[0]:
                    best = (score, out)
                break
    return best[1] if best else None


_LINES = pa.list_(pa.struct([("text", pa.string()), ("x", pa.float64()), ("y", pa.int32())]))


def mask_fit(found: DataFrame, texts: DataFrame, key: list[str], kind: str) -> DataFrame:
    """key, size, lines: the largest size at which a text fits into its mask's slots; no row where none does.

    ``found`` comes from ``slots`` at all sizes to try; ``texts(key, text, ay)``.
    """
    tried = found.groupBy(*key, "size").agg(F.array_sort(F.collect_list(F.struct("y", "x1", "x2"))).alias("slots")).join(texts, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [placed(t.split(), [(s["y"], s["x1"], s["x2"]) for s in lines], size, ay) for t, lines, size, ay in zip(*(b.column(c).to_pylist() for c in ("text", "slots", "size", "ay")), strict=True)]
            rows = pa.array([None if m is None else [{"text": t, "x": x, "y": y} for t, x, y in m] for m in made], _LINES)
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in key], b.column("size"), rows], [*key, "size", "lines"])

    fits = tried.mapInArrow(run, f"{kind}, size int, lines array<struct<text:string,x:double,y:int>>").where("lines is not null")
    return fits.groupBy(*key).agg(F.max("size").alias("size"), F.max_by("lines", "size").alias("lines"))


class Allowed:
    """Runs of one page by row."""

    def __init__(self, runs: list[tuple[int, int, int]]):
        self.rows: dict[int, list[tuple[int, int]]] = {}
        for y, a, b in sorted(runs):
            self.rows.setdefault(y, []).append((a, b))

    def within(self, box: Box) -> dict[int, list[tuple[int, int]]]:
        """The runs inside a box, by row."""
        x1, y1, x2, y2 = box
        cut = {y: [(max(a, x1), min(b, x2)) for a, b in self.rows.get(y, ()) if a < x2 and x1 < b] for y in range(y1, y2)}
        return {y: r for y, r in cut.items() if r}

    def area(self, box: Box) -> int:
        return sum(b - a for r in self.within(box).values() for a, b in r)

    def lines(self, box: Box, size: int, ax: float, spacing: float) -> list[tuple[int, int, int]]:
        """Slots (y, x1, x2) of a box, as ``slots`` finds them."""
        rows = self.within(box)
        if not rows:
            return []
        height = line_height(size)
        y1, y2, step = min(rows), max(rows) + 1, max(height, math.ceil(height * spacing))
        count = (y2 - y1) // step
        out = []
        for y in range(y1 + max(0, (y2 - y1 - (count - 1) * step - height) // 2), y2 - height + 1, step) if count else ():
            runs = rows.get(y, [])
            for z in range(y + 1, y + height):
                runs = [(max(a, c), min(b, d)) for a, b in runs for c, d in rows.get(z, ()) if a < d and c < b]
            if runs:
                a, b = max(runs, key=lambda r: (r[1] - r[0], -abs((r[0] + r[1]) / 2 - ax)))
                if b - a >= max(2, size / 2):
                    out.append((y, a, b))
        return out


def gap(p: Box, q: Box) -> float:
    return math.hypot(max(0, p[0] - q[2], q[0] - p[2]), max(0, p[1] - q[3], q[1] - p[3]))


def grown(regions: list[dict], who: set, allowed: Allowed, size: tuple[int, int], step: int = 2, least: int = 10) -> list[tuple]:
    """One round of growth of the regions ``{id, box, blocked}`` named in ``who``; returns (id, side, box before, after).

    Region after region, side after side: a side that would leave the page, come nearer than ``least`` to another region
    or gain no allowed pixel is blocked for good, with the reason; other sides go on.
    """
    changes = []
    for r in (r for r in regions if r["id"] in who):
        for k, side in enumerate(SIDES):
            if side in r["blocked"]:
                continue
            at, box = (0, 2, 1, 3)[k], list(r["box"])
            box[at] = max(0, min(size[at % 2], box[at] + (step if k % 2 else -step)))
            strip = list(box)
            strip[(at + 2) % 4] = r["box"][at]
            if box == r["box"]:
                r["blocked"][side] = "image_edge"
            elif any(gap(box, o["box"]) < least for o in regions if o["id"] != r["id"]):
                r["blocked"][side] = "neighbor_gap"
            elif not allowed.within(strip):
                r["blocked"][side] = "body_margin_boundary"
            else:
                changes.append((r["id"], side, r["box"], box))
                r["box"] = box
    return changes


def expanded(regions: list[dict], allowed: Allowed, size: tuple[int, int], sizes: tuple[int, int], spacing: float = 1.6, step: int = 2, least: int = 10) -> tuple[int | None, int]:
    """(glyph size, rounds of growth): the largest size in ``sizes`` at which all regions hold their words.

    Regions ``{id, box, words, ax, ay}`` get ``lines`` and ``blocked``. Where the smallest size does not fit, regions that
    lack room grow round after round until it does or nothing grows; then the size is searched anew. A region with
    another nearer than ``least`` at the start does not grow at all.
    """
    smallest, largest = sizes

    def fit(s: int) -> set:
        for r in regions:
            r["lines"] = placed(r["words"], allowed.lines(r["box"], s, r["ax"], spacing), s, r["ay"])
        return {r["id"] for r in regions if r["lines"] is None}

    best = lambda: next((s for s in range(largest, smallest - 1, -1) if not fit(s)), None)
    near = {r["id"] for r in regions if any(gap(r["box"], o["box"]) < least for o in regions if o["id"] != r["id"])}
    for r in regions:
        r["blocked"] = {}
    found, rounds = best(), 0
    if found is None:
        for r in regions:
            if r["id"] in near:
                r["blocked"] = dict.fromkeys(SIDES, "nearby_ocr_region")
        while found is None and grown(regions, fit(smallest), allowed, size, step, least):
            rounds += 1
            found = best() if not fit(smallest) else None
    return found, rounds


def grown_layout(regions: DataFrame, allowed: DataFrame, words: Callable[[str, list[int]], list[list[int]]], size: tuple[int, int], sizes: tuple[int, int]) -> DataFrame:
    """page, region, x1..y2, usable, blocked, n_lines, size, rounds: the regions of every page after growth.

    ``regions(page, region, x1, y1, x2, y2, ax, ay, usable, text)``: usable area and text of the page; ``words`` deals the
    text's words to regions by their areas (consecutive ranges). ``allowed(page, y, a, b)``.
    """
    r = regions.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("region", "x1", "y1", "x2", "y2", "ax", "ay", "usable"))).alias("regions"), F.min("text").alias("text"))
    a = allowed.groupBy("page").agg(F.collect_list(F.array("y", "a", "b")).alias("runs"))
    kinds = [("page", pa.int64()), ("region", pa.int32()), *[(c, pa.int32()) for c in ("x1", "y1", "x2", "y2", "usable")], ("blocked", pa.list_(pa.string())), ("n_lines", pa.int32()), ("size", pa.int32()), ("rounds", pa.int32())]

    def page(text: str, some: list[dict], runs: list | None) -> list[dict]:
        held, tokens = Allowed([tuple(x) for x in runs or ()]), text.split()
        ranges = words(text, [x["usable"] for x in some])
        made = [{"id": x["region"], "box": [x["x1"], x["y1"], x["x2"], x["y2"]], "ax": x["ax"], "ay": x["ay"], "words": tokens[i:j]} for x, (i, j) in zip(some, ranges, strict=True)]
        found, rounds = expanded(made, held, size, sizes)
        return [{"region": m["id"], **dict(zip(("x1", "y1", "x2", "y2"), m["box"], strict=True)), "usable": held.area(m["box"]), "blocked": [f"{s}:{m['blocked'][s]}" for s in SIDES if s in m["blocked"]], "n_lines": len(m["lines"] or []), "size": found, "rounds": rounds} for m in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [{"page": p} | x for p, t, some, runs in zip(*(b.column(c).to_pylist() for c in ("page", "text", "regions", "runs")), strict=True) for x in page(t or "", some, runs)]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))

    return r.join(a, "page", "left").mapInArrow(run, "page long, region int, x1 int, y1 int, x2 int, y2 int, usable int, blocked array<string>, n_lines int, size int, rounds int")
