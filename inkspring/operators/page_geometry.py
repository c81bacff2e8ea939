"""Bubble geometry of whole pages: candidates in, groups with their parts out, and text boxes mapped to them by position.

The masks of one page are worked out together (``groups``: fusion, repair, lobes, necks), each in its own bounds. They
travel on as columns of row runs, so that mapping is joins on rows of runs, spread over pages and rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkspring.operators import masks as M
from inkspring.operators import outlines as O
from inkspring.operators import runs as R
from inkspring.operators.graph import _cut
from inkspring.operators.stateful import in_parts

#: Pages whose masks a worker holds at a time: a page's runs take some 100 KB as Python's lists.
PAGES = 100

_RUNS = pa.list_(pa.list_(pa.int32()))
_SCHEMA = pa.schema([
    ("page", pa.int64()), ("group", pa.int32()), ("members", pa.list_(pa.int32())), ("bounds", pa.list_(pa.int32())), ("panels", pa.list_(pa.int32())), ("links", pa.int32()),
    *[(c, _RUNS) for c in ("refined", "observed", "inferred", "bridge", "tail")], ("parts", pa.list_(pa.struct([("part", pa.int32()), ("runs", _RUNS)]))),
])
_DDL = "page long, group int, members array<int>, bounds array<int>, panels array<int>, links int, " + ", ".join(f"{c} array<array<int>>" for c in ("refined", "observed", "inferred", "bridge", "tail")) + ", parts array<struct<part:int,runs:array<array<int>>>>"


def page_groups(candidates: list[tuple], panels: list[tuple], tails: list[tuple], dark: list[tuple], size: tuple[int, int], least: int, repair: int) -> Iterator[dict]:
    """Groups of one page: candidates that overlap are one mask, its short gaps are repaired where the page is not dark,
    its lobes are groups, and these are cut at their necks into parts."""
    width, height = size
    number = 0
    for members in M.fused([M.draw([b], width, height) for b in candidates]):
        seen = M.draw([candidates[i] for i in members], width, height)
        box = M.bounds(seen)
        if box is None:
            continue
        # everything happens within the bounds and a margin that closing needs
        x1, y1, x2, y2 = max(0, box[0] - 2 * repair), max(0, box[1] - 2 * repair), min(width, box[2] + 2 * repair), min(height, box[3] + 2 * repair)
        moved = lambda boxes, x=x1, y=y1: [(a - x, b - y, c - x, d - y) for a, b, c, d in boxes]
        seen = seen[y1:y2, x1:x2]
        added = M.repaired(seen, ~M.draw(moved(dark), x2 - x1, y2 - y1), repair)
        for lobe in M.lobes(seen | added, least):
            observed = seen & lobe
            if not observed.any():
                continue
            number += 1
            bodies, bridge, tail, links = M.partition(lobe, moved(tails), least=least)
            a, b, c, d = M.bounds(lobe)
            at = lambda m, x=x1, y=y1: M.runs(m, x, y)
            yield {
                "group": number, "members": members, "bounds": [a + x1, b + y1, c + x1, d + y1], "links": len(links),
                "panels": [k for k, p in enumerate(moved(panels)) if (M.draw([p], x2 - x1, y2 - y1) & observed).any()],
                "refined": at(lobe), "observed": at(observed), "inferred": at(added & lobe), "bridge": at(bridge), "tail": at(tail),
                "parts": [{"part": k, "runs": at(bodies == k)} for k in range(1, int(bodies.max(initial=0)) + 1) if (bodies == k).any()],
            }


def groups(pages: DataFrame, size: tuple[int, int], least: int = 40, repair: int = 2) -> DataFrame:
    """Groups of ``pages(page, candidates, panels, tails, dark)``: arrays of boxes [x1, y1, x2, y2], one row a page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_parts(batches, PAGES):
            lists = [[[tuple(x) for x in v or ()] for v in b.column(c).to_pylist()] for c in ("candidates", "panels", "tails", "dark")]
            made = [{"page": p} | g for p, *boxes in zip(b.column("page").to_pylist(), *lists, strict=True) for g in page_groups(*boxes, size, least, repair)]
            yield pa.RecordBatch.from_pylist(made, schema=_SCHEMA)

    # kept in the shared folder, as mapping and hints read the masks many times
    # a page is a small row and much work, so pages are dealt by their number, not by their bytes
    return _cut(R.dealt(pages.select("page", "candidates", "panels", "tails", "dark"), ["page"]).mapInArrow(run, _DDL))


def unrolled(rows: DataFrame, key: list[str], runs: Column) -> DataFrame:
    """(key, y, a, b) of a column of runs."""
    out = rows.select(*key, F.explode(runs).alias("_r"))
    return out.select(*key, *[F.col("_r")[i].alias(c) for i, c in enumerate(("y", "a", "b"))])


def _within(texts: DataFrame, runs: DataFrame, key: list[str]) -> DataFrame:
    """page, text, key, pixels: how much of a text box every mask of its page covers."""
    rows = texts.where("x1 < x2 and y1 < y2").select("page", "text", "x1", "x2", F.explode(F.sequence("y1", F.col("y2") - 1)).alias("y"))
    met = rows.join(runs, ["page", "y"]).where("a < x2 and x1 < b")
    return met.groupBy("page", "text", *key).agg(F.sum(F.least("b", "x2") - F.greatest("a", "x1")).alias("pixels"))


def mapped(texts: DataFrame, found: DataFrame, size: tuple[int, int], coverage: float = 0.80, margin: float = 0.15) -> DataFrame:
    """page, text, group, parts, status, coverage of ``texts(page, text, x1, y1, x2, y2)`` by their place alone.

    A box belongs to the group that covers at least ``coverage`` of it, if no other does and comes within ``margin``; its
    parts are those that it touches.
    """
    width, height = size
    cut = lambda c, most, how: F.greatest(F.lit(0), F.least(F.lit(most), how(c))).cast("int")
    boxes = texts.select("page", "text", cut("x1", width, F.floor).alias("x1"), cut("y1", height, F.floor).alias("y1"), cut("x2", width, F.ceil).alias("x2"), cut("y2", height, F.ceil).alias("y2"))
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    covered = _within(boxes, unrolled(found, ["page", "group"], F.col("refined")), ["group"])
    best = W.partitionBy("page", "text").orderBy(F.desc("pixels"), "group")
    two = covered.withColumn("_k", F.row_number().over(best)).where("_k <= 2").groupBy("page", "text").agg(F.max(F.when(F.col("_k") == 1, F.col("pixels"))).alias("_first"), F.max(F.when(F.col("_k") == 2, F.col("pixels"))).alias("_second"), F.max(F.when(F.col("_k") == 1, F.col("group"))).alias("_group"))
    parts = found.select("page", "group", F.explode("parts").alias("p")).select("page", "group", "p.part", "p.runs")
    touched = _within(boxes, unrolled(parts, ["page", "group", "part"], F.col("runs")), ["group", "part"]).groupBy("page", "text", F.col("group").alias("_group")).agg(F.array_sort(F.collect_list("part")).alias("_parts"))
    some = found.groupBy("page").agg(F.lit(True).alias("_some"))
    out = boxes.withColumn("_area", area).join(some, "page", "left").join(two, ["page", "text"], "left").join(touched, ["page", "text", "_group"], "left")
    share = F.try_divide(F.coalesce("_first", F.lit(0)), F.col("_area"))
    second = F.try_divide(F.coalesce("_second", F.lit(0)), F.col("_area"))
    status = F.when(F.col("_some").isNull(), "unmatched").when((F.col("x2") <= F.col("x1")) | (F.col("y2") <= F.col("y1")), "empty_box").when((share < coverage) | ((second >= coverage) & (share - second < margin)), "ambiguous_or_low_coverage").otherwise("matched")
    good = F.col("status") == "matched"
    return out.withColumn("status", status).select("page", "text", F.when(good, F.col("_group")).alias("group"), F.when(good, F.coalesce("_parts", F.array().cast("array<int>"))).otherwise(F.array().cast("array<int>")).alias("parts"), "status", F.when(good, F.round(share, 6)).alias("coverage"))


def effects_of(texts: DataFrame, effects: DataFrame, least: float = 0.25) -> DataFrame:
    """page, text, effects: how many effect boxes ``(page, x1, y1, x2, y2)`` cover at least a share of a text box."""
    e = effects.select("page", *[F.col(c).alias(f"_{c}") for c in ("x1", "y1", "x2", "y2")])
    over = lambda a, b: F.greatest(F.lit(0.0), F.least(F.col(f"{b}"), F.col(f"_{b}")) - F.greatest(F.col(a), F.col(f"_{a}")))
    area = F.greatest(F.lit(1.0), (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")))
    met = texts.join(e, "page").where(over("x1", "x2") * over("y1", "y2") / area >= least)
    return met.groupBy("page", "text").agg(F.count("*").alias("effects"))


def hints(found: DataFrame, size: tuple[int, int]) -> DataFrame:
    """page, group, part, shape, fraction, hint, rejected: style evidence of every part, from its masks alone."""
    key = ["page", "group", "part"]
    parts = found.select("page", "group", "observed", "inferred", F.explode("parts").alias("p")).select("page", "group", "p.part", "p.runs", "observed", "inferred")
    masks = {c: unrolled(parts, key, F.col(c)) for c in ("runs", "observed", "inferred")}
    share = R.support(masks["runs"], masks["observed"], masks["inferred"], key, *size)
    best = F.row_number().over(W.partitionBy(*key).orderBy(F.desc("area"), "ring"))
    outer = O.rings(masks["runs"], key, "page long, group int, part int").where("not hole").withColumn("_best", best).where("_best = 1")
    s = O.shape(O.measures("simple"))
    rows = outer.select(*key, s["shape"].alias("shape"), s["confidence"].alias("confidence")).withColumn("_hint", O.hint(F.col("shape"))).join(share, key)
    rows = rows.withColumn("rejected", O.rejections(F.col("fraction"), F.col("confidence"), F.col("_hint")))
    return rows.select(*key, "shape", F.round("fraction", 6).alias("fraction"), F.when(F.size("rejected") == 0, F.col("_hint")).alias("hint"), "rejected")
