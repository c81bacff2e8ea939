"""Spatial operators. Tables of panels (p_ columns) and texts (t_ columns) are joined on their page, never crossed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspring.functions import boxes as B


def best_panel(texts: DataFrame, panels: DataFrame) -> DataFrame:
    """The panel with the largest overlap of each text box; ties to the lowest panel, none without overlap."""
    best = texts.join(panels, "page").withColumn("s", B.shared("t_", "p_")).where("s > 0")
    best = best.groupBy("page", "t_ord").agg(F.max_by("p_ord", F.struct("s", -F.col("p_ord"))).alias("panel"))
    return texts.select("page", "t_ord").join(best, ["page", "t_ord"], "left")


def smallest_around_centre(texts: DataFrame, panels: DataFrame) -> DataFrame:
    """The smallest panel that holds the centre of each text box."""
    x, y = (F.col("t_x1") + F.col("t_x2")) / 2, (F.col("t_y1") + F.col("t_y2")) / 2
    held = texts.join(panels, "page").where(x.between(F.col("p_x1"), F.col("p_x2")) & y.between(F.col("p_y1"), F.col("p_y2")))
    best = held.groupBy("page", "t_ord").agg(F.min_by("p_ord", F.struct(B.area("p_"), "p_ord")).alias("panel"))
    return texts.select("page", "t_ord").join(best, ["page", "t_ord"], "left")


def panel_mapping(texts: DataFrame, panels: DataFrame, least: float = 0.1) -> DataFrame:
    """Per page: the panel of the first box if it covers enough of it, else the one with most coverage in all; and all."""
    pairs = texts.join(panels, "page").select("page", "t_ord", "p_ord", B.shared("t_", "p_").alias("s"), B.coverage("t_", "p_").alias("cov"))
    first = texts.groupBy("page").agg(F.min("t_ord").alias("first_ord"))
    lead = pairs.join(first, "page").where((F.col("t_ord") == F.col("first_ord")) & (F.col("cov") >= least))
    lead = lead.groupBy("page").agg(F.max_by("p_ord", F.struct("s", -F.col("p_ord"))).alias("lead"))
    total = pairs.where("cov > 0").groupBy("page", "p_ord").agg(F.round(F.sum("cov"), 9).alias("c"))
    best = total.groupBy("page").agg(F.max_by("p_ord", F.struct("c", -F.col("p_ord"))).alias("most"), F.array_join(F.sort_array(F.collect_list("p_ord")), ",").alias("panels"))
    return first.join(lead, "page", "left").join(best, "page", "left").select("page", F.coalesce("lead", "most").alias("panel"), F.coalesce("panels", F.lit("")).alias("panels"))


def map_with_margin(texts: DataFrame, panels: DataFrame, least: float, margin: float) -> DataFrame:
    """The panel that covers a text best if the runner-up is a margin behind; else all candidates."""
    pairs = texts.join(panels, "page").select("page", "t_ord", "p_ord", B.coverage("t_", "p_").alias("cov")).where(F.col("cov") >= least)
    ranked = pairs.groupBy("page", "t_ord").agg(F.array_sort(F.collect_list(F.struct((-F.col("cov")).alias("k"), "p_ord"))).alias("c"))
    clear = (F.size("c") == 1) | (F.get("c", F.lit(1))["k"] - F.get("c", F.lit(0))["k"] >= margin)
    out = texts.select("page", "t_ord").join(ranked, ["page", "t_ord"], "left")
    return out.select(
        "page", "t_ord", F.when(F.col("c").isNull(), "unmatched").when(clear, "matched").otherwise("ambiguous").alias("status"), F.when(clear, F.get("c", F.lit(0))["p_ord"]).alias("panel"),
        F.coalesce(F.array_join(F.array_sort(F.transform("c", lambda x: x["p_ord"])), ","), F.lit("")).alias("candidates"),
    )


def _by_page(boxes: DataFrame, fn: Callable[[list[dict]], list[tuple]], name: str, kind: str) -> DataFrame:
    """page, ord and ``name``: ``fn`` gets the boxes of a page (by ord) and gives (ord, value) pairs.

    A page is one row with an array of its boxes, so a batch holds many pages and no page costs a group of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(page, *x) for page, group in zip(b.column("page").to_pylist(), b.column("rows").to_pylist(), strict=True) for x in fn(group)]
            yield pa.RecordBatch.from_pylist([{"page": p, "ord": o, name: v} for p, o, v in rows], schema=out)

    out = pa.schema([("page", pa.int64()), ("ord", pa.int32()), (name, {"int": pa.int32(), "boolean": pa.bool_()}[kind])])
    cols = ["ord", *[c for c in boxes.columns if c not in ("page", "ord")]]
    pages = boxes.groupBy("page").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("rows"))
    return pages.mapInArrow(run, f"page long, ord int, {name} {kind}")


def _iou(a: dict, b: dict) -> float:
    s = max(0.0, min(a["x2"], b["x2"]) - max(a["x1"], b["x1"])) * max(0.0, min(a["y2"], b["y2"]) - max(a["y1"], b["y1"]))
    return s / max(1.0, (a["x2"] - a["x1"]) * (a["y2"] - a["y1"]) + (b["x2"] - b["x1"]) * (b["y2"] - b["y1"]) - s)


def fused_boxes(boxes: DataFrame, least: float) -> DataFrame:
    """Connected components of the boxes of a page by overlap (union-find), named by their smallest box."""

    def label(rows: list[dict]) -> list[tuple]:
        root = {r["ord"]: r["ord"] for r in rows}

        def find(i: int) -> int:
            while root[i] != i:
                i = root[i]
            return i

        for n, a in enumerate(rows):
            for b in rows[n + 1 :]:
                if _iou(a, b) >= least:
                    x, y = find(a["ord"]), find(b["ord"])
                    root[max(x, y)] = min(x, y)
        return [(r["ord"], find(r["ord"])) for r in rows]

    return _by_page(boxes, label, "component", "int")


def reading_order(boxes: DataFrame) -> DataFrame:
    """page, ord, place: rows of boxes are gathered greedily from the top, each read from right to left.

    A box joins the first row whose first box has its top within a tolerance of the box's own: a fifth of its height, 8 to 40.
    """

    def order(boxes: list[dict]) -> list[tuple]:
        rows: list[list[dict]] = []
        for r in sorted(boxes, key=lambda r: (r["y1"], -r["x2"], r["ord"])):
            reach = min(40.0, max(8.0, 0.2 * (r["y2"] - r["y1"])))
            # tops of first boxes rise, so the rows within reach are the last ones
            k = len(rows)
            while k and r["y1"] - rows[k - 1][0]["y1"] <= reach:
                k -= 1
            if k < len(rows):
                rows[k].append(r)
            else:
                rows.append([r])
        flat = [r for row in rows for r in sorted(row, key=lambda r: (-r["x2"], r["y1"], r["ord"]))]
        return [(r["ord"], k) for k, r in enumerate(flat)]

    return _by_page(boxes, order, "place", "int")


def suppressed(boxes: DataFrame, threshold: float) -> DataFrame:
    """page, ord, kept: greedy suppression by falling confidence (ties: lowest ord); a box without area is not kept."""

    def nms(rows: list[dict]) -> list[tuple]:
        kept: list[dict] = []
        out = []
        for r in sorted(rows, key=lambda r: (-r["confidence"], r["ord"])):
            good = r["x2"] > r["x1"] and r["y2"] > r["y1"] and all(_iou(r, k) < threshold for k in kept)
            out.append((r["ord"], good))
            if good:
                kept.append(r)
        return out

    return _by_page(boxes, nms, "kept", "boolean")
