"""Run-length masks against drawn pages, rings against the pixels they enclose, growth against known answers."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from inkspring.operators import outlines as O
from inkspring.operators import regions as G
from inkspring.operators import runs as R
from inkspring.plans import page_masks as P

W, H = 40, 30


def pages(seed, n=6):
    """Random masks by page: boxes, single pixels and holes."""
    rng = random.Random(seed)
    out = {}
    for p in range(n):
        m = np.zeros((H, W), bool)
        for _ in range(rng.randint(0, 5)):
            x, y = rng.randrange(W), rng.randrange(H)
            m[y : y + rng.randint(1, 14), x : x + rng.randint(1, 18)] = True
        for _ in range(30):
            m[rng.randrange(H), rng.randrange(W)] ^= True
        out[p] = m
    return out


def runs_of(masks):
    rows = []
    for p, m in masks.items():
        for y, row in enumerate(m):
            edges = np.flatnonzero(np.diff(np.pad(row.astype(int), 1)))
            rows += [(p, y, int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return rows


def frame(spark, masks):
    return spark.createDataFrame(runs_of(masks), "page long, y int, a int, b int")


def drawn(df, n):
    rows = [tuple(r) for r in df.select("page", "y", "a", "b").collect()]
    assert len(rows) == len(set(rows))
    masks = {p: np.zeros((H, W), bool) for p in range(n)}
    for p, y, a, b in rows:
        assert not masks[p][y, a:b].any()
        masks[p][y, a:b] = True
    assert sorted(rows) == sorted(runs_of(masks)), "runs are as long as can be"
    return masks


def shifted(m, cells, fill=False):
    out = []
    for dx, dy in cells:
        s = np.full((H, W), fill)
        s[max(0, -dy) : min(H, H - dy), max(0, -dx) : min(W, W - dx)] = m[max(0, dy) : H + min(0, dy), max(0, dx) : W + min(0, dx)]
        out.append(s)
    return np.stack(out)


def disk(r):
    return [(dx, dy) for dx in range(-r, r + 1) for dy in range(-r, r + 1) if dx * dx + dy * dy <= r * r]


def diamond(r):
    return [(dx, dy) for dx in range(-r, r + 1) for dy in range(-r, r + 1) if abs(dx) + abs(dy) <= r]


def same(got, want):
    assert all((got[p] == want[p]).all() for p in want)


@pytest.mark.parametrize("r", [0, 1, 3])
def test_morphology(spark, r):
    a = pages(r)
    df, n = frame(spark, a), len(a)
    same(drawn(R.eroded(df, ["page"], r), n), {p: shifted(m, disk(r)).all(axis=0) for p, m in a.items()})
    same(drawn(R.dilated(df, ["page"], r, W, H), n), {p: shifted(m, disk(r)).any(axis=0) for p, m in a.items()})
    same(drawn(R.spread(df, ["page"], r, W, H), n), {p: shifted(m, diamond(r)).any(axis=0) for p, m in a.items()})


def test_algebra_refinement_and_support(spark):
    a, b, c = pages(11), pages(12), pages(13)
    (x, y, z), n, key = (frame(spark, m) for m in (a, b, c)), len(a), ["page"]
    same(drawn(R.union(key, x, y), n), {p: a[p] | b[p] for p in a})
    same(drawn(R.intersection(key, x, y, z), n), {p: a[p] & b[p] & c[p] for p in a})
    same(drawn(R.minus(key, x, y, z), n), {p: a[p] & ~b[p] & ~c[p] for p in a})
    same(drawn(R.eroded(x, key, 2, y), n), {p: shifted(a[p], disk(2)).all(axis=0) & ~b[p] for p in a})
    closed = {p: shifted(shifted(m, disk(2)).any(axis=0), disk(2)).all(axis=0) for p, m in a.items()}
    same(drawn(R.refined(x, y, key, 2, W, H), n), {p: closed[p] & b[p] & ~a[p] for p in a})
    edge = lambda m: m & ~shifted(m, diamond(1)).all(axis=0)
    got = {r["page"]: r["fraction"] for r in R.support(x, y, z, key, W, H).collect()}
    for p in a:
        own = edge(a[p])
        if own.any():
            want = own & shifted(edge(b[p]), diamond(2)).any(axis=0) & ~shifted(c[p], diamond(3)).any(axis=0)
            assert got[p] == pytest.approx(want.sum() / own.sum())
    assert len(got) == sum(m.any() for m in a.values())


@pytest.mark.parametrize("made", [lambda m: R.eroded(m, ["page"], 3, m), lambda m: R.dilated(m, ["page"], 3, 99, 99), lambda m: R.spread(m, ["page"], 3, 99, 99), lambda m: R.from_boxes(m.selectExpr("page", "a x1", "y y1", "b x2", "y + 9 y2"), ["page"])])
def test_rows_of_disks_and_boxes_are_not_shuffled(spark, made):
    """What a disk or a box made of a run was shuffled, row by row, and the ends of all rows once more."""
    plan = made(spark.createDataFrame([(1, 2, 3, 9)], "page long, y int, a int, b int"))._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Generate", 1)
    assert "Exchange" not in above and "Exchange" in below


def test_nearest_against_all_pairs(spark):
    a, b = pages(21), pages(22)
    got = {(r["page"]): r["d2"] for r in R.nearest(frame(spark, a).selectExpr("*", "1 AS piece"), frame(spark, b).selectExpr("*", "2 AS body"), ["page"], "piece", "body").collect()}
    for p in a:
        s, t = np.argwhere(a[p]), np.argwhere(b[p])
        if len(s) and len(t):
            assert got.pop(p) == ((s[:, None] - t[None]) ** 2).sum(axis=2).min()
    assert not got


def filled(rings):
    """Pixels inside an odd number of rings."""
    m = np.zeros((H, W), bool)
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if x1 == x2:
                m[min(y1, y2) : max(y1, y2), x1:] ^= True
    return m


def test_rings_give_the_mask_again(spark):
    a = {p: m for s in (31, 32, 33) for p, m in ((p + 10 * s, m) for p, m in pages(s).items())}
    by = defaultdict(list)
    for r in O.rings(frame(spark, a), ["page"], "page long").collect():
        points = [tuple(p) for p in r["points"]]
        assert abs(O.area(points)) == r["area"] and (O.area(points) < 0) == r["hole"]
        by[r["page"]].append(points)
        for p in points:  # every corner lies within a pixel of the simplified ring
            s = [tuple(q) for q in r["simple"]]
            assert min(O._far(p, u, v) for u, v in zip(s, s[1:] + s[:1], strict=True)) <= 1.0 or len(s) <= 3
    for p, m in a.items():
        assert (filled(by[p]) == m).all()


def test_pixels_that_share_a_corner_have_rings_of_their_own():
    m = np.array([[1, 0], [0, 1]], bool)
    edges = [(x, y, x + 1, y) for y, x in np.argwhere(m)] + [(x + 1, y, x + 1, y + 1) for y, x in np.argwhere(m)] + [(x + 1, y + 1, x, y + 1) for y, x in np.argwhere(m)] + [(x, y + 1, x, y) for y, x in np.argwhere(m)]
    assert sorted(O.area(r) for r in O.linked([tuple(map(int, e)) for e in edges])) == [1, 1]


def ring(n, far, near=None):
    return [(100 + (far if i % 2 == 0 or near is None else near) * math.cos(2 * math.pi * i / n), 100 + (far if i % 2 == 0 or near is None else near) * math.sin(2 * math.pi * i / n)) for i in range(n)]


def test_shapes(spark):
    box = [(10, 10), (90, 10), (90, 50), (10, 50)]
    cases = {"rectangular": box, "rounded": ring(40, 50), "spiky": ring(24, 60, 25), "unknown": [(0, 0), (5, 0), (5, 5), (0, 5)], "irregular": [(0, 0), (100, 0), (100, 20), (20, 20), (20, 100), (0, 100)]}
    df = spark.createDataFrame([(k, [[float(c) for c in p] for p in v]) for k, v in cases.items()], "want string, points array<array<double>>")
    got = df.withColumn("m", O.measures("points")).withColumn("s", O.shape(P.F.col("m"))).collect()
    for r in got:
        assert r["s"]["shape"] == r["want"], r
        if r["m"] is None:
            continue
        points = cases[r["want"]]
        angles = np.linspace(0, np.pi / 2, 3_601)
        p = np.array(points)
        spans = [np.ptp(p @ np.array([np.cos(t), np.sin(t)])) * np.ptp(p @ np.array([-np.sin(t), np.cos(t)])) for t in angles]
        assert r["m"]["rectangularity"] == pytest.approx(abs(O.area(points)) / min(spans), rel=1e-3)
        sides = [math.dist(a, b) for a, b in zip(points, points[1:] + points[:1], strict=True)]
        assert r["m"]["circularity"] == pytest.approx(4 * math.pi * abs(O.area(points)) / sum(sides) ** 2)
        # the hull's area by its support function, as a sum over directions
        t = np.linspace(0, 2 * np.pi, 20_001)[:-1]
        h = (p @ np.stack([np.cos(t), np.sin(t)])).max(axis=0)
        hull = 0.5 * (h * h - np.gradient(h, t[1]) ** 2).mean() * 2 * np.pi
        assert r["m"]["solidity"] == pytest.approx(abs(O.area(points)) / hull, rel=2e-2)
    # a star's points and the corners between them, by the sides of the triangle at each
    star = cases["spiky"]
    sharp = sum(math.degrees(math.acos((a * a + b * b - c * c) / (2 * a * b))) < 65 for i in range(len(star)) for a, b, c in [(math.dist(star[i], star[i - 1]), math.dist(star[i], star[(i + 1) % 24]), math.dist(star[i - 1], star[(i + 1) % 24]))])
    assert {r["want"]: r["m"] and r["m"]["acute"] for r in got}["spiky"] == sharp >= 12


def test_rejections(spark):
    F = P.F
    rows = [(1.0, 0.85, "caption", []), (0.5, 0.85, "caption", ["too_much_inferred_boundary"]), (0.8, 0.6, "thought", ["visual_support_below_acceptance", "cloud_shape_without_independent_border_evidence"]), (0.8, 0.9, None, ["no_distinctive_visual_style"])]
    df = spark.createDataFrame(rows, "fraction double, confidence double, hint string, want array<string>")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", O.rejections(F.col("fraction"), F.col("confidence"), F.col("hint"))).collect())


def allowed(x1, y1, x2, y2):
    return G.Allowed([(y, x1, x2) for y in range(y1, y2)])


def region(name, box, **more):
    return {"id": name, "box": list(box), "blocked": {}, "ax": (box[0] + box[2]) / 2, "ay": (box[1] + box[3]) / 2, **more}


def test_a_blocked_side_does_not_stop_the_others():
    r = region("a", [10, 40, 70, 70])
    changes = G.grown([r], {"a"}, allowed(10, 10, 170, 110), (180, 120))
    assert r["box"] == [10, 38, 72, 72] and r["blocked"] == {"left": "body_margin_boundary"} and {c[1] for c in changes} == {"right", "up", "down"}


def test_the_gap_to_a_neighbour_and_the_edge_of_the_page():
    a, b = region("a", [20, 20, 80, 80]), region("b", [90, 20, 150, 80])
    G.grown([a, b], {"a", "b"}, allowed(0, 0, 200, 100), (200, 100))
    assert a["blocked"] == {"right": "neighbor_gap"} and b["blocked"] == {"left": "neighbor_gap"} and G.gap(a["box"], b["box"]) >= 10
    c = region("c", [0, 20, 30, 60])
    G.grown([c], {"c"}, allowed(0, 0, 200, 100), (200, 100))
    assert c["blocked"] == {"left": "image_edge"}
    G.grown([c], set(), allowed(0, 0, 200, 100), (200, 100))
    assert c["box"] == [0, 18, 32, 62]


def grown_plainly(boxes, who, mask, step=2, least=10):
    """The same rounds on drawn masks, to the end."""
    blocked = {k: {} for k in boxes}
    moved = True
    while moved:
        moved = False
        for k in who:
            for side, (at, d) in {"left": (0, -step), "right": (2, step), "up": (1, -step), "down": (3, step)}.items():
                if side in blocked[k]:
                    continue
                new = list(boxes[k])
                new[at] = min(max(new[at] + d, 0), mask.shape[1 - at % 2])
                area = lambda b: mask[b[1] : b[3], b[0] : b[2]].sum()
                near = any(math.hypot(max(0, new[0] - o[2], o[0] - new[2]), max(0, new[1] - o[3], o[1] - new[3])) < least for j, o in boxes.items() if j != k)
                why = "image_edge" if new == boxes[k] else "neighbor_gap" if near else "body_margin_boundary" if area(new) == area(boxes[k]) else None
                if why:
                    blocked[k][side] = why
                else:
                    boxes[k], moved = new, True
    return boxes, blocked


@pytest.mark.parametrize("seed", range(12))
def test_growth_to_the_end_against_drawn_masks(seed):
    rng = random.Random(seed)
    mask = np.zeros((90, 120), bool)
    for _ in range(4):
        x, y = rng.randrange(90), rng.randrange(60)
        mask[y : y + rng.randint(10, 50), x : x + rng.randint(10, 60)] = True
    boxes = {k: [x, y, x + rng.randint(4, 20), y + rng.randint(4, 20)] for k in range(3) for x, y in [(rng.randrange(100), rng.randrange(70))]}
    rows = [region(k, b) for k, b in boxes.items()]
    held = G.Allowed([(y, a, b) for _, y, a, b in runs_of({0: mask})])
    while G.grown(rows, {0, 2}, held, (120, 90)):
        pass
    want, blocked = grown_plainly(boxes, (0, 2), mask)
    assert {r["id"]: r["box"] for r in rows} == want and {r["id"]: r["blocked"] for r in rows} == blocked
    assert all(held.area(r["box"]) == mask[r["box"][1] : r["box"][3], r["box"][0] : r["box"][2]].sum() for r in rows)


def test_text_that_fits_grows_nothing_and_text_that_does_not_grows_until_it_fits():
    two = [region("a", [20, 30, 110, 120], words="one two three four".split()), region("b", [130, 30, 280, 120], words="five six seven eight nine ten".split())]
    size, rounds = G.expanded(two, allowed(10, 10, 290, 150), (300, 160), (8, 20))
    assert size and not rounds and all(r["lines"] for r in two) and two[0]["box"] == [20, 30, 110, 120]
    one = [region("a", [30, 50, 75, 85], words="one two three four five six".split())]
    size, rounds = G.expanded(one, allowed(10, 10, 210, 170), (220, 180), (24, 24))
    assert size == 24 and rounds > 0 and " ".join(t for t, _, _ in one[0]["lines"]) == "one two three four five six"
    assert all(x >= 10 and x + G.text_width(len(t), 24) <= 210 for t, x, _ in one[0]["lines"])


def test_near_regions_stay_and_a_body_that_is_used_up_ends_the_growth():
    near = [region("a", [20, 30, 50, 50], words="one two three".split()), region("b", [54, 30, 84, 50], words="four five six".split())]
    assert G.expanded(near, allowed(0, 0, 130, 100), (130, 100), (40, 40)) == (None, 0)
    assert [r["box"] for r in near] == [[20, 30, 50, 50], [54, 30, 84, 50]] and all(set(r["blocked"].values()) == {"nearby_ocr_region"} and len(r["blocked"]) == 4 for r in near)
    full = [region("a", [30, 30, 50, 50], words=["unbreakable" * 30])]
    size, rounds = G.expanded(full, allowed(10, 10, 80, 80), (90, 90), (24, 24))
    assert size is None and rounds > 0 and full[0]["box"] == [10, 10, 80, 80] and set(full[0]["blocked"].values()) == {"body_margin_boundary"}


def test_slots_on_rows_and_in_one_group_agree(spark, sf):
    parts, runs = P.safe(spark, sf)
    got = defaultdict(list)
    for r in G.slots(runs, parts.selectExpr("*", "9 AS size"), P.PART).collect():
        got[r["page"], r["part"]].append((r["y"], r["x1"], r["x2"]))
    held = defaultdict(list)
    for r in runs.collect():
        held[r["page"], r["part"]].append((r["y"], r["a"], r["b"]))
    anchors = {(r["page"], r["part"]): r["ax"] for r in parts.collect()}
    assert len(held) > 20
    for k, rows in held.items():
        assert sorted(got[k]) == G.Allowed(rows).lines([0, 0, P.WIDTH, P.HEIGHT], 9, anchors[k], 1.6)


def fits(words, slots, size, ay):
    """All ways to fill slots from one on, word by word."""
    ways = []
    for start in range(len(slots)):
        lines, i = [], 0
        for y, x1, x2 in slots[start:]:
            n = max((j for j in range(i, len(words) + 1) if len(" ".join(words[i:j])) * size / 2 <= x2 - x1 - 2), default=i)
            if n == i or i == len(words):
                break
            text = " ".join(words[i:n])
            lines.append((text, (x1 + x2 - len(text) * size / 2) / 2, y))
            i = n
        if i == len(words) and lines:
            ways.append((len(lines), abs((lines[0][2] + lines[-1][2] + -(-size * 6 // 5)) / 2 - ay), start, lines))
    return min(ways)[3] if ways else None


def test_mask_fit_against_all_sizes(spark, sf):
    import json

    parts, runs = P.safe(spark, sf)
    held = defaultdict(list)
    for r in runs.collect():
        held[r["page"], r["part"]].append((r["y"], r["a"], r["b"]))
    at = {(r["page"], r["part"]): (r["ax"], r["ay"]) for r in parts.collect()}
    texts = {(r["page"], r["part"]): r["text"] for r in P.bubbles(spark, sf).groupBy(*P.PART).agg(P.F.min_by("text", "ord").alias("text")).collect()}
    got = {(r["page"], r["part"]): (r["size"], [(x["text"], x["x"], x["y"]) for x in json.loads(r["lines"])]) for r in P.mask_fit(spark, sf).collect()}
    want = {}
    for k, rows in held.items():
        words = texts[k].split()[:6]
        for size in range(P.SIZES[1], P.SIZES[0] - 1, -1):
            lines = fits(words, G.Allowed(rows).lines([0, 0, P.WIDTH, P.HEIGHT], size, at[k][0], 1.6), size, at[k][1])
            if lines:
                want[k] = (size, lines)
                break
    assert got == want and len(want) > 10


def test_grown_layout_keeps_to_the_page(spark, sf):
    rows = P.grown_layout(spark, sf).collect()
    regions, _, free = P._regions(spark, sf)
    start = {(r["page"], r["source"]): r for r in regions.where("page_issue is null").collect()}
    held = defaultdict(list)
    for r in free.collect():
        held[r["page"]].append((r["y"], r["a"], r["b"]))
    assert rows and {(r["page"], r["region"]) for r in rows} <= set(start)
    for r in rows:
        s = start[r["page"], r["region"]]
        assert r["x1"] <= s["x1"] and r["y1"] <= s["y1"] and r["x2"] >= s["x2"] and r["y2"] >= s["y2"]
        assert r["usable"] == G.Allowed(held[r["page"]]).area([r["x1"], r["y1"], r["x2"], r["y2"]]) >= s["usable"]


def test_odd_regions(spark):
    src = spark.createDataFrame([(1, 0, None, 2.5, 2.5, 9.5, 9.5, 0), (1, 1, None, 8.2, 2.0, 14.0, 9.0, 1), (2, 0, None, -5.0, -5.0, 3.0, 3.0, 0), (3, 0, None, 5.0, 5.0, 5.4, 9.0, 0)], "page long, source int, part int, x1 double, y1 double, x2 double, y2 double, reading_order int")
    free = spark.createDataFrame([(p, y, 0, 20) for p in (1, 2, 3) for y in range(20)], "page long, y int, a int, b int")
    regions, _ = G.text_regions(free, src, 20, 20)
    got = {(r["page"], r["source"]): (r["x1"], r["x2"], r["usable"], r["issue"], r["page_issue"]) for r in regions.collect()}
    assert got[2, 0] == (0, 3, 9, None, None) and got[3, 0] == (5, 5, 0, "empty", "empty")
    assert got[1, 0] == (3, 9, 36, None, None) and got[1, 1] == (9, 14, 35, None, None)
    over = src.where("page = 1").selectExpr("page", "source", "part", "x1 - source AS x1", "y1", "x2", "y2", "reading_order")
    assert {r["source"]: (r["issue"], r["page_issue"]) for r in G.text_regions(free, over, 20, 20)[0].collect()} == {0: (None, "overlaps"), 1: ("overlaps", "overlaps")}
    empty = spark.createDataFrame([], "page long, part int, y int, a int, b int")
    parts, runs = G.safe_parts(empty, [free], src, 3, 0.1)
    assert parts.count() == 0 and runs.count() == 0


def test_anchors_and_margins_of_parts(spark):
    bodies = spark.createDataFrame([(1, k, y, 10, 60) for k in (0, 1, 2) for y in range(10, 50)] + [(2, 0, y, 0, 9) for y in range(9)], "page long, part int, y int, a int, b int")
    src = spark.createDataFrame([(1, 0, 12.0, 12.0, 20.0, 20.0, 3), (1, 0, 22.0, 12.0, 30.0, 20.0, 2), (1, 1, 40.0, 40.0, 44.0, 48.0, 1), (1, None, 0.0, 0.0, 2.0, 2.0, 0)], "page long, part int, x1 double, y1 double, x2 double, y2 double, reading_order int")
    gone = spark.createDataFrame([(1, 20, 0, 35)], "page long, y int, a int, b int")
    parts, runs = G.safe_parts(bodies, [gone], src, 3, 0.12)
    got = {(r["page"], r["part"]): r for r in parts.collect()}
    assert [(got[1, k]["ax"], got[1, k]["ay"], got[1, k]["reading_order"], got[1, k]["place"]) for k in (0, 1, 2)] == [(21.0, 16.0, 2, 3), (42.0, 44.0, 1, 2), (21.25, 19.25, 0, 1)]
    assert got[1, 0]["margin"] == 5 and (got[2, 0]["margin"], got[2, 0]["area"], got[2, 0]["ax"]) == (3, 9, 4.5)
    m = np.zeros((60, 70), bool)
    m[10:50, 10:60] = True
    want = np.stack([np.roll(np.roll(m, dy, 0), dx, 1) for dx, dy in disk(5)]).all(axis=0)
    want[20, :35] = False
    assert got[1, 0]["area"] == want.sum() == sum(r["b"] - r["a"] for r in runs.where("page = 1 and part = 0").collect())


def test_groups_of_drawn_pages(spark):
    """One page by hand: two bars with a gap that is repaired, two lobes with a neck, a tail, a far bubble."""
    from inkspring.operators import page_geometry as PG

    page = (1, [[10, 10, 40, 40], [42, 10, 70, 40], [12, 12, 38, 38], [100, 10, 130, 40], [130, 22, 140, 26], [140, 10, 170, 40]], [[0, 0, 90, 100], [90, 0, 200, 100]], [], [])
    kind = "page long, candidates array<array<int>>, panels array<array<int>>, tails array<array<int>>, dark array<array<int>>"
    df = spark.createDataFrame([page, (2, [], [], [], []), (3, [[5, 5, 5, 9], [-4, -4, 20, 20]], None, [[0, 0, 3, 3]], [])], kind)
    rows = {(r["page"], r["group"]): r for r in PG.groups(df, (200, 100), least=40, repair=2).collect()}
    assert {k for k in rows} == {(1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (3, 1)}
    assert rows[1, 1]["members"] == [0, 2] and rows[1, 1]["bounds"] == [10, 10, 40, 40] and rows[1, 1]["panels"] == [0] and rows[3, 1]["bounds"] == [0, 0, 20, 20]
    joined = (4, [[10, 10, 40, 40], [11, 10, 41, 40], [10, 41, 41, 70]], [], [], [])
    one = PG.groups(spark.createDataFrame([joined], kind), (200, 100), least=40, repair=2).collect()
    assert sorted(len(r["members"]) for r in one) == [1, 2]


def test_a_worker_holds_the_masks_of_few_pages(monkeypatch):
    """A batch of 10,000 pages came back as one, some 126 KB a page as Python's lists."""
    import pyarrow as pa

    from inkspring.operators import page_geometry as PG

    class Pages:
        select = lambda self, *_: self
        mapInArrow = lambda self, run, _: run  # noqa: E731, N815

    n = 2 * PG.PAGES + 1
    box = pa.list_(pa.list_(pa.int32()))
    batch = pa.record_batch([pa.array(range(n), pa.int64()), pa.array([[[2, 2, 20, 20]]] * n, box), *[pa.array([[]] * n, box)] * 3], ["page", "candidates", "panels", "tails", "dark"])
    monkeypatch.setattr(PG, "_cut", lambda run: run)
    monkeypatch.setattr(PG.R, "dealt", lambda rows, _: rows)
    out = list(PG.groups(Pages(), (32, 32))(iter([batch])))
    assert [b.num_rows for b in out] == [PG.PAGES, PG.PAGES, 1]
    assert [p for b in out for p in b.column("page").to_pylist()] == list(range(n))


def test_mapping_against_drawn_masks(spark, sf):
    """Coverage, status and parts of every text box again from drawn masks."""
    from inkspring.operators import page_geometry as PG

    found = PG.groups(P._pages(spark, sf), (P.WIDTH, P.HEIGHT))

    def mask(runs):
        m = np.zeros((P.HEIGHT, P.WIDTH), bool)
        for y, a, b in runs:
            m[y, a:b] = True
        return m

    by = defaultdict(list)
    for r in found.collect():
        whole, bodies = mask(r["refined"]), {p["part"]: mask(p["runs"]) for p in r["parts"]}
        seen, added, bridge, tail = (mask(r[c]) for c in ("observed", "inferred", "bridge", "tail"))
        parts = sum((b.astype(int) for b in bodies.values()), np.zeros_like(whole, int)) + bridge + tail
        assert (parts == whole).all() and ((seen | added) == whole).all() and not (seen & added).any()
        assert r["bounds"] == [int(v) for v in (*np.argwhere(whole).min(axis=0)[::-1], *(np.argwhere(whole).max(axis=0)[::-1] + 1))]
        by[r["page"]].append((r["group"], whole, bodies))
    boxes = P.text_boxes(P.bubbles(spark, sf)).collect()
    got = {(r["page"], r["text"]): (r["group"], list(r["parts"]), r["status"], r["coverage"]) for r in PG.mapped(P.text_boxes(P.bubbles(spark, sf)).withColumnRenamed("source", "text"), found, (P.WIDTH, P.HEIGHT)).collect()}
    states = set()
    for t in boxes:
        x1, y1, x2, y2 = max(0, math.floor(t["x1"])), max(0, math.floor(t["y1"])), min(P.WIDTH, math.ceil(t["x2"])), min(P.HEIGHT, math.ceil(t["y2"]))
        share = sorted(((m[y1:y2, x1:x2].mean(), -g) for g, m, _ in by[t["page"]]), reverse=True)
        if not share:
            want = (None, [], "unmatched", None)
        elif share[0][0] < 0.8 or (len(share) > 1 and share[1][0] >= 0.8 and share[0][0] - share[1][0] < 0.15):
            want = (None, [], "ambiguous_or_low_coverage", None)
        else:
            g = -share[0][1]
            want = (g, [k for n, _, b in by[t["page"]] if n == g for k, m in sorted(b.items()) if m[y1:y2, x1:x2].any()], "matched", round(float(share[0][0]), 6))
        states.add(want[2])
        assert got[t["page"], t["source"]] == want
    assert states == {"matched", "ambiguous_or_low_coverage"} and len(got) == len(boxes)


def test_masks_of_small_pages_against_pixels():
    """Components, holes, repair and fill plans of the drawn version, pixel by pixel."""
    from collections import deque

    from inkspring.operators import masks as M

    rng = np.random.default_rng(5)
    for _ in range(40):
        m = rng.random((12, 15)) < rng.uniform(0.2, 0.8)
        seen, n = np.zeros(m.shape, int), 0
        for y, x in np.argwhere(m):
            if not seen[y, x]:
                n += 1
                queue = deque([(y, x)])
                seen[y, x] = n
                while queue:
                    p, q = queue.popleft()
                    for u, v in ((p + 1, q), (p - 1, q), (p, q + 1), (p, q - 1)):
                        if 0 <= u < 12 and 0 <= v < 15 and m[u, v] and not seen[u, v]:
                            seen[u, v] = n
                            queue.append((u, v))
        ids, count = M.labelled(m)
        assert count == n and (ids == seen).all()
        free = {(y, x) for y in range(-1, 13) for x in range(-1, 16) if not (0 <= y < 12 and 0 <= x < 15 and m[y, x])}
        out, todo = {(-1, -1)}, [(-1, -1)]
        while todo:
            p, q = todo.pop()
            for c in ((p + 1, q), (p - 1, q), (p, q + 1), (p, q - 1)):
                if c in free and c not in out:
                    out.add(c)
                    todo.append(c)
        assert (M.filled(m) == np.array([[(y, x) not in out for x in range(15)] for y in range(12)])).all()
        white = rng.random(m.shape) < 0.7
        pad = np.pad(m, 2)
        wide = np.array([[any(pad[y + 2 + dy, x + 2 + dx] for dx, dy in disk(2)) for x in range(15)] for y in range(12)])
        pad = np.pad(wide, 2)
        closed = np.array([[all(pad[y + 2 + dy, x + 2 + dx] for dx, dy in disk(2)) for x in range(15)] for y in range(12)])
        assert (M.repaired(m, white, 2) == (closed & white & ~m)).all() and not M.repaired(m, white, 0).any()
        ring = [(y, x) for y in range(12) for x in range(15) if not m[y, x] and any(0 <= y + dy < 12 and 0 <= x + dx < 15 and m[y + dy, x + dx] for dx, dy in disk(1))]
        bright = [white[p] for p in ring]
        assert M.fill_plan(white, m, 0.6) == ("review" if not m.any() else "white_fill" if bright and np.mean(bright) >= 0.6 else "repaint")
