"""Greedy page operators against plain versions that follow each record through all rows kept so far."""

import random
from fractions import Fraction

from inkspring.operators import spatial as S
from inkspring.operators import stateful as T

BOX = "page long, ord int, x1 double, y1 double, x2 double, y2 double"


def random_pages(seed, n=25):
    rng = random.Random(seed)
    return [(p, k, float(x), float(y), float(x + rng.choice([0, 5, 20, 60])), float(y + rng.choice([3, 10, 40, 90, 250]))) for p in range(n) for k in range(rng.randint(0, 14)) for x, y in [(rng.randrange(0, 90, 5), rng.randrange(0, 120, 3))]]


def test_reading_order(spark):
    rows = random_pages(1)
    got = {(r["page"], r["ord"]): r["place"] for r in S.reading_order(spark.createDataFrame(rows, BOX)).collect()}
    for page in {r[0] for r in rows}:
        boxes = sorted((r for r in rows if r[0] == page), key=lambda r: (r[3], -r[4], r[1]))
        shelves = []
        for b in boxes:
            reach = max(8, min(40, (b[5] - b[3]) * 0.2))
            for shelf in shelves:
                if abs(shelf[0][3] - b[3]) <= reach:
                    shelf.append(b)
                    break
            else:
                shelves.append([b])
        flat = [b for s in shelves for b in sorted(s, key=lambda b: (-b[4], b[3], b[1]))]
        assert [got.pop((page, b[1])) for b in flat] == list(range(len(flat)))
    assert not got


def test_a_tall_box_reaches_back_to_the_first_shelf_that_fits(spark):
    rows = [(1, 0, 50.0, 0.0, 60.0, 20.0), (1, 1, 0.0, 12.0, 20.0, 30.0), (1, 2, 30.0, 14.0, 45.0, 214.0)]
    got = {r["ord"]: r["place"] for r in S.reading_order(spark.createDataFrame(rows, BOX)).collect()}
    assert got == {0: 0, 2: 1, 1: 2}


def test_suppression(spark):
    rng = random.Random(2)
    rows = [(*r, rng.choice([0.2, 0.5, 0.5, 0.9])) for r in random_pages(3)]
    got = {(r["page"], r["ord"]): r["kept"] for r in S.suppressed(spark.createDataFrame(rows, BOX + ", confidence double"), 0.3).collect()}
    overlap = lambda a, b: max(Fraction(0), min(Fraction(a[4]), Fraction(b[4])) - max(Fraction(a[2]), Fraction(b[2]))) * max(Fraction(0), min(Fraction(a[5]), Fraction(b[5])) - max(Fraction(a[3]), Fraction(b[3])))
    area = lambda a: Fraction(a[4] - a[2]) * Fraction(a[5] - a[3])
    for page in {r[0] for r in rows}:
        left, kept = [r for r in rows if r[0] == page], []
        while left:
            best = max(left, key=lambda r: (r[6], -r[1]))
            left.remove(best)
            if area(best) and all(overlap(best, k) / max(Fraction(1), area(best) + area(k) - overlap(best, k)) < Fraction(3, 10) for k in kept):
                kept.append(best)
        assert {r[1] for r in kept} == {o for (p, o), good in got.items() if p == page and good}
    assert len(got) == len(rows)


def test_page_plan():
    """Best pair first, again and again, until no pair may be taken."""
    rng = random.Random(6)
    for _ in range(200):
        candidates = [{"panel": rng.randrange(3) if d % 2 else 0, "detection": d, "person": p, "score": rng.choice([1.0, 2.0, 2.0, 3.0])} for d in range(rng.randint(0, 6)) for p in range(rng.randint(1, 4))]
        for c in candidates:
            c["panel"] = next(x["panel"] for x in candidates if x["detection"] == c["detection"])
        open_, want = list(candidates), {c["detection"]: None for c in candidates}
        while open_:
            best = min(open_, key=lambda c: (c["score"], c["detection"], c["person"]))
            want[best["detection"]] = best["person"]
            open_ = [c for c in open_ if c["detection"] != best["detection"] and not (c["panel"] == best["panel"] and c["person"] == best["person"])]
        assert {r["detection"]: r["person"] for r in T.page_plan(candidates)} == want
