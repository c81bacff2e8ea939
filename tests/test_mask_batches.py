"""Masks of many pages at once against the plain version of one page."""

import random

import numpy as np
import pytest

from inkspring.operators import mask_batches as B
from inkspring.operators import masks as M
from inkspring.plans import rasters as R
from inkspring.registry import QUERIES


def pages(seed, n, w, h, most):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        at = [(rng.randint(-3, w), rng.randint(-3, h)) for _ in range(rng.randint(1, most))]
        out.append([(x, y, x + rng.randint(-1, w // 2), y + rng.randint(-1, h // 2)) for x, y in at])
    return out


def flat(some):
    cols = dict(zip(("x1", "y1", "x2", "y2"), np.array([b for p in some for b in p]).T, strict=True))
    return np.repeat(np.arange(len(some)), [len(p) for p in some]), cols | {"ord": np.concatenate([np.arange(1, len(p) + 1) for p in some])}


def bools(m, w):
    return ((m[:, :, None] >> np.arange(w).astype(m.dtype)) & 1).astype(bool)


@pytest.mark.parametrize("w, h, most", [(8, 16, 5), (32, 48, 7), (60, 60, 9)])
def test_batches_against_pages(w, h, most):
    some = pages(w, 120, w, h, most)
    of, c = flat(some)
    m, plain = R._drawn(len(some), of, c, w, h), [M.draw(p, w, h) for p in some]
    same = lambda got, fn: (bools(got, w) == np.stack([fn(p) for p in plain])).all()
    assert same(m, lambda p: p) and same(m | B.holes(m, w), M.filled) and same(B.closed(m, 1, w), lambda p: M.closed(p, 1))
    for r in (1, 2, 5):
        assert same(B.dilated(m, r, w), lambda p, r=r: M.dilated(p, r)) and same(B.eroded(m, r), lambda p, r=r: M.eroded(p, r))
    assert B.components(m).tolist() == [M.labelled(p)[1] for p in plain]


@pytest.mark.parametrize("w, h, most", [(32, 48, 7), (32, 48, 14), (60, 60, 9)])
def test_necks_against_pages(w, h, most):
    some = pages(most, 150, w, h, most)
    of, c = flat(some)
    tails = {k: np.array([p[0][i] for p in some]) for i, k in enumerate(("x1", "y1", "x2", "y2"))}
    got = B.Partition(R._drawn(len(some), of, c, w, h), R._drawn(len(some), np.arange(len(some)), tails, w, h), w)
    for i, p in enumerate(some):
        bodies, bridge, tail, links = M.partition(M.draw(p, w, h), p[:1])
        assert dict(zip(got.body[got.page == i].tolist(), got.cells[got.page == i].tolist(), strict=True)) == {k: int((bodies == k).sum()) for k in range(1, int(bodies.max()) + 1)}
        assert (got.bridge[i], got.tail[i], got.links[i]) == (bridge.sum(), tail.sum(), len(links))


def test_groups_against_pages():
    some = pages(5, 300, R.WIDE, R.HIGH, 9)
    at, got = R.pages_groups(len(some), *flat(some))
    rows = {}
    for i, *row in zip(at.tolist(), *[x.tolist() if isinstance(x, np.ndarray) else x.to_pylist() for x in got.values()], strict=True):
        rows.setdefault(i, []).append(tuple(row))
    for i, p in enumerate(some):
        assert rows.get(i, []) == [tuple(g.values()) for g in R.page_groups([dict(zip(("ord", "x1", "y1", "x2", "y2"), (o, *b), strict=True)) for o, b in enumerate(p, 1)])]


def _in_batches(spark, sf, monkeypatch, name):
    """A function for one page at a time took over a millisecond a page."""
    asked = []
    monkeypatch.setattr(R.S, "folded", lambda *a, **k: asked.append(a))
    assert QUERIES[name](spark, sf).count() > 0 and not asked


@pytest.mark.parametrize("name", ["M7_partition", "M8_refined_mask", "M10_build_groups", "M6_components_and_holes"])
def test_no_page_is_drawn_alone(spark, sf, monkeypatch, name):
    _in_batches(spark, sf, monkeypatch, name)
