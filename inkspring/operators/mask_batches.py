"""Masks of many small pages at once: a row of a page is the bits of one number, and what belongs together is found over
the row runs of all pages of a batch. ``operators.masks`` says the same of one page at a time, pixel by pixel.

A batch is an array (pages, height) of unsigned numbers, bit x of [i, y] the pixel (x, y) of page i.
"""

from __future__ import annotations

import numpy as np

#: Moves that a piece may lie from a body and still touch it.
REACH = 2


def kind(width: int) -> type:
    """The smallest number that holds a row."""
    return next(t for t, bits in ((np.uint16, 16), (np.uint32, 32), (np.uint64, 64)) if width <= bits)


def _ones(n: np.ndarray, to: type) -> np.ndarray:
    """Numbers with the lowest n bits set; n may be the whole width."""
    most = np.iinfo(to).bits
    return np.where(n > 0, to(np.iinfo(to).max) >> np.clip(most - n, 0, most - 1).astype(to), to(0))


def cut(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, width: int, height: int) -> tuple[np.ndarray, ...]:
    """Boxes without what lies beyond the page; one without a pixel there has no extent at all."""
    x1, x2, y1, y2 = np.clip(x1, 0, width), np.clip(x2, 0, width), np.clip(y1, 0, height), np.clip(y2, 0, height)
    some = (x1 < x2) & (y1 < y2)
    return tuple(np.where(some, c, 0).astype(np.int64) for c in (x1, y1, x2, y2))


def draw(boxes: tuple[np.ndarray, ...], of: np.ndarray, n: int, width: int, height: int) -> np.ndarray:
    """Unions of half-open boxes (as ``cut`` gives them) of n pages; ``of`` is the page of each, in ascending order."""
    x1, y1, x2, y2 = boxes
    out = np.zeros((n, height), kind(width))
    if len(of):
        row = _ones(x2, out.dtype.type) & ~_ones(x1, out.dtype.type)
        first = np.flatnonzero(np.diff(of, prepend=-1))
        y = np.arange(height)[:, None]
        rows = np.where((y >= y1) & (y < y2), row, out.dtype.type(0))
        out[of[first]] = np.bitwise_or.reduceat(rows, first, axis=1).T
    return out


def area(m: np.ndarray) -> np.ndarray:
    return np.bitwise_count(m).sum(axis=1, dtype=np.int64)


def _half_widths(radius: int) -> list[tuple[int, int]]:
    return [(dy, int(np.sqrt(radius * radius - dy * dy))) for dy in range(-radius, radius + 1)]


def _moved(m: np.ndarray, dy: int) -> np.ndarray:
    """Every row dy further down; clear rows come in."""
    out = np.zeros_like(m)
    out[:, max(0, dy) : m.shape[1] + min(0, dy)] = m[:, max(0, -dy) : m.shape[1] + min(0, -dy)]
    return out


def dilated(m: np.ndarray, radius: int, width: int) -> np.ndarray:
    every, wide, done, out = _ones(np.array(width), m.dtype.type), m, 0, np.zeros_like(m)
    for dy, w in sorted(_half_widths(radius), key=lambda s: s[1]):
        for k in range(done + 1, w + 1):
            wide = wide | (m << k) | (m >> k)
        done = max(done, w)
        out |= _moved(wide, dy) & every
    return out


def eroded(m: np.ndarray, radius: int) -> np.ndarray:
    """What lies beyond the page is clear."""
    narrow, done, out = m, 0, None
    for dy, w in sorted(_half_widths(radius), key=lambda s: s[1]):
        for k in range(done + 1, w + 1):
            narrow = narrow & (m << k) & (m >> k)
        done = max(done, w)
        row = _moved(narrow, dy)
        out = row if out is None else out & row
    return out


def opened(m: np.ndarray, radius: int, width: int) -> np.ndarray:
    return dilated(eroded(m, radius), radius, width)


def padded(m: np.ndarray, by: int, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (by, by))).astype(kind(width + 2 * by)) << by


def _within(m: np.ndarray, by: int, like: np.ndarray, width: int) -> np.ndarray:
    """The page within its padding."""
    return ((m >> by) & _ones(np.array(width), m.dtype.type))[:, by : by + like.shape[1]].astype(like.dtype)


def closed(m: np.ndarray, radius: int, width: int) -> np.ndarray:
    wide = padded(m, radius, width)
    return _within(eroded(dilated(wide, radius, width + 2 * radius), radius), radius, m, width)


class Runs:
    """Row runs of a batch in reading order: page, y, a, b (half-open), and keys that keep rows and pages apart."""

    def __init__(self, m: np.ndarray):
        pages, height = m.shape
        flat = np.ascontiguousarray(m).ravel()
        rows = np.flatnonzero(flat)
        bits = m.dtype.itemsize * 8
        set_ = flat[rows]
        at = lambda x: np.flatnonzero(np.unpackbits(np.ascontiguousarray(x).view(np.uint8), bitorder="little"))
        starts, stops = at(set_ & ~(set_ << 1)), at(set_ & ~(set_ >> 1))
        row = rows[starts // bits]
        self.page, self.y = np.divmod(row, height)
        self.a, self.b = starts % bits, stops % bits + 1
        self.step = bits + 2 * REACH + 1
        row = self.page * (height + 2 * REACH) + self.y
        self.begin, self.end = row * self.step + self.a, row * self.step + self.b
        self.cells = self.b - self.a

    def __len__(self) -> int:
        return len(self.a)

    def meeting(self, other: Runs, dy: int, w: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (run here, run of ``other`` dy rows below) of one page that share a column, when this one is w wider at both ends."""
        low = np.searchsorted(other.end, self.begin + dy * self.step - w, "right")
        high = np.searchsorted(other.begin, self.end + dy * self.step + w, "left")
        n = np.maximum(high - low, 0)
        i = np.repeat(np.arange(len(self)), n)
        return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + low[i]

    def bits(self, to: type) -> np.ndarray:
        return _ones(self.b, to) & ~_ones(self.a, to)


def joined(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest of the n things that each one is joined with by pairs (i, j), over any number of them."""
    root = np.arange(n)
    while len(i):
        p, q = root[i], root[j]
        apart = p != q
        if not apart.any():
            break
        i, j, p, q = i[apart], j[apart], p[apart], q[apart]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        # the ends of chains; a root stands below all that it is the root of
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
    return root


def labelled(m: np.ndarray) -> tuple[Runs, np.ndarray, np.ndarray]:
    """(runs, component of each run, page of each component): four-connected, numbered from 0 in reading order."""
    runs = Runs(m)
    first, of = np.unique(joined(len(runs), *runs.meeting(runs, 1)), return_inverse=True)
    return runs, of, runs.page[first]


def holes(m: np.ndarray, width: int) -> np.ndarray:
    """Clear pixels that no path of clear pixels joins to the border."""
    every = _ones(np.array(width + 2), kind(width + 2))
    clear = every & ~padded(m, 1, width)
    runs, of, page = labelled(clear)
    # the component of a page's first pixel, which lies beyond the border, comes first
    outside = np.zeros(len(page), bool)
    outside[np.flatnonzero(np.diff(page, prepend=-1))] = True
    inside = ~outside[of]
    out = np.zeros_like(clear)
    np.bitwise_or.at(out, (runs.page[inside], runs.y[inside]), runs.bits(out.dtype.type)[inside])
    return _within(out, 1, m, width)


def components(m: np.ndarray) -> np.ndarray:
    """How many components each page has."""
    return np.bincount(labelled(m)[2], minlength=len(m))


class Partition:
    """A batch of masks cut at their necks, as ``masks.partition`` cuts one: for each page the number of ``bodies``, cells
    of the ``bridge`` and the ``tail``, the number of ``links``, and for each body of it (``page``, ``body`` from 1) its ``cells``.

    ``hit`` is the mask of tail boxes of each page. A piece's body depends on the pieces before it, so the first pieces of
    all pages are settled together, then the second ones and so on; they only look at what lies within reach of them.
    """

    def __init__(self, m: np.ndarray, hit: np.ndarray, width: int, neck: float = 0.05, least: int = 12):
        n, size = len(m), area(m)
        radius = np.clip(np.rint(np.sqrt(size) * neck), 2, 16).astype(int)
        core = np.zeros_like(m)
        for r in np.unique(radius):
            core[radius == r] = opened(m[radius == r], int(r), width)
        runs, of, page = labelled(core)
        large = np.bincount(of, runs.cells, len(page)) >= least
        body = np.where(large, np.cumsum(large), 0)
        before = np.concatenate([[0], np.cumsum(np.bincount(page[large], minlength=n))])
        bodies = np.diff(before)
        none = bodies == 0
        body = np.where(large, body - before[page], 0)
        held = np.zeros_like(m)
        keep = body[of] > 0
        np.bitwise_or.at(held, (runs.page[keep], runs.y[keep]), runs.bits(m.dtype.type)[keep])
        # a mask without a body of its own is one body, whole
        rest = np.where(none[:, None], 0, m & ~held).astype(m.dtype)
        pieces, piece, at = labelled(rest)
        cells = np.bincount(piece, pieces.cells, len(at)).astype(np.int64)
        is_hit = np.bincount(piece, (pieces.bits(m.dtype.type) & hit[pieces.page, pieces.y]) != 0, len(at)) > 0
        # what lies within reach of a piece: cores (known by now) and pieces before it
        known, earlier = [], []
        for dy in range(-REACH, REACH + 1):
            i, j = pieces.meeting(runs, dy, REACH - abs(dy))
            known.append(piece[i] * (len(page) + 1) + of[j])
            i, j = pieces.meeting(pieces, dy, REACH - abs(dy))
            i, j = piece[i], piece[j]
            earlier.append((i * (len(at) + 1) + j)[j < i])
        k, c = np.divmod(np.unique(np.concatenate(known)), len(page) + 1)
        low, high = np.full(len(at), np.iinfo(np.int64).max), np.zeros(len(at), np.int64)
        k, c = k[body[c] > 0], c[body[c] > 0]
        np.minimum.at(low, k, body[c])
        np.maximum.at(high, k, body[c])
        late, early = np.divmod(np.unique(np.concatenate(earlier)), len(at) + 1)
        place = np.arange(len(at)) - np.searchsorted(at, at)
        order = np.argsort(place[late], kind="stable")
        late, early = late[order], early[order]
        turns = np.argsort(place, kind="stable")
        rounds = place.max(initial=-1) + 1
        ends, pairs = np.searchsorted(place[turns], np.arange(rounds + 1)), np.searchsorted(place[late], np.arange(rounds + 1))
        got = np.zeros(len(at), np.int64)  # the body that a piece grows or is; 0 for a bridge, -1 for a tail
        count = bodies.copy()
        links = np.zeros(n, np.int64)
        for r in range(rounds):
            now = turns[ends[r] : ends[r + 1]]
            i, b = late[pairs[r] : pairs[r + 1]], got[early[pairs[r] : pairs[r + 1]]]
            i, b = i[b > 0], b[b > 0]
            np.minimum.at(low, i, b)
            np.maximum.at(high, i, b)
            lo, hi = low[now], high[now]
            bridge, one, own = (hi > 0) & (lo < hi), (lo == hi) & ~is_hit[now], (hi == 0) & (cells[now] >= least)
            new = now[own]
            count[at[new]] += 1
            links[at[now[bridge]]] += 1
            got[now] = np.select([bridge, one, own], [0, hi, count[at[now]]], -1)
        total = lambda which: np.bincount(at[which], cells[which], n).astype(np.int64)
        self.bridge, self.tail, self.links = total(got == 0), total(got == -1), links
        self.bodies = np.where(none & (size > 0), 1, count)
        ends = np.concatenate([[0], np.cumsum(self.bodies)])
        self.page = np.repeat(np.arange(n), self.bodies)
        self.body = np.arange(ends[-1]) - ends[self.page] + 1
        whole = np.where(none & (size > 0))[0]
        sizes = np.bincount(ends[page[of]][keep] + body[of][keep] - 1, runs.cells[keep], ends[-1])
        sizes += np.bincount(ends[at[got > 0]] + got[got > 0] - 1, cells[got > 0], ends[-1])
        sizes[ends[whole]] = size[whole]
        self.cells = sizes.astype(np.int64)


def together(boxes: tuple[np.ndarray, ...], of: np.ndarray, overlap: float = 0.5, inside: float = 0.8) -> np.ndarray:
    """For boxes of pages (as ``cut`` gives them, ``of`` ascending) the first box of the group that each is fused into."""
    x1, y1, x2, y2 = boxes
    own = (x2 - x1) * (y2 - y1)
    i_, j_ = [], []
    i = np.arange(len(of))
    for d in range(1, len(of)):
        i = i[i + d < len(of)]
        i = i[of[i] == of[i + d]]
        if not len(i):
            break
        j = i + d
        both = np.maximum(0, np.minimum(x2[i], x2[j]) - np.maximum(x1[i], x1[j])) * np.maximum(0, np.minimum(y2[i], y2[j]) - np.maximum(y1[i], y1[j]))
        near = (both / np.maximum(1, own[i] + own[j] - both) >= overlap) | (both / np.maximum(1, np.minimum(own[i], own[j])) >= inside)
        i_.append(i[near])
        j_.append(j[near])
    return joined(len(of), np.concatenate(i_), np.concatenate(j_)) if i_ else np.arange(len(of))
