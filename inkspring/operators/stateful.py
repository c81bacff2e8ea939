"""Sequential operators: folds and allocations that no window expresses. One row holds one sequence, batches hold many."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_parts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, at most so many at a time."""
    for b in batches:
        for i in range(0, b.num_rows, most):
            yield b.slice(i, most)


def folded(rows: DataFrame, key: str, order: list[str], fn: Callable[[list[dict]], list[dict]], schema: str, out: pa.Schema) -> DataFrame:
    """``fn`` gets the rows of a key in order and gives rows; the key is added to them."""
    rest = [c for c in rows.columns if c not in (key, *order)]
    seq = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order, *rest))).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [{key: k} | r for k, group in zip(b.column(key).to_pylist(), b.column("rows").to_pylist(), strict=True) for r in fn(group)]
            yield pa.RecordBatch.from_pylist(made, schema=out)

    return seq.mapInArrow(run, schema)


def folded_together(rows: DataFrame, key: str, order: list[str], fn: Callable[[int, np.ndarray, dict[str, np.ndarray]], tuple[np.ndarray, dict]], schema: str, out: pa.Schema, most: int = 2_000) -> DataFrame:
    """As ``folded``, for whole-number columns and many keys at a time: ``fn(n, of, columns)`` gets the rows of n keys in order
    (``of``: which key, ascending) and gives, for rows of its own, which key and their columns. A row with a null is left out."""
    rest = [c for c in rows.columns if c not in (key, *order)]
    seq = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order, *rest))).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_parts(batches, most):
            lists = b.column("rows")
            flat, of = lists.flatten(), np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            cols = {f.name: c for f, c in zip(flat.type, flat.flatten(), strict=True)}
            good = np.logical_and.reduce([c.is_valid().to_numpy(zero_copy_only=False) for c in cols.values()])
            at, made = fn(b.num_rows, of[good], {k: c.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[good] for k, c in cols.items()})
            yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(at)), *[pa.array(made[f.name], f.type) for f in list(out)[1:]]], schema=out)

    return seq.mapInArrow(run, schema)


def admission(samples: list[dict], start: int = 2, most: int = 32) -> list[dict]:
    """Additive increase, multiplicative decrease of a concurrency limit over metric samples {t, load, done, queued}.

    The limit halves when the load reaches 0.9 (not within 30 s of the last cut), falls to 1 after two missing samples,
    and grows by 1 after a window of 10 s with two completions, load under 0.8 and work waiting.
    """
    limit, missing, cut, opened, finished = start, 0, float("-inf"), None, 0
    out = []
    for s in samples:
        t, load = s["t"], s["load"]
        if load is None:
            missing += 1
            if missing >= 2:
                limit, opened, finished = 1, None, 0
        else:
            missing = 0
            opened = t if opened is None else opened
            finished += s["done"]
            if load >= 0.9:
                if t - cut >= 30:
                    limit, cut = max(1, limit // 2), t
                opened, finished = t, 0
            elif t - opened >= 10 and finished >= 2 and load < 0.8 and s["queued"] > 0:
                limit, opened, finished = min(most, limit + 1), t, 0
        out.append({"t": t, "limit": limit})
    return out


def page_plan(candidates: list[dict]) -> list[dict]:
    """Greedy assignment on a page from {panel, detection, person, score}: the best pair first, a person once a panel.

    A detection gets one person; ties go to the lower detection, then person.
    """
    taken: set[tuple] = set()
    given: dict[int, int] = {}
    for c in sorted(candidates, key=lambda c: (c["score"], c["detection"], c["person"])):
        if c["detection"] not in given and (c["panel"], c["person"]) not in taken:
            given[c["detection"]] = c["person"]
            taken.add((c["panel"], c["person"]))
    return [{"detection": d, "person": given.get(d)} for d in sorted({c["detection"] for c in candidates})]


def allocate(sizes: list[int], areas: list[float]) -> list[list[int]]:
    """Consecutive word ranges per region so that shares of characters are nearest to shares of area (squares summed)."""
    total, room = sum(sizes) or 1, sum(areas) or 1.0
    run = [0]
    for s in sizes:
        run.append(run[-1] + s)
    # the whole run is an array; best paths are compared where costs are equal
    shares = np.array(run, dtype=float)
    cost = np.full(len(run), np.inf)
    cost[0] = 0.0
    paths: list[tuple] = [()] * len(run)
    for area in areas:
        want = area / room
        now, before = np.empty(len(run)), []
        for j in range(len(run)):
            c = cost[: j + 1] + ((shares[j] - shares[: j + 1]) / total - want) ** 2
            now[j] = c.min()
            i = min(np.flatnonzero(c == now[j]).tolist(), key=lambda i: (*paths[i], (i, j)))
            before.append((*paths[i], (i, j)))
        cost, paths = now, before
    return [list(r) for r in paths[-1]]


def fit_lines(words: list[str], slots: list[float], size: float) -> list[list[str]] | None:
    """Words filled greedily into line slots at a glyph width of ``size``; None if they do not fit."""
    lines: list[list[str]] = []
    rest = list(words)
    for width in slots:
        line: list[str] = []
        while rest and (sum(map(len, line)) + len(line) + len(rest[0])) * size <= width:
            line.append(rest.pop(0))
        if line:
            lines.append(line)
    return None if rest else lines


def largest_size(words: list[str], slots: list[float], sizes: list[int]) -> int | None:
    """The first size, from the largest down, at which the words fit."""
    return next((s for s in sorted(sizes, reverse=True) if fit_lines(words, slots, s) is not None), None)


def pack(strata: list[tuple[int, int]], budget: int) -> list[int]:
    """How many rows each (priority, rows) stratum keeps: the least important shrinks by quarters until all fit."""
    keep = [n for _, n in strata]
    for i in sorted(range(len(strata)), key=lambda i: (-strata[i][0], i)):
        while sum(keep) > budget and keep[i]:
            keep[i] = max(0, min(keep[i] - 1, int(0.75 * keep[i])))
    return keep
