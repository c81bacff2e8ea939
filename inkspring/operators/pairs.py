"""Distances of all pairs within a key, by pairs of blocks: no key is gathered in one task, no pair is a row.

Every key is dealt by a hash of the row's id into up to ``BLOCKS`` blocks of ``BLOCK`` rows, which then grow to ``MOST``
rows before there are more of them; one task takes a pair of blocks and aggregates its distances before anything is
shuffled. The work is that of all pairs; rows out grow with rows times blocks.

Defined cases: null vectors have no distances; a row is no pair with itself, nor with a row of the same id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspring.operators.registry import unit

#: Rows of a block, blocks of a key before they grow, rows of a grown block, and distances that are held at once.
BLOCK, BLOCKS, MOST, CELLS = 1024, 12, 32_768, 1 << 20


def by_block_pairs(rows: DataFrame, key: str, ident: str, vector: str, fn: Callable, schema: str, block: int = BLOCK) -> DataFrame:
    """``fn(key, left, right)`` for every pair of blocks of a key: (ids, vectors) in order of ids; right is None within one block."""
    r = rows.where(F.col(vector).isNotNull()).select(F.col(key).alias("_k"), F.col(ident).alias("_id"), F.col(vector).alias("_v"))
    n = F.count("*")
    sizes = r.groupBy("_k").agg(F.greatest(F.least(F.ceil(n / block), F.lit(BLOCKS)), F.ceil(n / MOST)).cast("int").alias("_g"))
    r = r.join(F.broadcast(sizes), r["_k"].eqNullSafe(sizes["_k"])).drop(sizes["_k"]).withColumn("_b", F.pmod(F.xxhash64("_id"), F.col("_g")).cast("int"))
    r = r.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_g") - 1)))
    r = r.select("_k", F.least("_b", "_o").alias("_i"), F.greatest("_b", "_o").alias("_j"), (F.col("_b") > F.col("_o")).alias("_right"), "_id", "_v")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_id", kind="stable")
        sides = [(s["_id"].to_numpy(), np.stack(s["_v"].to_numpy()).astype(np.float64)) for _, s in group.groupby("_right")] if group["_i"].iloc[0] != group["_j"].iloc[0] else [(group["_id"].to_numpy(), np.stack(group["_v"].to_numpy()).astype(np.float64))]
        if len(sides) == 1 and group["_i"].iloc[0] != group["_j"].iloc[0]:  # the other block is empty
            return fn(group["_k"].iloc[0], None, None)
        return fn(group["_k"].iloc[0], sides[0], sides[1] if len(sides) > 1 else None)

    return r.groupBy("_k", "_i", "_j").applyInPandas(run, schema)


def direct(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of rows that stand side by side."""
    out = np.empty(len(x))
    for i in range(0, len(x), 65_536):
        out[i : i + 65_536] = np.sqrt(((x[i : i + 65_536] - y[i : i + 65_536]) ** 2).sum(axis=1))
    return out


def rounded(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All distances to 5 places; those that a product leaves open are taken from the differences."""
    nx, ny = (x * x).sum(axis=1), (y * y).sum(axis=1)
    d = np.sqrt(np.maximum(nx[:, None] + ny[None] - 2 * (x @ y.T), 0))
    e = 1e-14 * (nx.max(initial=0) + ny.max(initial=0))
    units = d * 1e5
    near = np.abs(units - np.floor(units) - 0.5) <= 1e5 * e / np.maximum(d, np.sqrt(e) + 1e-300)
    if near.any():
        i, j = np.nonzero(near)
        for a in range(0, len(i), 65_536):
            p, q = i[a : a + 65_536], j[a : a + 65_536]
            units[p, q] = direct(x[p], y[q]) * 1e5
    return np.rint(units) / 1e5


def _steps(left: tuple, right: tuple | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, distances, which of them are pairs) for some rows of the left block at a time."""
    ids, x = left
    others, y = right or left
    step = max(16, CELLS // max(1, len(others)))
    for i in range(0, len(ids), step):
        a = ids[i : i + step]
        yield i, rounded(x[i : i + step], y), (a[:, None] != others[None]) if right else (a[:, None] < others[None])


def links(rows: DataFrame, ident: str, vector: str, limit: float, block: int = BLOCK) -> DataFrame:
    """a, b: links that join all rows nearer than ``limit`` (a spanning forest of each pair of blocks)."""

    def run(_, left, right):
        if left is None:
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        n = len(left[0])
        ids = np.concatenate([left[0], right[0]]) if right else left[0]
        top = np.arange(len(ids))
        shift = n if right else 0
        for i, d, _ in _steps(left, right):
            hit = d < limit
            cols = np.flatnonzero(hit.any(axis=0))
            if not len(cols):
                continue
            hit = hit[:, cols]
            first = hit.argmax(axis=0)
            # a column joins all rows that hit it: rows are linked where they share a column
            near = hit.astype(np.float32)
            p, q = np.nonzero(np.triu(near @ near.T > 0, 1))
            a, b = np.concatenate([first + i, p + i]), np.concatenate([cols + shift, q + i])
            open_ = top[a] != top[b]
            for u, v in zip(top[a[open_]].tolist(), top[b[open_]].tolist(), strict=True):
                while top[u] != u:
                    u = top[u]
                while top[v] != v:
                    v = top[v]
                top[max(u, v)] = min(u, v)
            while not np.array_equal(top, top[top]):
                top = top[top]
        tied = np.flatnonzero(top != np.arange(len(ids)))
        return pd.DataFrame({"a": ids[top[tied]], "b": ids[tied]})

    return by_block_pairs(rows.withColumn("_all", F.lit(0)), "_all", ident, vector, run, "a long, b long", block)


def spread(rows: DataFrame, key: str, ident: str, vector: str, limit: float, block: int = BLOCK) -> DataFrame:
    """key, d, n, near, a, b: how many pairs have each distance, and the least pair of each pair of blocks on one row."""

    def run(k, left, right):
        counts: dict[float, int] = {}
        least = None
        for i, d, pair in _steps(left, right) if left else ():
            if not pair.any():
                continue
            x, y = left[0][i : i + len(d)], (right or left)[0]
            for v, n in zip(*(c.tolist() for c in np.unique(d[pair], return_counts=True)), strict=True):
                counts[v] = counts.get(v, 0) + n
            low = np.nanmin(np.where(pair, d, np.inf))
            p, q = np.nonzero(pair & (d == low))
            if len(p):
                a, b = np.minimum(x[p], y[q]), np.maximum(x[p], y[q])
                best = np.lexsort((b, a))[0]
                least = min(least or (np.inf, 0, 0), (low, a[best], b[best]))
        out = pd.DataFrame({"k": k, "d": list(counts), "n": list(counts.values())})
        first = (out["d"] == least[0]) if least else np.zeros(len(out), bool)
        out["a"] = pd.array([least[1] if f else None for f in first], dtype="Int64")
        out["b"] = pd.array([least[2] if f else None for f in first], dtype="Int64")
        return out

    kind = dict(rows.dtypes)[key]
    made = by_block_pairs(rows, key, ident, vector, run, f"k {kind}, d double, n long, a long, b long", block)
    return made.select(F.col("k").alias(key), "d", "n", F.when(F.col("d") < limit, F.col("n")).otherwise(0).alias("near"), "a", "b")


def closest(rows: DataFrame, key: str, ident: str, vector: str, size: int, units: bool = False, block: int = BLOCK) -> DataFrame:
    """key, id, near: the ``size`` nearest others of every row as sorted (d, id), from the nearest within each pair of blocks.

    ``d`` has 5 places; with ``units`` vectors are brought to unit length first and distances are not rounded.
    """

    def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        # products of copies differ in the last digits
        return np.sqrt(np.round(np.maximum(2 - 2 * (x @ y.T), 0), 12)) if units else rounded(x, y)

    def side(k, left, right):
        ids, x = left
        others, y = right or left
        x, y = (unit(x), unit(y)) if units else (x, y)
        step = max(16, CELLS // max(1, len(others)))
        ds, names = [], []
        for i in range(0, len(ids), step):
            d = distances(x[i : i + step], y)
            d[ids[i : i + step][:, None] == others[None]] = np.inf
            # ids are in order, so a stable sort leaves equal distances to the lower ids
            at = np.argsort(d, axis=1, kind="stable")[:, :size]
            best = np.take_along_axis(d, at, axis=1)
            ds += [r[np.isfinite(r)] for r in best]
            names += [others[w[np.isfinite(r)]] for r, w in zip(best, at, strict=True)]
        return pd.DataFrame({"k": k, "id": ids, "d": ds, "o": names})

    def run(k, left, right):
        if left is None:
            return pd.DataFrame({"k": [], "id": [], "d": [], "o": []})
        return side(k, left, None) if right is None else pd.concat([side(k, left, right), side(k, right, left)])

    made = by_block_pairs(rows, key, ident, vector, run, f"k {dict(rows.dtypes)[key]}, id long, d array<double>, o array<long>", block)
    near = F.flatten(F.collect_list(F.zip_with("d", "o", lambda d, o: F.struct(d.alias("d"), o.alias("id")))))
    return made.groupBy(F.col("k").alias(key), "id").agg(F.slice(F.array_sort(near), 1, size).alias("near"))


#: Parts of a vector's copies where rows are joined with their neighbours: many rows may share one neighbour.
SALTS = 32


def consensus(rows: DataFrame, key: str, ident: str, vector: str, size: int, block: int = BLOCK) -> DataFrame:
    """key, mean: the unit mean of the most compact group of ``size`` among all vectors of a key (a vector and its nearest others).

    The ids of a key are unique. Groups are weighed one by one where they lie; a key is never gathered.
    """
    near = closest(rows, key, ident, vector, size - 1, True, block)
    members = near.select(key, "id", F.explode(F.array_append(F.transform("near", lambda x: x["id"]), F.col("id"))).alias("_m"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("_s"))
    salted = rows.where(F.col(vector).isNotNull()).select(F.col(key), F.col(ident).alias("_m"), F.col(vector).alias("_v"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_s"))
    groups = members.join(salted, [key, "_m", "_s"]).groupBy(key, "id").agg(F.array_sort(F.collect_list(F.struct("_m", "_v"))).alias("g"))
    kind = dict(rows.dtypes)[key]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            g = b.column("g")
            sizes, flat = np.diff(g.offsets.to_numpy()), g.flatten()
            ids = flat.field("_m").to_numpy()
            x = unit(flat.field("_v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1))
            scores, names, means = [], [], []
            for start, n in zip(np.concatenate([[0], np.cumsum(sizes)[:-1]]).tolist(), sizes.tolist(), strict=True):
                v = x[start : start + n]
                mean = v.mean(axis=0)
                length = np.linalg.norm(mean)
                scores.append(round(float(np.sqrt(((v[:, None] - v[None]) ** 2).sum(axis=2)).sum()) / max(1, n * (n - 1)), 12))
                names.append(ids[start : start + n])
                means.append(mean / length if length > 1e-12 else v[0])
            cols = [b.column(key), pa.array(scores, pa.float64()), pa.array(names, pa.list_(pa.int64())), pa.array(means, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, [key, "score", "ids", "mean"])

    weighed = groups.select(key, "g").mapInArrow(weigh, f"{key} {kind}, score double, ids array<long>, mean array<double>")
    return weighed.groupBy(key).agg(F.min_by("mean", F.struct("score", "ids")).alias("mean"))
