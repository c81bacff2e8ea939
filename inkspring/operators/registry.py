"""Registries of identities: nearest matches, means, last-wins, overlays, versions."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F



def last_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order`` (a total one), with _times: how many rows the key has."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_b"), F.count("*").alias("_times"))
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in rest], "_times")


def overlaid(base: DataFrame, patch: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``base`` with fields replaced by those of ``patch`` (columns p_<field>) that are not null."""
    return base.join(patch, key, "left").select(key, *[F.coalesce(f"p_{f}", f).alias(f) for f in fields])


def reconciled(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key, value, conflict from ``old(key, old, confirmed)`` and ``new(key, new)``."""
    conflict = F.coalesce(F.col("confirmed") & F.col("new").isNotNull() & (F.col("new") != F.col("old")), F.lit(False))
    return old.join(new, key, "left").select(key, F.when(F.col("confirmed"), F.col("old")).otherwise(F.coalesce("new", "old")).alias("value"), conflict.alias("conflict"))


def versions(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from the one before, numbered from 1 within the key."""
    w = W.partitionBy(key).orderBy(*order)
    changed = rows.withColumn("_before", F.lag(value).over(w)).where(F.col("_before").isNull() | (F.col("_before") != F.col(value)))
    return changed.drop("_before").withColumn("version", F.row_number().over(w).cast("long"))


def means(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """key, mean: the mean vector of each key, summed on the executors."""
    each = rows.select(key, F.posexplode(vector).alias("i", "x")).groupBy(key, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return each.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("mean"))


#: Most anchors that one broadcast holds; more are compared in slices.
MAX_ANCHORS = 20_000


def _slices(anchors: DataFrame) -> Iterator[pd.DataFrame]:
    """The anchors in bounded slices, one at a time on the driver."""
    n = max(1, -(-anchors.count() // MAX_ANCHORS))
    for i in range(n):
        yield anchors.where(F.pmod(F.hash(*anchors.columns), F.lit(n)) == i).toPandas()


def _against(rows: DataFrame, anchors: DataFrame, name: str, vector: str) -> DataFrame:
    """vec_id, ``name``, d: the least distance of every row to each named anchor, by blocks of numpy."""
    out = None
    for part in _slices(anchors):
        if part.empty:
            continue
        names, group = np.unique(part[name].to_numpy(), return_inverse=True)
        shared = rows.sparkSession.sparkContext.broadcast((names, group, np.stack(part[vector].to_numpy()).astype(np.float64)))

        def run(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            names, group, anchors = shared.value
            for f in frames:
                if len(f):
                    x = np.stack(f["embedding"].to_numpy()).astype(np.float64)
                    near = np.full((len(x), len(names)), np.inf)
                    for j in range(len(anchors)):
                        near[:, group[j]] = np.minimum(near[:, group[j]], np.sqrt(((x - anchors[j]) ** 2).sum(axis=1)))
                    yield pd.DataFrame({"vec_id": np.repeat(f["vec_id"].to_numpy(), len(names)), name: np.tile(names, len(x)), "d": near.ravel()})

        kind = dict(anchors.dtypes)[name]
        got = rows.select("vec_id", "embedding").where("embedding is not null").mapInPandas(run, f"vec_id long, {name} {kind}, d double")
        out = got if out is None else out.unionByName(got)
    if out is None:
        return rows.sparkSession.createDataFrame([], f"vec_id long, {name} {dict(anchors.dtypes)[name]}, d double")
    return out.groupBy("vec_id", name).agg(F.round(F.min("d"), 5).alias("d"))


def nearest(rows: DataFrame, anchors: DataFrame, limit: float) -> DataFrame:
    """vec_id, person, distance: the person of the nearest anchor under ``limit``; ties to the lowest person."""
    d = _against(rows, anchors, "person", "embedding").where(F.col("d") < limit)
    return d.groupBy("vec_id").agg(F.min(F.struct("d", "person")).alias("b")).select("vec_id", "b.person", F.col("b.d").alias("distance"))


def scores(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """vec_id, candidate, score, place: every candidate's distance, ranked."""
    d = _against(rows, candidates, "candidate", "mean").withColumnRenamed("d", "score")
    return d.withColumn("place", F.row_number().over(W.partitionBy("vec_id").orderBy("score", "candidate")).cast("long"))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of unit length; empty, zero and NaN rows are rejected."""
    n = np.linalg.norm(x, axis=1) if x.size else np.zeros(0)
    if not len(n) or not np.all(np.isfinite(n)) or not np.all(n > 0):
        raise ValueError("vectors must be finite and not zero")
    return x / n[:, None]


def compact(x: np.ndarray, size: int) -> list[int]:
    """Rows of the neighbour group (a row and its nearest others) with the least mean pairwise distance."""
    k = min(size, len(x))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    best: tuple[float, list[int]] | None = None
    for i in range(len(x)):
        group = sorted(sorted(range(len(x)), key=lambda j: (d[i, j], j))[:k])
        mean = float(np.mean([d[a, b] for a, b in combinations(group, 2)])) if k > 1 else 0.0
        if best is None or (round(mean, 12), group) < best:
            best = (round(mean, 12), group)
    return best[1] if best else []


def unit_mean(x: np.ndarray, size: int) -> list[float]:
    x = unit(x)
    group = x[compact(x, size)]
    mean = group.mean(axis=0)
    n = np.linalg.norm(mean)
    return (mean / n if n > 1e-12 else group[0]).tolist()
