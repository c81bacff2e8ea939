"""Exact top-k search over binary codes by incremental multi-index hashing.

A code of 64 bits (the signs of a vector) is cut into segments, each with an index from segment value to codes. A query
probes every segment at radius 0, 1, 2 ...; after radius r in all m segments, every code within Hamming distance
m * (r + 1) - 1 has been met, so the search of a query ends as soon as its k-th verified distance is no larger. Queries
that are not covered go on to the next radius.

Equal codes are one entry (with its smallest ids), so copies cost nothing. Index lists are dealt by (segment, range of
values) and cut into chunks of about CHUNK codes, the queries that reach a range into chunks of about QUERIES; a task
holds one chunk of each, looks the probes up, verifies by popcount and returns at most k entries a query, so no table of
pairs is ever made.

Defined cases: rows of null id or vector, or of a vector that is not DIM long, are neither queries nor answers; ties
are ordered by id; fewer than k rows give fewer answers; repeated rows are answers (and queries) of their own; a null,
zero or NaN entry counts as a clear bit; vectors longer or shorter than DIM are not compared; an empty table gives an
empty result; extra columns are not read, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import forget, spread_join, stored

DIM = 64
K = 10
SEGMENTS = 4
CHUNK = 20_000
QUERIES = 4_000
QUERY_EVERY = 50


def code_of(vector: Column) -> Column:
    """The signs of a vector as a 64-bit number."""
    return F.aggregate(vector, F.lit(0).cast("long"), lambda s, x: F.shiftleft(s, 1).bitwiseOR(F.when((x > 0) & ~F.isnan(x), 1).otherwise(0).cast("long")))


def codes(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """id, code for every usable row of ``vectors(vec_id, embedding)``."""
    return vectors.where((F.size("embedding") == dim) & F.col("vec_id").isNotNull()).select(F.col("vec_id").alias("id"), code_of(F.col("embedding")).alias("code"))


def _masks(width: int, radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.int64)


def _segment(code: np.ndarray, seg: int, width: int) -> np.ndarray:
    return ((code.view(np.uint64) >> np.uint64(seg * width)) & np.uint64((1 << width) - 1)).astype(np.int64)


def _probe(index: pa.Table, queries: pa.Table, radius: int, width: int, k: int) -> pa.Table:
    """Codes of one chunk whose segment value differs from a query's in exactly ``radius`` bits: the k nearest a query."""
    out: dict = {"query": [], "code": [], "d": [], "n": [], "first": []}
    if index.num_rows and queries.num_rows:
        seg = index["seg"][0].as_py()
        code, n, first = (index[c].to_numpy() for c in ("code", "n", "first"))
        value = _segment(code, seg, width)
        order = np.argsort(value, kind="stable")
        code, n, first, value = code[order], n[order], first[order], value[order]
        keys, at = np.unique(value, return_index=True)
        ends = np.append(at[1:], len(value))
        masks = _masks(width, radius)
        for q in queries["code"].to_numpy():
            own = _segment(np.array([q]), seg, width)[0]
            if len(masks) < len(keys):
                want = own ^ masks
                pos = np.searchsorted(keys, want)
                pos[pos == len(keys)] = 0
                pos = pos[keys[pos] == want]
            else:
                pos = np.flatnonzero(np.bitwise_count((keys ^ own).astype(np.uint64)) == radius)
            if not len(pos):
                continue
            a, m = at[pos], ends[pos] - at[pos]
            rows = np.repeat(a - np.cumsum(m) + m, m) + np.arange(m.sum())
            d = np.bitwise_count((code[rows] ^ q).view(np.uint64)).astype(np.int64)
            if len(rows) > k:
                near = d <= np.partition(d, k - 1)[k - 1]
                rows, d = rows[near], d[near]
                best = np.lexsort((first[rows], d))[:k]
                rows, d = rows[best], d[best]
            out["query"].append(np.full(len(rows), q))
            out["d"].append(d)
            for c, v in (("code", code), ("n", n), ("first", first)):
                out[c].append(v[rows])
    return pa.table({c: pa.array(np.concatenate(v) if v else np.empty(0, np.int64), pa.int64()) for c, v in out.items()})


def top_k(base: DataFrame, queries: DataFrame, k: int = K, segments: int = SEGMENTS, chunk: int = CHUNK, queries_a_task: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, distance for codes ``base(id, code)`` and ``queries(id, code)``: the exact k nearest."""
    width = DIM // segments
    rows = stored(base)
    classes = stored(rows.groupBy("code").agg(F.count("*").alias("n"), F.min("id").alias("first")))
    size = classes.count()
    parts = 1
    while parts < size / chunk and parts < 1 << (width // 2):
        parts *= 2
    shift = width - (parts.bit_length() - 1)

    index = classes.select(F.explode(F.array(*[F.struct(F.lit(s).alias("seg"), F.expr(f"shiftrightunsigned(code, {s * width})").bitwiseAND(F.lit((1 << width) - 1)).alias("value")) for s in range(segments)])).alias("x"), "code", "n", "first")
    index = index.select("x.seg", F.shiftright("x.value", shift).cast("int").alias("part"), "code", "n", "first")
    # lists longer than a chunk are cut; their queries go to every piece
    pieces = index.groupBy("seg", "part").agg(F.ceil(F.count("*") / chunk).cast("int").alias("pieces"))
    index = stored(index.join(pieces, ["seg", "part"]).withColumn("piece", F.pmod(F.xxhash64("code"), "pieces").cast("int")).drop("pieces"))
    asked = stored(queries)
    active = asked.select("code").distinct()
    found = None
    for radius in range(width + 1):
        # the parts that a query can reach at this radius: those whose upper bits differ in at most so many
        flips = sorted(int(x) for r in range(min(radius, width - shift) + 1) for x in _masks(width - shift, r))
        own = F.shiftright(F.expr(f"shiftrightunsigned(code, seg * {width})").bitwiseAND(F.lit((1 << width) - 1)), shift).cast("int")
        spots = active.select("code", F.explode(F.array(*map(F.lit, range(segments)))).alias("seg"))
        spots = spots.select("seg", "code", F.explode(F.transform(F.array(*map(F.lit, flips)), lambda m: own.bitwiseXOR(m))).alias("part"))
        spots = stored(spots.join(pieces, ["seg", "part"]))
        asking = spots.groupBy("seg", "part").agg(F.ceil(F.count("*") / queries_a_task).cast("int").alias("asking"))
        probes = spots.join(asking, ["seg", "part"]).withColumn("ask", F.pmod(F.xxhash64("code"), "asking").cast("int"))
        probes = probes.select("seg", "part", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), "ask", "code")
        # chunks that no query reaches stay behind
        asked_of = index.join(asking, ["seg", "part"]).withColumn("ask", F.explode(F.sequence(F.lit(0), F.col("asking") - 1))).drop("asking")

        def probe(index: pa.Table, queries: pa.Table) -> pa.Table:
            return _probe(index, queries, radius, width, k)

        task = ("seg", "part", "piece", "ask")
        near = asked_of.groupBy(*task).cogroup(probes.groupBy(*task)).applyInArrow(probe, "query long, code long, d long, n long, first long")
        every = near if found is None else near.unionByName(found)
        best = every.groupBy("query", "code").agg(F.first("d").alias("d"), F.first("n").alias("n"), F.first("first").alias("first"))
        # at most k a query leave each task, then at most k are gathered
        rank = F.row_number().over(W.partitionBy("query").orderBy("d", "first", "code"))
        nearest = best.withColumn("rank", rank).where(F.col("rank") <= k)
        lists = nearest.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("d", "first", "code", "n"))).alias("best"))
        reach = segments * (radius + 1) - 1
        met = F.aggregate("best", F.lit(0).cast("long"), lambda s, x: s + F.when(x["d"] <= reach, x["n"]).otherwise(0))
        lists = stored(lists.withColumn("done", met >= k))
        forget(spots)
        found = lists.select("query", F.inline("best")).select("query", "code", "d", "n", "first")
        active = stored(active.join(lists.where("done").select(F.col("query").alias("code")), "code", "left_anti"))
        if active.isEmpty() or reach >= DIM:
            break
    return _answers(rows, asked, found, k)


def _answers(rows: DataFrame, asked: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Entries back to rows: the k smallest ids of each found code, then the k first of each query."""
    wanted = found.select("code").distinct()
    # many rows may share a code: they meet it by salt
    ids = spread_join(rows, wanted, "code", "id").groupBy("code", "id").agg(F.count("*").alias("times"))
    ids = ids.groupBy("code", F.pmod(F.xxhash64("id"), F.lit(64)).alias("salt")).agg(F.slice(F.array_sort(F.collect_list(F.struct("id", "times"))), 1, k).alias("ids"))
    ids = ids.groupBy("code").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k).alias("ids"))
    each = found.join(ids, "code").select("query", "d", F.explode("ids").alias("x")).select("query", "d", "x.id", F.explode(F.sequence(F.lit(1), F.least(F.col("x.times"), F.lit(k)).cast("int"))).alias("_t"))
    lists = each.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "id", "_t"))), 1, k).alias("best"))
    out = spread_join(asked, lists.withColumnRenamed("query", "code"), "code", "id").select(F.col("id").alias("query_id"), F.posexplode("best").alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.d").cast("int").alias("distance"))


def search(vectors: DataFrame, every: int = QUERY_EVERY, k: int = K) -> DataFrame:
    """Rows whose id is divisible by ``every``, against all rows (themselves included)."""
    base = codes(vectors)
    return top_k(base, base.where(F.col("id") % every == 0), k)


ORACLE = r"""
WITH c AS (
  SELECT vec_id, CAST(array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 AND NOT isnan(x) THEN '1' ELSE '0' END), '') AS BIT) AS code
  FROM embeddings WHERE len(embedding) = 64
), p AS (
  SELECT q.vec_id AS query_id, b.vec_id, bit_count(xor(q.code, b.code))::INT AS distance
  FROM c q, c b WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank FROM p)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10
"""
