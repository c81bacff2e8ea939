"""Mixing sources to target weights.

Every source's words are packed into fixed-length blocks. The output is a sequence of slots, cut into shards of a fixed
size; for each shard the number of slots per source is drawn from a multinomial. The k-th slot of a source holds block
``k mod blocks`` of that source's pseudorandom permutation of the current epoch, so blocks repeat only after all of
them were used, and slots meet blocks by an index join. After the draws each source's slots are cut or topped up to its
exact quota, so the mix comes out at its targets and no block is used more than MAX_REPEAT times.

Rows that are equal in every column are one entry with a count; entries are dealt to buckets, and a very frequent one is
cut into pieces with buckets of their own. Blocks are numbered in a bucket, then by bucket offsets, and these offsets
(like the slot offsets of the shards) are running sums in two levels, so no task orders a whole source. The driver
sees one row per source; more than MAX_SOURCES sources are an error.

Defined cases: null or empty texts have size 0 and take nothing; texts of any length are packed whole, over as many
blocks as they need; null is a source of its own, the last; rows that share id and text but not the other columns are
packed side by side, each with its own source and columns; of rows equal in every column each gets its own share (which
of them gets which cannot be told); an empty table gives an empty result; extra columns keep their values whatever their
names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BLANKS, arrow_map, forget, row_key, set_aside, stored

BLOCK = 32
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SLOTS_PER_SHARD = 16_384
SEED = 20
#: Sources are a list on the driver and a broadcast table.
MAX_SOURCES = 100_000
_ROWS_PER_BUCKET = 2_000
#: A piece of equal rows has at most so many words and rows (one row of any length is a piece).
_WORDS_PER_PIECE, _ROWS_PER_PIECE = 100_000, 1_000
_RUN = 4_096

_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(BLANKS.encode())] = True


def sizes_of(texts: pa.Array) -> np.ndarray:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in each text of a string array (null: 0)."""
    n = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int32, n + 1, texts.offset * 4).astype(np.int64) if n else np.zeros(1, np.int64)
    if at[-1] == at[0]:
        return np.zeros(n, np.int64)
    blank = _IS_BLANK[np.frombuffer(texts.buffers()[2], np.uint8, at[-1] - at[0], at[0])]
    at = at - at[0]
    begins = ~blank
    begins[1:] &= blank[:-1]
    heads = at[:-1][at[1:] > at[:-1]]
    begins[heads] = ~blank[heads]
    return np.diff(np.searchsorted(np.flatnonzero(begins), at))


def targets(sizes: dict, weights: tuple = WEIGHTS, cap: float = MAX_REPEAT) -> dict:
    """Words per source: shares by weight, stopped at ``cap`` times a source's size, the excess reshared by weight."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be", "surrogatepass")) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if unit * weight[s] > cap * sizes[s]}
        if not full:
            return out | {s: unit * weight[s] for s in free}
        for s in full:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        free -= full
    return out


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1: four Feistel rounds, walked along their cycle until inside the range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.SeedSequence(key).generate_state(4, np.uint64)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), bool)
    with np.errstate(over="ignore"):
        while todo.any():
            x = out[todo]
            left, right = x >> np.uint64(half), x & mask
            for k in keys:
                f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
                f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                left, right = right, left ^ ((f >> np.uint64(32)) & mask)
            out[todo] = (left << np.uint64(half)) | right
            todo = out >= n
    return out.astype(np.int64)


def running(df: DataFrame, key: str, order: str, value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the same key with a smaller ``order`` (0, 1, 2 ...).

    Two levels: sums of runs of _RUN rows are added up first, so a task orders one run, or one row a run.
    """
    run = F.floor(F.col(order) / _RUN)
    runs = df.groupBy(key, run.alias("_run")).agg(F.sum(value).alias("_sum"))
    runs = runs.select(key, "_run", (F.sum("_sum").over(W.partitionBy(key).orderBy("_run")) - F.col("_sum")).alias("_before"))
    inner = F.sum(value).over(W.partitionBy(key, "_run").orderBy(order).rowsBetween(W.unboundedPreceding, 0)) - F.col(value)
    return df.withColumn("_run", run).withColumn(name, inner).join(runs, [key, "_run"]).withColumn(name, F.col(name) + F.col("_before")).drop("_run", "_before")


def _spread_tasks(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` in as many tasks as the ``rows`` it grows to need."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, rows // 500_000), *keys)


def mix_plan(docs: DataFrame, weights: tuple = WEIGHTS, block: int = BLOCK, seed: int = SEED, cap: int = MAX_REPEAT) -> tuple[DataFrame, DataFrame]:
    """(documents, draws) for ``docs(doc_id, text, source, ...)``.

    documents: every row's doc_id, source, k1 and k2 (hash of the row), size, source_size, target, plus src, bucket and
    start (where its words begin in its bucket's stream). draws: src, bucket, block (number in the bucket), drawn (how
    often it is used).
    """
    spark = docs.sparkSession

    def measure(b: pa.RecordBatch) -> pa.RecordBatch:
        cols = [b.column(c) for c in ("doc_id", "source", "t", "k1", "k2")]
        return pa.RecordBatch.from_arrays([*cols, pa.array(sizes_of(b.column("text")), pa.int64())], ["doc_id", "source", "t", "k1", "k2", "size"])

    k1, k2 = row_key(docs)
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("t"), k1.alias("k1"), k2.alias("k2"), "text")
    sized = arrow_map(rows, measure, "doc_id long, source string, t long, k1 long, k2 long, size long")
    entries = stored(sized.groupBy("doc_id", "source", "t", "k1", "k2", "size").agg(F.count("*").alias("times")))
    per = entries.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("w"), F.count("*").alias("n"))
    got = per.limit(MAX_SOURCES + 1).collect()
    if len(got) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    count = {r["source"]: r["n"] for r in got}
    sizes = {r["source"]: r["w"] for r in got}
    goal = targets(sizes, weights, cap)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be", "surrogatepass")) + ([None] if None in sizes else [])
    info = spark.createDataFrame([(i, s, sizes[s], goal[s], max(1, -(-count[s] // _ROWS_PER_BUCKET))) for i, s in enumerate(names)], "src int, source string, source_size long, target double, buckets long")

    each = F.least(F.lit(_ROWS_PER_PIECE), F.greatest(F.lit(1), F.floor(F.lit(_WORDS_PER_PIECE) / F.col("size")))).cast("long")
    each = F.when(F.col("size") > 0, each).otherwise(_ROWS_PER_PIECE)
    pieces = entries.withColumn("each", each).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / F.col("each")))))
    pieces = pieces.withColumn("times", F.least("each", F.col("times") - F.col("piece") * F.col("each")))
    pieces = pieces.withColumnRenamed("source", "_s").join(F.broadcast(info), F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    # places follow id and text: columns that the mix does not read change nothing
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "t", "piece"), "buckets"))
    order = W.partitionBy("src", "bucket").orderBy(F.col("doc_id").asc_nulls_last(), "t", "k1", "k2", "piece")
    pieces = pieces.withColumn("_words", F.col("size") * F.col("times"))
    pieces = pieces.withColumn("start", F.sum("_words").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("_words"))
    pieces = stored(pieces.select("doc_id", "source", "k1", "k2", "size", "source_size", "target", "src", "bucket", "start", "times"))
    forget(entries)

    buckets = pieces.groupBy("src", "bucket").agg(F.sum(F.col("size") * F.col("times")).alias("words")).withColumn("blocks", F.ceil(F.col("words") / block))
    buckets = stored(running(buckets, "src", "bucket", "blocks", "first").where("blocks > 0"))
    blocks = {r["src"]: r["b"] for r in buckets.groupBy("src").agg(F.sum("blocks").alias("b")).collect()}
    quota = {i: min(cap * blocks[i], round(goal[s] / (sizes[s] / blocks[i]))) for i, s in enumerate(names) if blocks.get(i)}
    draws = _draws(spark, quota, blocks, sum(quota.values()), seed)
    # block numbers of a source -> bucket and number in the bucket, by the bucket's offset
    drawn = draws.groupBy("src", "block").agg(F.count("*").alias("drawn"))
    packed = _spread_tasks(buckets, sum(blocks.values()), "src", "bucket").select("src", "bucket", F.posexplode(F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1)).alias("in_bucket", "block"))
    # both sides are made from small tables, which says nothing of their size: never broadcast them
    drawn = packed.hint("merge").join(drawn.hint("merge"), ["src", "block"]).select("src", "bucket", F.col("in_bucket").cast("long").alias("block"), "drawn")
    rows = pieces.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    return rows.withColumn("start", F.col("start") + F.col("_copy") * F.col("size")).drop("_copy", "times"), drawn.hint("merge")


def _draws(spark, quota: dict, blocks: dict, total: int, seed: int) -> DataFrame:
    """One row per output slot: shard, src, k (the source's slot number), block (its block number)."""
    live = sorted(i for i in quota if quota[i] > 0)
    if not live:
        return spark.createDataFrame([], "shard long, src int, k long, block long")
    p = np.array([quota[i] for i in live], np.float64) / total
    shards = -(-total // SLOTS_PER_SHARD)

    def draw(frames):
        for f in frames:
            out = []
            for s in f["id"]:
                n = min(SLOTS_PER_SHARD, total - int(s) * SLOTS_PER_SHARD)
                counts = np.random.Generator(np.random.Philox(key=[seed, int(s)])).multinomial(n, p)
                out += [(int(s), i, int(c)) for i, c in zip(live, counts, strict=True)]
            yield pd.DataFrame(out, columns=["shard", "src", "c"])

    counts = stored(spark.range(0, shards).mapInPandas(draw, "shard long, src int, c long"))
    want = F.broadcast(spark.createDataFrame([(i, int(quota[i]), int(blocks[i])) for i in live], "src int, quota long, blocks long"))
    counts = stored(running(counts, "src", "shard", "c", "from").join(want, "src"))
    # draws beyond a quota are cut; what a source is short of is topped up, spread over the shards
    short = counts.groupBy("src").agg(F.sum("c").alias("got"))
    top = counts.join(short, "src").where("got < quota")
    lack = F.col("quota") - F.col("got")
    top = top.select("shard", "src", "blocks", (F.col("got") + F.floor(lack * F.col("shard") / shards)).alias("from"), (F.col("got") + F.floor(lack * (F.col("shard") + 1) / shards)).alias("to"))
    kept = counts.select("shard", "src", "blocks", "from", F.least(F.col("from") + F.col("c"), F.col("quota")).alias("to"))
    runs = _spread_tasks(kept.unionByName(top).where("to > from"), total)
    out = pa.schema([("shard", pa.int64()), ("src", pa.int32()), ("k", pa.int64()), ("block", pa.int64())])

    def fill(b: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[], [], [], []]
        for shard, src, n, lo, hi in zip(*(b.column(c).to_pylist() for c in ("shard", "src", "blocks", "from", "to")), strict=True):
            k = np.arange(lo, hi, dtype=np.int64)
            block = np.empty(len(k), np.int64)
            for epoch in range(lo // n, (hi - 1) // n + 1):
                own = k // n == epoch
                block[own] = permuted(k[own] % n, n, (seed * 1_000_003 + src) * 1_009 + epoch)
            for c, v in zip(cols, (np.full(len(k), shard), np.full(len(k), src, np.int32), k, block), strict=True):
                c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], schema=out)

    return arrow_map(runs, fill, "shard long, src int, k long, block long")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, block: int = BLOCK, seed: int = SEED, cap: int = MAX_REPEAT) -> DataFrame:
    """Every row with doc_id, size, source_size, target, taken (words the mix takes of it, repeats counted)."""
    rows, drawn = mix_plan(docs.select("doc_id", "text", "source"), weights, block, seed, cap)
    parts = _spread(rows, block)
    taken = parts.join(drawn, ["src", "bucket", "block"]).groupBy("src", "bucket", "start").agg(F.sum(F.col("drawn") * F.col("words")).alias("taken"))
    # documents without words share a start with the next one: only those with words take
    out = rows.withColumn("at", F.when(F.col("size") > 0, F.col("start"))).join(taken.withColumnRenamed("start", "at"), ["src", "bucket", "at"], "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source")


def _spread(rows: DataFrame, block: int) -> DataFrame:
    """One row per document row and block it reaches into, with the words it has there."""
    some = rows.where("size > 0").select("k1", "k2", "src", "bucket", "start", "size")
    some = some.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))))
    lo, hi = F.greatest("start", F.col("block") * block), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    return some.withColumn("words", hi - lo).withColumn("word", lo - F.col("start"))


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, block: int = BLOCK, seed: int = SEED, cap: int = MAX_REPEAT) -> DataFrame:
    """The mix as documents: the columns of ``docs``, one row per document row and pass of the mix that uses it.

    A row's text holds the words of the blocks used in that pass, in their order; a document used whole keeps its text
    as it is. A document without words stays as it is; one the mix takes nothing of goes.
    """
    docs, named = set_aside(docs)
    names = docs.columns
    rows, drawn = mix_plan(docs, weights, block, seed, cap)
    parts = _spread(rows, block).join(drawn, ["src", "bucket", "block"])
    # one entry per pass and row: the runs of its words; equal rows have starts of their own
    passes = parts.withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("drawn").cast("int"))))
    by = (int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "k1", "k2")
    runs = passes.repartition(*by).groupBy("k1", "k2", "bucket", "start", "pass").agg(F.array_sort(F.collect_list(F.struct("word", "words"))).alias("_runs"), F.first("size").alias("_size"))
    # equal rows are one, found before the texts are dealt; texts travel once
    k1, k2 = row_key(docs)
    worded = F.coalesce(F.btrim("text", F.lit(BLANKS)) != "", F.lit(False))
    one = docs.where(worded).select(F.struct(*names).alias("_row"), k1.alias("k1"), k2.alias("k2")).groupBy("k1", "k2").agg(F.first("_row").alias("_row"))
    used = runs.hint("merge").join(one.hint("merge"), ["k1", "k2"]).select("_row.*", "_runs", "_size")

    def build(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for t, runs, size in zip(*(b.column(c).to_pylist() for c in ("text", "_runs", "_size")), strict=True):
            if sum(r["words"] for r in runs) == size:
                texts.append(t)
            else:
                w = _ascii_words(t)
                texts.append(" ".join(x for r in runs for x in w[r["word"] : r["word"] + r["words"]]))
        cols = [pa.array(texts, pa.string()) if c == "text" else b.column(c) for c in names]
        if "n_chars" in names:
            k = names.index("n_chars")
            cols[k] = pa.array([len(t) for t in texts], cols[k].type)
        return pa.RecordBatch.from_arrays(cols, names)

    return named(arrow_map(used, build, docs.schema).unionByName(docs.where(~worded)))


def _ascii_words(text: str) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]
