"""Helpers shared by the corpus operators: tables, shared storage, tokenisation, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII capitals and their small letters; the contracts lower exactly these.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: White space of the contracts: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the session's checkpoint folder.

    Only a session that is one machine (master ``local``, as in tests) may have none; it gets a temporary one.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jsc = spark.sparkContext._jsc.sc()
        if jsc.getCheckpointDir().isEmpty():
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        path = jsc.getCheckpointDir().get()
    return path.rstrip("/")


#: Shuffle files go when their action ends, not when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors.

    The shuffle files of the write are removed with its end, as nothing can read them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLES_GO)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove tables made by ``stored`` whose readers have all been written themselves."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._stored_at)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def set_aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """(documents whose extra columns have names of their own, a function that gives the columns their names back)."""
    own = {"doc_id", "text", "lang", "source", "n_chars"}
    names = {c: c if c in own else f"__extra{i}" for i, c in enumerate(docs.columns)}
    quoted = lambda c: F.col(f"`{c.replace('`', '``')}`")
    return docs.select(*[quoted(c).alias(n) for c, n in names.items()]), lambda df: df.select(*[F.col(n).alias(c) for c, n in names.items()])


def row_key(df: DataFrame) -> tuple[Column, Column]:
    """128 bits of a whole row. Nulls count by their place; maps are hashed as JSON."""
    cells: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name.replace('`', '``')}`")
        cells += [F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c, c.isNull()]
    return F.xxhash64(*cells), F.xxhash64(F.lit(1), *cells, F.lit(2))


def ascii_lower(c):
    """Lower A-Z only. Pure ASCII strings take the quick built-in; others go through translate."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash; remembers up to ``limit`` words so that common words cost one lookup."""

    def __init__(self, limit: int = 80_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.limit:
            self[word] = h
        return h


_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, words: WordHashes, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a text.

    Words are runs of anything but ``[\\x20\\x09-\\x0D]`` after lowering A-Z; a text of fewer words is one
    shingle, a text without words (or null) none.
    """
    toks = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not toks:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(words.__getitem__, toks), np.uint64, len(toks))
    k = min(width, len(toks))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - k + 1, k, np.uint64)
        for i in range(k):
            h = h * _STEP + w[i : len(w) - k + 1 + i]
        return np.unique(mix(h))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply a batch function to every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and (out := fn(b)) is not None:
                yield out
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Gives a worker's unused Arrow memory back; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge table: every node on an edge with ``comp``, the smallest node reachable.

    Edges are contracted: each node takes its smallest neighbour (or itself) as parent, and edges are renamed to the
    parents until none is left; then parents are followed. A hub's edges meet its parent by salts (``spread_join``), so
    no task holds all edges of a node.
    """
    live = stored(edges.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).where("x < y").distinct())
    parent: DataFrame | None = None
    while not live.isEmpty():
        # min is pre-aggregated, so a hub costs one row a task
        low = live.select(F.col("y").alias("node"), F.col("x").alias("to")).unionByName(live.select(F.col("x").alias("node"), F.col("x").alias("to")))
        step = stored(low.groupBy("node").agg(F.min("to").alias("to")))
        # chains of parents within a round are followed to their end: parents are smaller, so this ends
        while True:
            far = step.alias("s").join(step.select(F.col("node").alias("to"), F.col("to").alias("top")), "to").select("node", "to", "top")
            new = stored(far)
            if new.where("top <> to").isEmpty():
                forget(new)
                break
            nxt = stored(new.select("node", F.col("top").alias("to")))
            forget(new, step)
            step = nxt
        at = lambda name, to: step.select(F.col("node").alias(name), F.col("to").alias(to))
        moved = spread_join(spread_join(live, at("x", "u"), "x", "y"), at("y", "v"), "y", "x")
        after = stored(moved.select(F.least("u", "v").alias("x"), F.greatest("u", "v").alias("y")).where("x < y").distinct())
        if parent is None:
            joined = step.select("node", F.col("to").alias("comp"))
        else:
            joined = parent.join(step.select(F.col("node").alias("comp"), F.col("to").alias("up")), "comp", "left").select("node", F.coalesce("up", "comp").alias("comp"))
        grown = stored(joined)
        forget(live, step, *([parent] if parent is not None else []))
        live, parent = after, grown
    if parent is None:
        return live.select(F.col("x").alias("node"), F.col("y").alias("comp"))
    forget(live)
    return parent


#: Most rows of one key that meet in one task, about.
HOT_ROWS = 256
#: Tables of ids with at most so many rows (some MB) are broadcast.
SMALL_ROWS = 10_000


def spread_join(rows: DataFrame, one: DataFrame, key: str | list[str], by: str, most: int | None = None, size: int | None = None) -> DataFrame:
    """``rows`` inner joined with ``one`` (at most one row a key), where a key may hold any share of ``rows``.

    Rows are salted by the hash of ``by``, and ``one`` first meets the distinct (key, salt) pairs that occur, so it is
    repeated only as often as a key needs; then no task gets more than some HOT_ROWS rows of a key. ``most`` is the
    count of the commonest key, if known; ``size`` the count of ``one`` if it is a table of ids: a small one is broadcast.
    """
    if size is not None and size <= SMALL_ROWS:
        return rows.join(F.broadcast(one), key)
    key = [key] if isinstance(key, str) else key
    if most is None:
        most = rows.groupBy(*key).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    salts = -(-most // HOT_ROWS)
    if salts <= 1:
        return rows.join(one, key)
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    near = salted.select(*key, "__salt").distinct().join(one, key)
    return salted.join(near, [*key, "__salt"]).drop("__salt")
