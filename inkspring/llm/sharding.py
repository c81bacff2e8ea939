"""Sharding by fixed virtual slots.

Records hash into a fixed number of slots, bytes are summed per slot, and a small versioned map says which shard owns
a slot. The map is a stored table of versions: it is written first, and records are placed by the version read back.
Rebalancing edits the newest version and appends the next; whole slots move. Only slot totals (as many as SLOTS, however
large the data) reach the driver.

Equal texts are no unit here: under law ``bytes`` they are dealt over the shards like all other rows (a text that a third
of all rows has would otherwise fill a third of the bytes into one shard of 24). That holds for whole rows too: rows with
the same doc_id and text are numbered, and the number is part of what is hashed, so no slot is filled by copies of one
row. Only rows with more than TOGETHER copies are numbered (parts of their copies first, then the parts' offsets), and any of them may have any
number, so reruns agree on what a slot holds.

Defined cases: a null text has no bytes and the CRC of the empty text; texts of any length are one record, never cut; a
null doc_id hashes with its text; repeated rows are dealt over slots and get places of their own, equal rows in any order; equal
slots go to the lower shard, the lower slot first; an empty table gives an empty result; extra columns keep their values:
those called shard or slot are found as shard_before and slot_before.
"""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import HOT_ROWS, SMALL_ROWS, shared_dir, spread_join, stored

SLOTS = 8192
SHARDS = 24
OVERHEAD = 8
#: Up to so many equal rows share a slot; more are numbered and dealt.
TOGETHER = 8

MAP_SCHEMA = "version int, vslot int, shard int, bytes long, n long"


def virtual_slot(slots: int = SLOTS) -> Column:
    first = F.xxhash64("doc_id", "text_crc32")
    return F.pmod(F.when(F.col("copy") == 0, first).otherwise(F.xxhash64("doc_id", "text_crc32", "copy")), F.lit(slots)).cast("int")


def numbered_copies(rows: DataFrame) -> DataFrame:
    """``rows(doc_id, size, text_crc32, ...)`` with copy: 0, 1, 2 ... among the rows of one doc_id, size and text_crc32.

    Up to TOGETHER equal rows are all 0: they stay in one slot.
    """
    cells = ["size", "text_crc32", F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull()]
    rows = rows.withColumn("_k1", F.xxhash64(*cells)).withColumn("_k2", F.xxhash64(F.lit(1), *cells, F.lit(2)))
    key = ["_k1", "_k2"]
    repeated = stored(rows.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > TOGETHER))
    keys, most = repeated.agg(F.count("*"), F.max("_n")).first()
    if not keys:
        return rows.withColumn("copy", F.lit(0).cast("long")).drop(*key)
    few = F.broadcast(repeated) if keys <= SMALL_ROWS else repeated
    single = rows.join(few.select(*key), key, "left_anti").withColumn("copy", F.lit(0).cast("long"))
    # a part holds some HOT_ROWS copies; rows are stored with their part, so that it stays theirs
    part = F.pmod(F.xxhash64("_row"), F.ceil(F.col("_n") / HOT_ROWS)).cast("int")
    several = stored(spread_join(rows.withColumn("_row", F.monotonically_increasing_id()), repeated, key, "_row", most, keys).withColumn("_part", part))
    sizes = several.groupBy(*key, "_part").agg(F.count("*").alias("_held"))
    before = sizes.withColumn("_before", F.sum("_held").over(W.partitionBy(*key).orderBy("_part")) - F.col("_held")).drop("_held")
    own = F.row_number().over(W.partitionBy(*key, "_part").orderBy("_row")) - 1
    several = several.withColumn("_own", own).join(before, [*key, "_part"]).withColumn("copy", (F.col("_own") + F.col("_before")).cast("long"))
    return single.unionByName(several.select(*single.columns)).drop(*key)


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, copy, vslot."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return numbered_copies(rows).withColumn("vslot", virtual_slot(slots))


def slot_sizes(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, bytes, records): at most one entry a slot."""
    return [tuple(r) for r in rows.groupBy("vslot").agg(F.sum("size"), F.count("*")).collect()]


def build_map(sizes: list[tuple[int, int, int]], shards: int = SHARDS, slots: int = SLOTS) -> dict[int, int]:
    """slot -> shard: heaviest slot first onto the lightest shard (ties: lower slot, lower shard)."""
    held = {s: b for s, b, _ in sizes}
    heap = [(0, k) for k in range(shards)]
    out = {}
    for s in sorted(range(slots), key=lambda s: (-held.get(s, 0), s)):
        b, k = heapq.heappop(heap)
        out[s] = k
        heapq.heappush(heap, (b + held.get(s, 0), k))
    return out


def rebalance(current: dict[int, int], sizes: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """An edited map for ``shards`` shards: slots leave a shard only while it is above the mean (or is gone)."""
    held = {s: b for s, b, _ in sizes}
    mean = sum(held.values()) / shards
    load = dict.fromkeys(range(shards), 0)
    for s, k in current.items():
        if k in load:
            load[k] += held.get(s, 0)
    out, homeless = dict(current), [s for s, k in current.items() if k not in load]
    for s in sorted(current, key=lambda s: (-held.get(s, 0), s)):
        k, b = current[s], held.get(s, 0)
        if k in load and b and load[k] - b >= mean - b / 2 and load[k] > mean:
            load[k] -= b
            homeless.append(s)
    for s in sorted(homeless, key=lambda s: (-held.get(s, 0), s)):
        k = min(load, key=lambda k: (load[k], k))
        out[s] = k
        load[k] += held.get(s, 0)
    return out


def map_table(spark: SparkSession, shard_of: dict[int, int], sizes: list[tuple[int, int, int]], version: int = 1) -> DataFrame:
    """The map as rows of one version, ready to be appended to a stored table."""
    held = {s: (b, n) for s, b, n in sizes}
    return spark.createDataFrame([(version, s, k, *held.get(s, (0, 0))) for s, k in sorted(shard_of.items())], MAP_SCHEMA)


def save_map(table: DataFrame, path: str) -> None:
    """Append a version; readers take the largest version, earlier ones stay for audit and roll-back."""
    table.write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str) -> DataFrame:
    every = spark.read.parquet(path)
    return every.join(every.agg(F.max("version").alias("version")), "version").select(*[c.split()[0] for c in MAP_SCHEMA.split(", ")])


def place(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Records with their shard and their place in it (0, 1, 2 ... in every shard), by one version of the map.

    The place is the offset of the record's slot in its shard plus its rank in the slot, so no task orders more than
    one slot.
    """
    starts = table.withColumn("start", F.sum("n").over(W.partitionBy("shard").orderBy("vslot")) - F.col("n")).select("vslot", "shard", "start", "version")
    rank = F.row_number().over(W.partitionBy("vslot").orderBy(F.col("doc_id").asc_nulls_last(), "text_crc32", "size")) - 1
    return rows.withColumn("rank", rank).join(F.broadcast(starts), "vslot").withColumn("slot", (F.col("start") + F.col("rank")).cast("long"))


def stored_map(spark: SparkSession, rows: DataFrame, shards: int = SHARDS, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """The newest version of the map at ``path`` after ``rows(vslot, size)`` were counted into it.

    A path without a map gets version 1; a map that is there is rebalanced for ``shards`` and the new totals, and the
    edited map becomes its next version. Without a path, the map goes to a place of its own in the shared folder.
    """
    path = path or f"{shared_dir(spark)}/shard-map-{uuid.uuid4().hex}"
    sizes = slot_sizes(rows)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        old = load_map(spark, path).collect()
        version, shard_of = old[0]["version"] + 1, rebalance({r["vslot"]: r["shard"] for r in old}, sizes, shards)
    else:
        version, shard_of = 1, build_map(sizes, shards, slots)
    save_map(map_table(spark, shard_of, sizes, version), path)
    return load_map(spark, path)


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (place in the shard), grown_shard, virtual_slot, map_version."""
    rows = records(docs, slots)
    return place(rows, stored_map(docs.sparkSession, rows, shards, slots, path)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot"), F.col("version").alias("map_version"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """``docs`` with shard and slot (its place in the shard)."""
    taken, names = set(docs.columns), {}
    for c in ("shard", "slot"):
        if c in taken:
            names[c] = f"{c}_before"
            while names[c] in taken:
                names[c] += "_"
    docs = docs.withColumnsRenamed(names)
    text = F.coalesce("text", F.lit(""))
    whole = docs.select(F.struct("*").alias("_whole"), "doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    whole = numbered_copies(whole).withColumn("vslot", virtual_slot(slots))
    table = stored_map(docs.sparkSession, whole.select("vslot", "size"), shards, slots, path)
    return place(whole, table).select("_whole.*", "shard", "slot")
