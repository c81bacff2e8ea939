"""Exact n-gram Jaccard self join: five-word shingle sets, similarity of 0.75 or more, with link counts and components.

How it works, all of it over every document:

1. ``fingerprints``: one row per document with its set size and a 128-bit fingerprint of the set. Equal sets form one
   class, so copies cost nothing further.
2. ``postings``: shingles that only one class holds can link nothing. Each set is ordered by document frequency (rarest
   first), and only the prefix that a set of similarity 0.75 must share is listed. Frequencies are counted exactly by
   hash bucket over compact blocks, as many buckets as the summed set sizes need; shingles so frequent that they would
   burden one bucket (found over all data by local heavy hitters, a list of bounded size) are never gathered, they are
   ordered last by their count.
3. Index lists are blocked by set size and carry positions. Blocks outside the size range are skipped by the join key,
   and pairs whose positions leave too few shingles are skipped before they are verified.
4. Answers come from similar sets: in a long list one central set (the pivot) is verified against all others. What these
   links connect is one component, and every set takes as its home the pivot with most members that it links with. Two
   sets of a home share at least what neither lacks of the pivot: o >= n_p - r_x - r_y, with r the shingles of the pivot
   that a set lacks. So they are linked for certain if c_x + c_y >= 0, where c = (N + D) * (n_p - 2 r) - 2 N n for the
   limit N / D (doubled to stay whole). The condition adds up, so the links of a whole home are counted from a histogram
   of c, without a pair.
5. The other pairs inside a component are counted block by block: members whose links are not certain meet blocks of all
   members, a task counts the overlaps of two blocks at once and returns one number a member; no pair leaves it.
6. Only pairs of different components become candidates; two known overlaps with a list's pivot skip those whose bound
   is too low. They are verified on whole sets. Components follow by contraction.

No link is lost and none is counted twice: the link counts and components are those of all pairs.

Defined cases: null or empty texts have an empty set, no links, and are their own component; texts of any length give
whole sets, in memory in proportion to their own length; repeated rows fall into one class and are linked; a null doc_id
is never the smallest id (a class of null ids only has a null component); similarity equal to the limit is a link; an
empty table gives an empty result; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BLANKS, WordHashes, arrow_map, components, forget, mix, release, set_aside, shingle_set, spread_join, stored

WIDTH = 5
#: similarity >= NUM / DEN
NUM, DEN = 75, 100
#: A shingle is frequent if at least one in so many documents of some batch holds it.
FREQUENT_ONE_IN = 200
#: Frequent shingles on the driver and in the broadcast list, at most.
MOST_FREQUENT = 500_000
#: Lists longer than this get a pivot before pairs are made.
LONG_LIST = 24

#: About so many shingles are counted in one bucket.
BUCKET = 1_000_000
#: Members and shingles of a block in which a component's pairs are counted, about.
MEMBERS, SHINGLES = 512, 1_000_000
#: A task sorts its shingles in chunks of about so many.
CHUNK = 1_000_000

_BITS = np.uint64(16)  # frequencies are counted for the upper 48 bits of a hash


def _need(n: Column) -> Column:
    """Least overlap that a set of size n needs with any partner."""
    return F.floor((n * NUM + (DEN - 1)) / F.lit(DEN)).cast("long")


def _signature(h: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a = np.add.reduce(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)
        b = np.bitwise_xor.reduce(mix(h + np.uint64(0x5851F42D4C957F2D))) if len(h) else np.uint64(0)
    return int(a.view(np.int64)) if len(h) else 0, int(b.view(np.int64)) if len(h) else 0


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, th (hash of the text), n, s1, s2 per document row; the locally frequent shingles of a block ride on its last row."""

    def run(batches):
        words = WordHashes()
        kind = pa.list_(pa.struct([("h", pa.int64()), ("c", pa.int64())]))

        def often(sets: list) -> list:
            """The shingles that one in FREQUENT_ONE_IN of these sets has."""
            u, c = np.unique(np.concatenate(sets), return_counts=True)
            many = c >= max(8, len(sets) / FREQUENT_ONE_IN)
            return [{"h": int(a), "c": int(k)} for a, k in zip(u[many], c[many], strict=True)]

        for b in batches:
            ns, s1, s2, sets, held, total = [], [], [], [], [], 0
            for t in b.column("text"):
                h = shingle_set(t.as_py(), words, width)
                ns.append(len(h))
                x, y = _signature(h)
                s1.append(x)
                s2.append(y)
                sets.append(h >> _BITS)
                total += len(h)
                held.append(None)
                if total >= CHUNK:
                    held[-1], sets, total = often(sets), [], 0
            if not ns:
                continue
            if sets:
                held[-1] = often(sets)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(ns, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(held, kind)],
                ["doc_id", "th", "n", "s1", "s2", "often"],
            )
        release()

    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    return rows.mapInArrow(run, "doc_id long, th long, n long, s1 long, s2 long, often array<struct<h:long,c:long>>")


def frequent(prints: DataFrame) -> np.ndarray:
    """Shingles with a large share of all documents, rarest first.

    A shingle in one of FREQUENT_ONE_IN documents is that frequent in some block, so none is missed. Counts reach a
    fixed share of the document count; where more than MOST_FREQUENT do, the share is raised until the list fits (the
    others are counted like all shingles, so this changes no result).
    """
    floor = max(64, prints.count() // (4 * FREQUENT_ONE_IN))
    rows = stored(prints.where("often is not null").select(F.inline("often")).groupBy("h").agg(F.sum("c").alias("c")))
    while rows.where(F.col("c") >= floor).count() > MOST_FREQUENT:
        floor *= 2
    got = rows.where(F.col("c") >= floor).toPandas()
    forget(rows)
    return got.sort_values(["c", "h"])["h"].to_numpy(np.uint64)


def twins_of(prints: DataFrame) -> dict[tuple[int, int], int]:
    """(s1, s2) -> node for sets that share s1 with another set; all others have s1 itself as node.

    Of N sets about N * N / 2**65 do: none up to billions, some hundreds of a hundred billion.
    """
    some = prints.where("n > 0")
    odd = [r["s1"] for r in some.groupBy("s1").agg(F.min("s2").alias("lo"), F.max("s2").alias("hi")).where("lo <> hi").select("s1").collect()]
    if not odd:
        return {}
    rows = some.where(F.col("s1").isin(odd)).select("s1", "s2", F.xxhash64("s1", "s2").alias("node")).distinct().collect()
    return {(r["s1"], r["s2"]): r["node"] for r in rows}


def _nodes(prints: DataFrame, twins: dict[tuple[int, int], int]) -> DataFrame:
    """``prints`` with node."""
    odd = sorted({a for a, _ in twins})
    return prints.withColumn("node", F.when(F.col("s1").isin(odd), F.xxhash64("s1", "s2")).otherwise(F.col("s1")) if odd else F.col("s1"))


def postings(docs: DataFrame, hot: np.ndarray, buckets: int, twins: dict, width: int = WIDTH) -> DataFrame:
    """h, node, n, pos, u: the listed prefix of every set that shares a shingle there.

    ``u`` is the number of shingles that no other set holds.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((np.sort(hot), np.argsort(hot, kind="stable")))
    out = pa.schema([("bucket", pa.int32()), ("h0", pa.int64()), ("gaps", pa.binary()), ("who", pa.binary()), ("nodes", pa.binary()), ("n", pa.int64())])

    def chunks(batches):
        """Distinct sets of a task in chunks of about CHUNK shingles: nodes, sizes, other shingles, frequent ones."""
        words = WordHashes()
        known, rank = shared.value
        seen, nodes, sizes, sets, hots, total = set(), [], [], [], [], 0
        for b in batches:
            for t in b.column("text"):
                h = shingle_set(t.as_py(), words, width)
                if not len(h):
                    continue
                sign = _signature(h)
                s = twins.get(sign, sign[0])
                if s in seen:
                    continue
                seen.add(s)
                h = h >> _BITS
                at = np.searchsorted(known, h)
                at[at == len(known)] = 0
                is_hot = known[at] == h if len(known) else np.zeros(len(h), bool)
                nodes.append(s)
                sizes.append(len(h))
                hots.append(rank[at[is_hot]].astype(np.int64) if is_hot.any() else None)
                sets.append(h[~is_hot])
                total += len(h)
                if total >= CHUNK or len(nodes) == 65_000:
                    yield nodes, sizes, sets, hots
                    nodes, sizes, sets, hots, total = [], [], [], [], 0
        if nodes:
            yield nodes, sizes, sets, hots

    def deal(batches):
        for nodes, sizes, sets, hots in chunks(batches):
            ids = np.array(nodes, np.int64)
            every = np.concatenate(sets)
            who = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(x) for x in sets])
            order = np.argsort(every, kind="stable")
            every, who = every[order], who[order]
            # the buckets of this chunk only: its work does not grow with their number
            bucket = np.minimum((every.astype(np.float64) * (buckets / 2.0**48)).astype(np.int64), buckets - 1)
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(every)] if len(every) else [0]
            rows: dict = {c: [] for c in out.names}
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                k = int(bucket[x])
                mine, local = np.unique(who[x:y], return_inverse=True)
                gaps = np.diff(every[x:y])
                rows["bucket"].append(k)
                rows["h0"].append(int(every[x]))
                rows["gaps"].append(gaps.astype(np.uint32).tobytes() if not len(gaps) or int(gaps.max()) < 2**32 else gaps.tobytes())
                # the more buckets, the fewer shingles of a set are in one: then each shingle brings its node
                listed = 8 * len(mine) + 2 * len(local) < 8 * len(local)
                rows["who"].append(local.astype(np.uint16).tobytes() if listed else None)
                rows["nodes"].append(ids[mine if listed else who[x:y]].tobytes())
                rows["n"].append(None)
            # one row a set: its size and its frequent shingles, dealt by fingerprint
            for s, n, hs in zip(nodes, sizes, hots, strict=True):
                rows["bucket"].append((s >> 7) % buckets)
                rows["h0"].append(s)
                rows["gaps"].append(None)
                rows["who"].append(None)
                rows["nodes"].append(hs.tobytes() if hs is not None else None)
                rows["n"].append(n)
            yield pa.RecordBatch.from_pydict(rows, schema=out)
        release()

    def count(t: pa.Table) -> pa.Table:
        sized = t.filter(pa.compute.is_valid(t["n"]))
        node, h, df, n = [], [], [], []
        for s, size, hs in zip(sized["h0"].to_pylist(), sized["n"].to_pylist(), sized["nodes"].to_pylist(), strict=True):
            r = np.frombuffer(hs, np.int64) if hs else np.empty(0, np.int64)
            node.append(np.full(len(r) + 1, s, np.int64))
            h.append(np.append(r, -1))
            df.append(np.append(r + 2**40, 0))  # after all counted frequencies, in the list's order
            n.append(np.append(np.zeros(len(r), np.int64), size))
        blocks = t.filter(pa.compute.is_null(t["n"]))
        if blocks.num_rows:
            hs, ns = [], []
            for h0, gaps, who, nodes in zip(*(blocks[c].to_pylist() for c in ("h0", "gaps", "who", "nodes")), strict=True):
                each = np.frombuffer(nodes, np.int64)
                if who is not None:
                    each = each[np.frombuffer(who, np.uint16)]
                g = np.frombuffer(gaps, np.uint32 if len(gaps) == 4 * (len(each) - 1) else np.uint64).astype(np.uint64)
                hs.append(np.concatenate([np.array([h0], np.uint64), np.uint64(h0) + np.cumsum(g, dtype=np.uint64)]))
                ns.append(each)
            hs, ns = np.concatenate(hs), np.concatenate(ns)
            order = np.lexsort((ns, hs))
            hs, ns = hs[order], ns[order]
            keep = np.ones(len(hs), bool)
            keep[1:] = (hs[1:] != hs[:-1]) | (ns[1:] != ns[:-1])  # copies of a set from several batches
            hs, ns = hs[keep], ns[keep]
            first = np.flatnonzero(np.append(True, hs[1:] != hs[:-1]))
            times = np.diff(np.append(first, len(hs)))
            each = np.repeat(times, times)
            many = each > 1
            node.append(ns[many])
            h.append(hs[many].astype(np.int64))
            df.append(each[many])
            n.append(np.zeros(int(many.sum()), np.int64))
        if not node:
            node = h = df = n = [np.empty(0, np.int64)]
        return pa.table({"node": np.concatenate(node), "h": np.concatenate(h), "df": np.concatenate(df), "n": np.concatenate(n)})

    dealt = docs.select("text").mapInArrow(deal, "bucket int, h0 long, gaps binary, who binary, nodes binary, n long")
    # as many tasks as buckets: a task's share stays the same as the input grows
    shared_by = dealt.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(count, "node long, h long, df long, n long")
    sets = shared_by.groupBy("node").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_set(F.when(F.col("df") > 0, F.struct("df", "h")))).alias("f")
    )
    need = _need(F.col("n"))
    sets = sets.withColumn("u", F.col("n") - F.size("f")).withColumn("k", F.col("n") - need + 1 - F.col("u")).where("k > 0 and size(f) > 0")
    return sets.select("node", "n", "u", F.posexplode(F.slice("f", F.lit(1), F.col("k").cast("int"))).alias("i", "x")).select(
        # hot shingles are listed by rank, others by hash: df keeps the two apart
        F.when(F.col("x.df") >= 2**40, -F.col("x.h") - 1).otherwise(F.col("x.h")).alias("h"), "node", "n", (F.col("u") + F.col("i")).alias("pos"), "u",
    )


def sets_of(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, s (sorted shingle hashes)."""

    def run(batches):
        words = WordHashes()
        for b in batches:
            s = [shingle_set(t, words, width).view(np.int64) for t in b.column("text").to_pylist()]
            at = np.zeros(len(s) + 1, np.int32)
            np.cumsum([len(x) for x in s], out=at[1:])
            values = pa.array(np.concatenate(s) if s else np.empty(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(at), values)], ["doc_id", "s"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, s array<long>")


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, na, nb, o (overlap), linked for candidate pairs of nodes; a node's pairs are dealt over tasks by salt."""
    x = sets.select(F.col("node").alias("a"), F.col("s").alias("sa"))
    y = sets.select(F.col("node").alias("b"), F.col("s").alias("sb"))
    met = spread_join(spread_join(pairs.select("a", "b"), x, "a", "b"), y, "b", "a", _most(pairs, "b"))
    o = met.select("a", "b", F.size("sa").cast("long").alias("na"), F.size("sb").cast("long").alias("nb"), F.size(F.array_intersect("sa", "sb")).cast("long").alias("o"))
    return o.withColumn("linked", F.expr(f"{DEN} * o >= {NUM} * (na + nb - o)"))


def _most(rows: DataFrame, key: str) -> int:
    """Rows of the commonest key."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def _enough(na: str, nb: str) -> str:
    """Least overlap of two linked sets: o >= t / (1 + t) * (na + nb)."""
    return f"(({NUM}L * ({na} + {nb}) + {NUM + DEN - 1}L) div {NUM + DEN}L)"


def _homes(known: DataFrame) -> DataFrame:
    """node, home, c for every set that links with a pivot, and for the pivots: c as in the module's text."""
    linked = known.where("linked")
    members = linked.groupBy(F.col("b").alias("home")).agg(F.count("*").alias("members"))
    own = members.join(linked.select(F.col("b").alias("home"), F.col("nb").alias("n")).distinct(), "home").select(F.col("home").alias("node"), "home", "n", F.col("n").alias("np"), F.col("n").alias("o"), "members")
    others = spread_join(linked.select(F.col("a").alias("node"), F.col("b").alias("home"), F.col("na").alias("n"), F.col("nb").alias("np"), "o"), members, "home", "node")
    best = others.select(*own.columns).unionByName(own).groupBy("node").agg(F.max_by(F.struct("home", "n", "np", "o"), F.struct("members", F.col("home"))).alias("x"))
    c = f"{NUM + DEN}L * (2 * x.o - x.np) - {2 * NUM}L * x.n"
    return best.select("node", "x.home", F.expr(c).alias("c"))


def _certain(homes: DataFrame, size: DataFrame) -> DataFrame:
    """node, links: documents in the sets of the same home that are linked for certain (their own set left out)."""
    weighed = homes.join(size, "node")
    per = stored(weighed.groupBy("home", "c").agg(F.sum("w").alias("w")))
    asked = per.select("home", (-F.col("c")).alias("v"), F.lit(0).cast("long").alias("w"), "c")
    held = per.select("home", F.col("c").alias("v"), "w", F.lit(None).cast("long").alias("c"))
    # one row a home and distinct c: sums of all c that are no less
    order = W.partitionBy("home").orderBy(F.col("v").desc()).rangeBetween(W.unboundedPreceding, 0)
    sums = held.unionByName(asked).withColumn("sum", F.sum("w").over(order)).where("c is not null").groupBy("home", "c").agg(F.max("sum").alias("sum"))
    some = weighed.withColumn("hc", F.xxhash64("home", "c"))
    met = spread_join(some, sums.select(F.xxhash64("home", "c").alias("hc"), F.col("home").alias("h2"), F.col("c").alias("c2"), "sum"), "hc", "node").where("home = h2 and c = c2")
    return met.select("node", (F.col("sum") - F.when(F.col("c") >= 0, F.col("w")).otherwise(0)).alias("links"))


def _overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``x`` with every set of ``y``."""
    out = np.zeros((len(x), len(y)), np.int64)
    flat, back = np.concatenate(x), np.concatenate(y)
    left, right = np.repeat(np.arange(len(x)), list(map(len, x))), np.repeat(np.arange(len(y)), list(map(len, y)))
    both = np.intersect1d(flat, back)
    if not len(both):
        return out
    # columns of common shingles, some thousand at a time
    at, has = np.searchsorted(both, flat), np.isin(flat, both)
    to, had = np.searchsorted(both, back), np.isin(back, both)
    at, left, to, right = at[has], left[has], to[had], right[had]
    for lo in range(0, len(both), 4096):
        a, b = np.zeros((len(x), 4096), np.float32), np.zeros((len(y), 4096), np.float32)
        p, q = (at >= lo) & (at < lo + 4096), (to >= lo) & (to < lo + 4096)
        a[left[p], at[p] - lo] = 1
        b[right[q], to[q] - lo] = 1
        out += np.rint(a @ b.T).astype(np.int64)
    return out


def _within(members: DataFrame, sets: DataFrame) -> DataFrame:
    """node, links: documents in sets of the same component that are linked, but for those of ``_certain``.

    ``members(node, comp, home, c, w, first)``: first marks members of their component's main home that are certain with
    all of it; two such need no look. All others meet every member.
    """
    per = members.groupBy("comp").agg(F.count("*").alias("m"), F.sum("n").alias("s"), F.count_if(~F.col("first")).alias("lm"), F.sum(F.when(~F.col("first"), F.col("n"))).alias("ls")).where("lm > 0")
    cut = lambda m, s: F.ceil(F.greatest(F.col(m) / MEMBERS, F.col(s) / SHINGLES)).cast("int")
    per = stored(per.select("comp", cut("m", "s").alias("_r"), cut("lm", "ls").alias("_l"), "m"))
    most = per.agg(F.max("m")).first()[0] or 0
    met = spread_join(members, per.select("comp", "_r", "_l"), "comp", "node", most)
    rows = stored(met.join(sets, "node").withColumn("_b", F.xxhash64("node", F.lit(7))))
    parts = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = rows.where(~F.col("first")).withColumn("i", F.pmod("_b", "_l").cast("int")).withColumn("j", parts("_r"))
    right = rows.withColumn("j", F.pmod("_b", "_r").cast("int")).withColumn("i", parts("_l"))
    cols = ("comp", "i", "j", "node", "home", "c", "w", "first", "s")

    def count(x: pa.Table, y: pa.Table) -> pa.Table:
        if not x.num_rows or not y.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        a, b = ({c: t[c].to_numpy() for c in ("node", "home", "c", "w")} for t in (x, y))
        xs, ys = ([np.asarray(v.values) for v in t["s"]] for t in (x, y))
        o = _overlaps(xs, ys)
        na, nb = np.array(list(map(len, xs)))[:, None], np.array(list(map(len, ys)))[None]
        counted = (a["home"][:, None] == b["home"][None]) & (a["c"][:, None] + b["c"][None] >= 0)
        linked = (DEN * o >= NUM * (na + nb - o)) & ~counted & (a["node"][:, None] != b["node"][None])
        # members that certain ones meet count back; others meet them from their own side
        back = linked & y["first"].to_numpy(zero_copy_only=False)[None]
        return pa.table({"node": np.concatenate([a["node"], b["node"]]), "links": np.concatenate([linked @ b["w"], a["w"] @ back]).astype(np.int64)})

    task = ("comp", "i", "j")
    found = left.select(*cols).groupBy(*task).cogroup(right.select(*cols).groupBy(*task)).applyInArrow(count, "node long, links long")
    return found.groupBy("node").agg(F.sum("links").alias("links"))


def links(docs: DataFrame, prints: DataFrame, twins: dict, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(edges, counts): edges a, b between nodes that give the components of all links; counts node, links (documents
    in other classes that are linked with the class)."""
    spark = docs.sparkSession
    total = prints.agg(F.sum("n")).first()[0] or 0
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))
    lists = stored(postings(docs, frequent(prints), buckets, twins, width))
    classes = stored(_nodes(prints.where("n > 0"), twins).groupBy("node").agg(F.count("*").alias("w"), F.min(F.struct("doc_id", "th")).alias("one"), F.min("th").alias("th")))
    wanted = classes.join(lists.select("node").distinct(), "node").select("node", F.coalesce("one.doc_id", F.lit(0)).alias("doc_id"), F.coalesce("one.th", "th").alias("th"))
    texts = docs.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.xxhash64("text").alias("th"), "text").join(wanted, ["doc_id", "th"])
    # rows of one id and text hash are one set, unless hashes collide: the node tells
    sets = stored(_with_node(texts, twins, width))
    size = classes.select("node", "w")

    # long lists: one central set against the others
    long_lists = lists.groupBy("h").agg(F.count("*").alias("m"), F.min_by("node", F.struct((F.col("u") / F.col("n")).alias("r"), "node")).alias("pivot"))
    long_lists = stored(long_lists.where(F.col("m") > LONG_LIST))
    most, n_long = long_lists.agg(F.max("m"), F.count("*")).first()
    starred = stored(spread_join(lists.select("h", "node"), long_lists.select("h", "pivot"), "h", "node", most or 0, n_long).where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct())
    known = stored(_verify(starred, sets))
    homes = stored(_homes(known))
    star = stored(components(known.where("linked").select("a", "b")))
    members = stored(homes.join(star, "node").join(size, "node").join(sets.select("node", F.size("s").cast("long").alias("n")), "node"))
    per_home = members.groupBy("home").agg(F.min("c").alias("cmin"), F.count("*").alias("m"), F.first("comp").alias("comp"))
    main = per_home.groupBy("comp").agg(F.max_by("home", F.struct("m", "home")).alias("main"), F.sum("m").alias("m"))
    per_home = stored(per_home.join(main.select("comp", "main"), "comp").select("home", "cmin", "main", "m"))
    most, n_homes = per_home.agg(F.max("m"), F.count("*")).first()
    met = spread_join(members, per_home.drop("m"), "home", "node", most or 0, n_homes)
    members = stored(met.withColumn("first", (F.col("home") == F.col("main")) & (F.col("c") + F.col("cmin") >= 0)).drop("main", "cmin"))

    # across components only
    held = lists.join(star, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    held = held.join(long_lists.select("h", "pivot"), "h", "left").join(known.select(F.col("a").alias("node"), F.col("b").alias("pivot"), "o"), ["node", "pivot"], "left")
    held = stored(
        held.withColumn("o", F.when(F.col("node") == F.col("pivot"), F.col("n") - F.col("u")).otherwise(F.col("o")))
        .withColumn("block", F.floor(F.log(F.col("n").cast("double")) / float(np.log(DEN / NUM))).cast("int"))
        .select("h", "node", "comp", "n", "u", "pos", "o", "block")
    )
    forget(lists, long_lists, starred)
    per = held.groupBy("h", "comp").agg(F.count("*").alias("m"))
    per = stored(per.groupBy("h").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.count("*").alias("kinds"), F.sum("m").alias("m")).where("kinds > 1"))
    most, n_per = per.agg(F.max("m"), F.count("*")).first()
    mixed = spread_join(held, per.select("h", "main"), "h", "node", most or 0, n_per)
    cells = ("node", "comp", "n", "u", "pos", "o")
    left = mixed.where("comp <> main").select("h", *[F.col(c).alias(f"x_{c}") for c in cells], F.explode(F.expr("array(block - 1, block, block + 1)")).alias("block"))
    right = mixed.select("h", "block", "main", *[F.col(c).alias(f"y_{c}") for c in cells])
    # shingles that only one set holds come first and are never shared, nor held by the pivot
    need = _enough("x_n", "y_n")
    pairs = left.join(right, ["h", "block"]).where(
        F.expr("x_comp <> y_comp and (y_comp = main or x_node < y_node)")
        & F.expr(f"{DEN} * least(x_n, y_n) >= {NUM} * greatest(x_n, y_n)")
        & F.expr(f"least(x_pos - x_u, y_pos - y_u) + least(x_n - x_pos, y_n - y_pos) >= {need}")
        & F.expr(f"x_o is null or y_o is null or least(x_o, y_o) + least(x_n - x_o - x_u, y_n - y_o - y_u) >= {need}")
    )
    pairs = pairs.select(
        F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b"), "h",
        F.expr("least(x_n - x_pos, y_n - y_pos) - 1").alias("rest"), F.expr(need).alias("need"),
    )
    # all shared shingles up to the last listed one are counted, so count + what is left bounds the overlap
    pairs = stored(pairs.groupBy("a", "b").agg(F.count("*").alias("c"), F.min("rest").alias("rest"), F.first("need").alias("need")).where("c + rest >= need").select("a", "b"))
    second = stored(_verify(pairs, sets).where("linked").select("a", "b"))
    forget(held, per, pairs)
    each = second.select("a", "b").unionByName(second.select(F.col("b").alias("a"), F.col("a").alias("b")))
    found = spread_join(each, size.select(F.col("node").alias("b"), "w"), "b", "a").groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("links"))
    counts = stored(found.unionByName(_certain(homes, size)).unionByName(_within(members, sets)).groupBy("node").agg(F.sum("links").alias("links")))
    return known.where("linked").select("a", "b").unionByName(second), counts


def _with_node(texts: DataFrame, twins: dict, width: int) -> DataFrame:
    """node, s (sorted shingle hashes), once a node."""

    def run(batches):
        words = WordHashes()
        for b in batches:
            keep, s = [], []
            for t, want in zip(b.column("text"), b.column("node").to_pylist(), strict=True):
                h = shingle_set(t.as_py(), words, width)
                sign = _signature(h)
                if twins.get(sign, sign[0]) == want:
                    keep.append(want)
                    s.append(h.view(np.int64))
            at = np.zeros(len(s) + 1, np.int32)
            np.cumsum([len(x) for x in s], out=at[1:])
            values = pa.array(np.concatenate(s) if s else np.empty(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int64()), pa.ListArray.from_arrays(pa.array(at), values)], ["node", "s"])
        release()

    return texts.select("node", "text").mapInArrow(run, "node long, s array<long>").dropDuplicates(["node"])


def _grouped(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, th, n, node, class_id, comp, n_links of every row; null class and component: empty sets and null ids only."""
    docs = docs.select("doc_id", "text")
    prints = stored(fingerprints(docs, width))
    twins = twins_of(prints)
    edges, counts = links(docs, prints, twins, width)
    prints = _nodes(prints, twins)
    reps = prints.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("w"))
    # contraction needs no order of its own: nodes first, then the smallest id of each component
    label = components(edges)
    groups = reps.join(label, "node", "left").withColumn("root", F.coalesce("comp", "node")).drop("comp")
    smallest = groups.groupBy("root").agg(F.min("class_id").alias("comp"))
    groups = groups.join(smallest, "root").join(counts, "node", "left").select("node", "class_id", "comp", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"))
    some = prints.drop("often").where("n > 0")
    none = prints.drop("often").where("n = 0").select("*", F.lit(None).cast("long").alias("class_id"), F.lit(None).cast("long").alias("comp"), F.lit(0).cast("long").alias("n_links"))
    return spread_join(some, groups, "node", "doc_id").select(*none.columns).unionByName(none)


def jaccard_components(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_shingles, n_links (other rows it is linked with), class_id,
    component_id."""
    own = lambda c: F.when(F.col("n") > 0, F.col(c)).otherwise(F.col("doc_id"))
    return _grouped(docs, width).select("doc_id", F.col("n").alias("n_shingles"), "n_links", own("class_id").alias("class_id"), own("comp").alias("component_id"))


def keep_one(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest doc_id, each of its texts once.

    Rows that share an id are one document. Documents without words are linked with nothing and all stay; so does one
    row of every set that only null ids hold.
    """
    last = F.lit(2**63 - 1)
    some = _grouped(docs, width).where("n > 0 and (comp is null or doc_id = comp)")
    first = some.groupBy(F.coalesce("doc_id", last).alias("_id"), F.when(F.col("comp").isNull(), F.col("node")).otherwise(F.col("th")).alias("_k")).agg(F.min("th").alias("_th")).select("_id", "_th")
    blank = F.coalesce(F.btrim("text", F.lit(BLANKS)) == "", F.lit(True))
    docs, named = set_aside(docs)
    some = docs.where(~blank).withColumn("_id", F.coalesce("doc_id", last)).withColumn("_th", F.xxhash64("text"))
    kept = some.join(first, ["_id", "_th"], "left_semi").dropDuplicates(["_id", "_th"]).select(*docs.columns)
    return named(kept.unionByName(docs.where(blank)))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n, sha256(string_agg(g, chr(10) ORDER BY g)) AS digest FROM s GROUP BY 1
), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)
), r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen
), k AS (SELECT a, count(*) AS n FROM e GROUP BY 1
), c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(k.n, 0)::BIGINT AS n_links,
       CASE WHEN n.n IS NULL THEN d.doc_id ELSE min(d.doc_id) OVER (PARTITION BY n.digest) END AS class_id, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id LEFT JOIN k ON k.a = d.doc_id
"""
