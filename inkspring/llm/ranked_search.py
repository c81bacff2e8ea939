"""Ranked lexical search: the k best documents of every item, by inverted treaps.

Documents are tokenised once; what is kept of each is its length and the counts of those terms that items ask for. The
corpus figures (documents, terms, documents of each term) are aggregates over all documents. Then documents are taken in
shards, and each shard gets a treap per term: search order by document, heap order by impact (what the term adds to
a document's score), each node with the largest impact of its subtree. All items walk their terms' treaps together: an
interval of documents has one subtree per term; where the summed maxima cannot reach the k-th best score yet, the
interval is left; else it is cut at a node (the largest contribution, or the middle, in turn), whose document is scored,
or, when it is narrow, its postings are added up. The k-th best scores stay for the next shards of the task. Every
shard's best meet per item in two levels. Scores are whole numbers and the walk leaves only what is below the k-th best,
so the result is exact whatever the shards are.

Items are a query set: they are handled in blocks of ``MAX_WORDS`` terms at most (a longer item is a block of its own),
so what is broadcast is bounded.

Heap order goes by impact in steps of a quarter octave, and by a hash within a step: so a treap stays shallow where
impacts follow the order of documents.

Defined cases: null or empty texts have no terms and are never found; null or empty items have no rows; texts of any
length are read whole; every row of the items is answered by itself, repeated or null item_ids too; every row of the
documents is one document, so a repeated row takes as many places; equal scores are ordered by doc_id, null ids last; an
empty table gives an empty result; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import UPPER, forget, mix, release, stored

K = 10
#: Share of the length in the norm of a document, and the weight of the norm, in percent and thousandths.
LENGTH_SHARE, NORM = 75, 8
#: Most terms of one block of items; documents of a shard; documents of an interval that is not cut any more.
MAX_WORDS, SHARD, NARROW = 150_000, 16_384, 128
#: Cells (intervals times terms) that are walked at once.
CELLS = 1_000_000

_NOT_A_TERM = bytes(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))
_FOLD = bytes.maketrans(UPPER.encode() + _NOT_A_TERM, UPPER.lower().encode() + b" " * len(_NOT_A_TERM))


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split(b" ") if text else []


def _terms(text: str | None) -> list[bytes]:
    return [t for t in terms_of(text) if t]


class Treaps:
    """A shard's postings, and over them one treap a term. Postings are ordered by (term, document)."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_terms: int, n_docs: int):
        order = np.lexsort((doc, term))
        self.n_docs = n_docs
        self.doc, self.impact = np.append(doc[order], -1), np.append(impact[order], 0)
        starts = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.key = term[order].astype(np.int64) * (n_docs + 1) + self.doc[:-1]
        n = len(order)
        # the last posting is no posting: it stands for an empty subtree
        self.none = n
        self.left, self.right = np.full(n + 1, n), np.full(n + 1, n)
        self.top = self.impact.copy()
        self.root = np.full(n_terms + 1, n)
        self._grow(starts)

    def _grow(self, starts: np.ndarray) -> None:
        steps = np.floor(4 * np.log2(np.maximum(self.impact[:-1], 1))).astype(np.int64)
        with np.errstate(over="ignore"):
            salt = (mix(np.arange(1, self.none + 1, dtype=np.uint64)) >> np.uint64(20)).astype(np.int64)
        heap = ((steps << 44) | salt).tolist()
        left, right, top = [self.none] * (self.none + 1), [self.none] * (self.none + 1), self.top.tolist()
        ends = starts.tolist()
        for t in range(len(ends) - 1):
            path: list[int] = []
            for i in range(ends[t], ends[t + 1]):
                below = self.none
                while path and heap[path[-1]] < heap[i]:
                    done = path.pop()
                    right[done] = below
                    top[done] = max(top[done], top[left[done]], top[below])
                    below = done
                left[i] = below
                path.append(i)
            below = self.none
            while path:
                done = path.pop()
                right[done] = below
                top[done] = max(top[done], top[left[done]], top[below])
                below = done
            self.root[t] = below
        self.left, self.right, self.top = np.array(left), np.array(right), np.array(top)

    def cut(self, nodes: np.ndarray, low: np.ndarray, at: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Roots of the parts of subtrees: from document ``low`` to before ``at``, at it, and after it to before ``high``.

        A root is the first node of its part on the way down to ``at``; its subtree may reach beyond the part, so its
        top is a bound.
        """
        before, hit, after = (np.full(nodes.shape, self.none) for _ in range(3))
        flat = [x.reshape(-1) for x in (before, hit, after)]
        live = np.flatnonzero(nodes.reshape(-1) != self.none)
        now, (floor, want, ceiling) = nodes.reshape(-1)[live], (np.repeat(x, nodes.shape[1])[live] for x in (low, at, high))
        while len(live):
            d = self.doc[now]
            less, more, same = d < want, d > want, d == want
            # the first node on the way that lies on a side is the root of that side
            for x, side in ((flat[0], less & (d >= floor)), (flat[2], more & (d < ceiling))):
                new = side & (x[live] == self.none)
                x[live[new]] = now[new]
            flat[1][live[same]] = now[same]
            # below the document itself the ways part; a side whose root is known is left alone
            for x, child, back in ((flat[0], self.left, self.right), (flat[2], self.right, self.left)):
                new = same & (x[live] == self.none)
                self._inside(x, live[new], child[now[new]], back, floor[new], ceiling[new])
            now = np.where(less, self.right[now], self.left[now])
            on = ~same & (now != self.none)
            live, now, floor, want, ceiling = live[on], now[on], floor[on], want[on], ceiling[on]
        return before, hit, after

    def _inside(self, out: np.ndarray, place: np.ndarray, now: np.ndarray, back: np.ndarray, floor: np.ndarray, ceiling: np.ndarray) -> None:
        """Puts the first node within [floor, ceiling) on the way along ``back`` into ``out``."""
        while len(now):
            d = self.doc[now]
            good = (d >= floor) & (d < ceiling) & (now != self.none)
            out[place[good]] = now[good]
            on = ~good & (now != self.none)
            place, floor, ceiling, now = place[on], floor[on], ceiling[on], back[now[on]]

    def postings(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of the input, posting) of all postings of a term from document ``low`` to before ``high``."""
        a = np.searchsorted(self.key, term * (self.n_docs + 1) + low)
        n = np.searchsorted(self.key, term * (self.n_docs + 1) + high) - a
        row = np.repeat(np.arange(len(n)), n)
        return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + a[row]


class Best:
    """The k best (score, document) of every item so far, and the scores that a document must reach."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.score, self.doc, self.null = (np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool))
        self.least = np.ones(items, np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        good = score >= self.least[item]
        if not good.any():
            return
        item, score, doc, null = (np.concatenate([a, b[good]]) for a, b in ((self.item, item), (self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = place < self.k
        full = place == self.k - 1
        self.least[item[full]] = score[full]
        self.item, self.score, self.doc, self.null = item[keep], score[keep], doc[keep], null[keep]


def walk(treaps: Treaps, queries: np.ndarray, times: np.ndarray, best: Best, ids: np.ndarray, null: np.ndarray, narrow: int = NARROW) -> None:
    """All items walk their treaps together. queries, times: per item its terms (filled up with a term of no postings) and their repeats."""
    width = queries.shape[1]
    most = max(1, CELLS // width)
    first = np.arange(len(queries))
    piles = [(first, treaps.root[queries], np.zeros(len(first), np.int64), np.full(len(first), treaps.n_docs), 0)]
    while piles:
        item, nodes, low, high, depth = piles.pop()
        if len(item) > most:
            piles += [tuple(x[i : i + most] for x in (item, nodes, low, high)) + (depth,) for i in range(0, len(item), most)][::-1]
            continue
        gain = treaps.top[nodes] * times[item]
        keep = (gain.sum(axis=1) >= best.least[item]) & (low < high)
        item, nodes, low, high, gain = item[keep], nodes[keep], low[keep], high[keep], gain[keep]
        if not len(item):
            continue
        thin = high - low <= narrow
        if thin.any():
            which, slot = np.nonzero(nodes[thin] != treaps.none)
            own, terms = item[thin][which], queries[item[thin]][which, slot]
            row, at = treaps.postings(terms, low[thin][which], high[thin][which])
            place = which[row] * narrow + treaps.doc[at] - low[thin][which[row]]
            # sums of whole numbers: np.add.at is exact, unlike weights of bincount
            sums = np.zeros(int(thin.sum()) * narrow, np.int64)
            np.add.at(sums, place, treaps.impact[at] * times[own[row], slot[row]])
            some = np.flatnonzero(sums)
            doc = low[thin][some // narrow] + some % narrow
            best.add(item[thin][some // narrow], sums[some], ids[doc], null[doc])
        wide = ~thin
        if not wide.any():
            continue
        item, nodes, low, high, gain = item[wide], nodes[wide], low[wide], high[wide], gain[wide]
        if depth % 2:
            at = (low + high) // 2
        else:
            rows, slot = np.arange(len(item)), gain.argmax(axis=1)
            at = treaps.doc[nodes[rows, slot]]
        before, hit, after = treaps.cut(nodes, low, at, high)
        best.add(item, (treaps.impact[hit] * times[item]).sum(axis=1), ids[at], null[at])
        piles.append((np.concatenate([item, item]), np.concatenate([before, after]), np.concatenate([low, at + 1]), np.concatenate([at, high]), depth + 1))


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, terms, tfs: documents with at least one term, and their counts of the vocabulary's terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value.get
        for b in batches:
            keep, n, terms, tfs = [], [], [], []
            for i, text in enumerate(b.column("text")):
                words = terms_of(text.as_py())
                size = len(words) - words.count(b"")
                if size:
                    found = np.fromiter(map(place, words, itertools.repeat(-1)), np.int32, len(words))
                    term, tf = np.unique(found[found >= 0], return_counts=True)
                    keep.append(i)
                    n.append(size)
                    terms.append(term)
                    tfs.append(tf.astype(np.int32))
            if keep:
                ends = np.append(0, np.cumsum([len(t) for t in terms])).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(x))) for x in (terms, tfs)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(keep)), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    norm = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // total
    return weight * ((1_000_000_000 * tf) // (1000 * tf + NORM * norm))


def _blocks(items: DataFrame, max_words: int) -> Iterator[list[tuple]]:
    """The items with their terms, in blocks of at most ``max_words`` terms, one block at a time."""
    block: list[tuple] = []
    size = 0
    for item_id, text in items.select("item_id", "text").toLocalIterator():
        words = _terms(text)
        if block and size + len(words) > max_words:
            yield block
            block, size = [], 0
        if words:
            block.append((item_id, words))
            size += len(words)
    if block:
        yield block


def _search_block(docs: DataFrame, block: list[tuple], k: int, shard: int) -> DataFrame:
    """item (number in the block), doc_id, score: at least the k best of each item."""
    spark = docs.sparkSession
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, words in block for w in words}))}
    counts = stored(count_terms(docs, vocabulary))
    documents, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # one row a term of the block
    df = dict(counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect())
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))] + [0], np.int64)
    lists = [np.unique([vocabulary[w] for w in words], return_counts=True) for _, words in block]
    # items of like length walk together, so that few cells are empty
    groups = []
    for _, some in itertools.groupby(sorted(range(len(lists)), key=lambda i: len(lists[i][0])), key=lambda i: len(lists[i][0]).bit_length()):
        members = list(some)
        queries = np.full((len(members), max(len(lists[i][0]) for i in members)), len(vocabulary))
        times = np.zeros(queries.shape, np.int64)
        for row, i in enumerate(members):
            queries[row, : len(lists[i][0])], times[row, : len(lists[i][0])] = lists[i]
        groups.append((members, queries, times))
    shared = spark.sparkContext.broadcast((groups, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, weight = shared.value
        best = [Best(len(members), k) for members, _, _ in groups]
        rows: list[pa.RecordBatch] = []

        def answer() -> None:
            held = pa.Table.from_batches(rows).combine_chunks()
            rows.clear()
            ids = held.column("doc_id").combine_chunks()
            null = np.asarray(ids.is_null())
            ids = np.asarray(ids.fill_null(0))
            order = np.lexsort((ids, null))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            terms = held.column("terms").combine_chunks()
            sizes = np.asarray(terms.value_lengths())
            doc = np.repeat(np.arange(len(order)), sizes)
            term, tf = np.asarray(terms.flatten()), np.asarray(held.column("tfs").combine_chunks().flatten()).astype(np.int64)
            impact = impacts(weight[term], tf, np.asarray(held.column("n").combine_chunks())[doc], documents, total)
            treaps = Treaps(term, rank[doc], impact, len(weight) - 1, len(order))
            for (_, queries, times), b in zip(groups, best, strict=True):
                walk(treaps, queries, times, b, ids[order], null[order])

        for b in batches:
            for i in range(0, b.num_rows, shard):
                part = b.slice(i, shard)
                if rows and sum(r.num_rows for r in rows) + part.num_rows > shard:
                    answer()
                rows.append(part)
        if rows:
            answer()
        for (members, _, _), b in zip(groups, best, strict=True):
            if len(b.item):
                yield pa.RecordBatch.from_arrays([pa.array(np.array(members)[b.item]), pa.array(b.doc, pa.int64(), mask=b.null), pa.array(b.score)], ["item", "doc_id", "score"])
        release()

    found = counts.mapInArrow(run, "item long, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # the tasks' best of an item are cut by parts first: a task yields k rows an item
    parts = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(64))).orderBy(*order)
    near = found.withColumn("_place", F.row_number().over(parts)).where(F.col("_place") <= k).drop("_place")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"item long, item_id {_kind(block)}")
    out = stored(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    forget(counts)
    return out


def _kind(block: list[tuple]) -> str:
    return "string" if any(isinstance(i, str) for i, _ in block) else "long"


def search(docs: DataFrame, items: DataFrame, k: int = K, max_words: int = MAX_WORDS, shard: int = SHARD) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every row of ``items(item_id, text)``."""
    found: DataFrame | None = None
    for block in _blocks(items, max_words):
        part = _search_block(docs, block, k, shard)
        found = part if found is None else found.unionByName(part)
    kind = items.schema["item_id"].dataType.simpleString()
    if found is None:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return found.withColumn("item_id", F.col("item_id").cast(kind))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL
), p AS (
  SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL
), n AS (
  SELECT doc_id, count(*) AS n FROM t GROUP BY 1
), c AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM p, c GROUP BY term, docs
), s AS (
  SELECT item_id, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN n USING (doc_id), c
  GROUP BY ALL
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""
