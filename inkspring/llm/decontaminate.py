"""Benchmark decontamination with a generalised suffix automaton over words.

The benchmark items become one automaton (all their word substrings). Every document streams through it once,
keeping the longest match that ends at each word; a match of at least ``window`` words, or of a whole shorter item,
marks its words. No shuffle: documents are read, matched and answered in place.

The automaton is broadcast, so its size is checked: items are cut into slices of at most ``max_words`` words (a longer
single item is a slice of its own). With more than one slice, every slice in turn is matched against the texts and only
its findings are kept, keyed by a 128-bit hash of the text; the findings of all slices are united per text, and
documents meet them by that key. Verdicts are made from the united spans, so the number of slices changes no result.

Defined cases: null or empty texts have no words and no hits; texts of any length are matched whole, word by word, and
take memory in proportion to their own length; null item texts and null item ids match nothing; repeated items count
once by id, and all texts of a repeated id belong to it; repeated document rows are each answered; spans that overlap or
touch are one; coverage equal to the limit stays; an empty benchmark hits nothing, an empty table gives an empty
result; extra columns keep their values whatever their names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, forget, set_aside, stored

WINDOW = 10
#: Most words of one broadcast automaton (about 100 MB in a worker).
MAX_WORDS = 150_000
#: A document is dropped by ``remove_contaminated`` when more than this share of its words is hit.
MAX_COVERAGE = 0.5

#: Bytes that separate words: all ASCII but digits and letters; A-Z become a-z.
_SEP = bytes(
    (b + 32 if 0x41 <= b <= 0x5A else b) if b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
#: A word before lowering: capitals count.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_SEP).split() if text else []


class Automaton:
    """Generalised suffix automaton of word sequences; every state knows the items that contain its strings."""

    def __init__(self, items: dict, window: int = WINDOW):
        self.window = window
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict = {}
        for key, words in items.items():
            last, path = 0, []
            for w in words:
                last = self._extend(last, w)
                path.append(last)
            ends[key] = last
        self._own(items)
        short: list[list] = [[] for _ in self.next]
        for key, words in items.items():
            if 0 < len(words) < window:
                short[self._walk(words)].append((len(words), key))
        # parents come before children when states are visited by length
        self.deep = [-1] * len(self.next)  # the ancestor that holds the suffix of `window` words
        self.short: list[tuple] = [()] * len(self.next)
        for s in sorted(range(len(self.next)), key=self.length.__getitem__):
            up = self.link[s]
            if up >= 0:
                self.short[s] = (*short[s], *self.short[up])
                if self.length[s] >= window:
                    self.deep[s] = s if self.length[up] < window else self.deep[up]

    def _extend(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[last] + 1 == length[q] else self._clone(last, w, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[p] + 1 == length[q] else self._clone(p, w, q)
        return cur

    def _clone(self, p: int, w: bytes, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        c = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = c
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = link[p]
        return c

    def _walk(self, words: list[bytes]) -> int:
        s = 0
        for w in words:
            s = self.next[s][w]
        return s

    def _own(self, items: dict) -> None:
        self.items: list[set] = [set() for _ in self.next]
        for key, words in items.items():
            s = 0
            for w in words:
                s = t = self.next[s][w]
                while t > 0 and self.length[t] >= self.window and key not in self.items[t]:
                    self.items[t].add(key)
                    t = self.link[t]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged hit spans (word positions, end exclusive) and the items found."""
        nxt, link, length, short, window = self.next, self.link, self.length, self.short, self.window
        s = n = 0
        spans: list[tuple[int, int]] = []
        found: set = set()
        root = nxt[0]
        for i, w in enumerate(words):
            t = nxt[s].get(w)
            if t is None:
                if w not in root:
                    s = n = 0
                    continue
                while t is None:
                    s = link[s]
                    t = nxt[s].get(w)
                n = length[s]
            s = t
            n += 1
            if n >= window:
                spans.append((i + 1 - window, i + 1))
                found |= self.items[self.deep[s]]
            if short[s]:
                for m, key in short[s]:
                    if n >= m:
                        spans.append((i + 1 - m, i + 1))
                        found.add(key)
        return merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_BUILT: dict = {}


def _automaton(shared, tag: str, window: int) -> Automaton:
    """One automaton per worker process; slices do not pile up."""
    if tag not in _BUILT:
        _BUILT.clear()
        _BUILT[tag] = Automaton({k: words_of(t) for k, t in shared.value}, window)
    return _BUILT[tag]


def _n_words(c: Column) -> Column:
    return F.size(F.split(F.regexp_replace(c, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), " "))


def slices(benchmark: DataFrame, max_words: int = MAX_WORDS) -> list[DataFrame]:
    """The items (k, text) in slices of about ``max_words`` words at most."""
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("k"), "text")
    total = items.agg(F.sum(_n_words(F.col("text")))).first()[0] or 0
    n = max(1, -(-int(total) // max_words))
    return [items.where(F.pmod(F.xxhash64("k"), F.lit(n)) == i) for i in range(n)]


_SPANS = "array<struct<start:int,end:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _spans(rows: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in r] for r in rows], _SPAN_TYPE)


def _shared(part: DataFrame) -> tuple:
    """One slice, broadcast: (key, text) with a key of its own for every text of a repeated id."""
    return part.sparkSession.sparkContext.broadcast([(f"{k}\0{i}", t) for i, (k, t) in enumerate(map(tuple, part.collect()))]), uuid.uuid4().hex


def _ids(keys: set) -> list[str]:
    return sorted({k.rsplit("\0", 1)[0] for k in keys})


def text_key(text: Column) -> list[Column]:
    """128 bits of a text; equal texts have equal findings."""
    return [F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(1), text, F.lit(2)).alias("_k2")]


def findings(docs: DataFrame, parts: list[DataFrame], window: int) -> DataFrame:
    """_k1, _k2, spans, items of every text of ``docs`` that some slice hits; stored.

    One slice at a time is collected, broadcast and done with; a text that many rows have is one row after each slice.
    """
    texts = docs.where("text <> ''").select(*text_key(F.col("text")), "text")
    found = []
    for part in parts:
        shared, tag = _shared(part)

        def match(b: pa.RecordBatch, shared=shared, tag=tag) -> pa.RecordBatch | None:
            auto = _automaton(shared, tag, window)
            at, spans, items = [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                hit, keys = auto.scan(words_of(text))
                if hit:
                    at.append(i)
                    spans.append(hit)
                    items.append(_ids(keys))
            if not at:
                return None
            own = b.take(pa.array(at, pa.int32()))
            return pa.RecordBatch.from_arrays([own.column("_k1"), own.column("_k2"), _spans(spans), pa.array(items, pa.list_(pa.string()))], ["_k1", "_k2", "spans", "items"])

        hits = arrow_map(texts, match, f"_k1 long, _k2 long, spans {_SPANS}, items array<string>")
        found.append(stored(hits.groupBy("_k1", "_k2").agg(F.first("spans").alias("spans"), F.first("items").alias("items"))))
        shared.destroy()
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    # at most one row a slice and text
    every = every.groupBy("_k1", "_k2").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def unite(b: pa.RecordBatch) -> pa.RecordBatch:
        spans = [merged([(x["start"], x["end"]) for x in r]) for r in b.column("spans").to_pylist()]
        return pa.RecordBatch.from_arrays([b.column("_k1"), b.column("_k2"), _spans(spans), b.column("items")], ["_k1", "_k2", "spans", "items"])

    out = stored(arrow_map(every, unite, every.schema))
    forget(*found)
    return out


def scan_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` with n_words, spans (of hit words) and the sorted items found."""
    docs = docs.select("doc_id", "text")
    parts = slices(benchmark, max_words)
    if len(parts) == 1:
        shared, tag = _shared(parts[0])

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            auto = _automaton(shared, tag, window)
            words = [words_of(t) for t in b.column("text").to_pylist()]
            found = [auto.scan(w) for w in words]
            cols = [b.column("doc_id"), pa.array(map(len, words), pa.int64()), _spans([x for x, _ in found]), pa.array([_ids(k) for _, k in found], pa.list_(pa.string()))]
            return pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "spans", "items"])

        return arrow_map(docs, one, f"doc_id long, n_words long, spans {_SPANS}, items array<string>")

    def count(b: pa.RecordBatch) -> pa.RecordBatch:
        n = [len(words_of(t)) for t in b.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_k1"), b.column("_k2"), pa.array(n, pa.int64())], ["doc_id", "_k1", "_k2", "n_words"])

    rows = arrow_map(docs.select("doc_id", *text_key(F.col("text")), "text"), count, "doc_id long, _k1 long, _k2 long, n_words long")
    out = rows.join(findings(docs, parts, window), ["_k1", "_k2"], "left")
    return out.select("doc_id", "n_words", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def report(scanned: DataFrame) -> DataFrame:
    """The digest columns of a scan."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return scanned.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def without(text: str, hits: list[tuple[int, int]]) -> str:
    """``text`` without its hit words (word positions, end exclusive)."""
    at = [m.span() for m in _WORD.finditer(text)]
    keep, last = [], 0
    for a, b in hits:
        keep.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return "".join([*keep, text[last:]])


def _size(hits: list[tuple[int, int]]) -> int:
    return sum(b - a for a, b in hits)


def cut_spans(text: str, auto: Automaton, max_coverage: float) -> str | None:
    """``text`` without its hit words, until nothing matches any more.

    None if the words cut in all rounds are more than ``max_coverage`` of the words the text had at first.
    """
    words = words_of(text)
    n, gone = len(words), 0
    while hits := auto.scan(words)[0]:
        gone += _size(hits)
        if gone > max_coverage * n:
            return None
        text = without(text, hits)
        words = words_of(text)
    return text


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE, max_words: int = MAX_WORDS) -> DataFrame:
    """``docs`` without benchmark passages: spans are cut, documents cut by more than ``max_coverage`` of their words go.

    Returns the columns of ``docs`` (n_chars follows the text where it exists). Other rows stay as they are. What is left
    of a text is matched again until nothing is hit. With several slices each round unites the spans of all of them
    before a document is judged and cut, and only documents that were cut go on: the result is that of one automaton.
    """
    docs, named = set_aside(docs)
    names, schema = docs.columns, docs.schema

    def renewed(b: pa.RecordBatch, new: list[str | None]) -> pa.RecordBatch:
        """The rows whose text is not lost (null texts stay null), with their new texts."""
        texts = b.column("text").to_pylist()
        cols = [pa.array(new, pa.string()) if c == "text" else b.column(c) for c in b.schema.names]
        if "n_chars" in names:
            k = names.index("n_chars")
            old = b.column("n_chars").to_pylist()
            cols[k] = pa.array([o if n == t else len(n or "") for o, t, n in zip(old, texts, new, strict=True)], b.column("n_chars").type)
        return pa.RecordBatch.from_arrays(cols, b.schema.names).filter(pa.array([t is None or n is not None for t, n in zip(texts, new, strict=True)], pa.bool_()))

    parts = slices(benchmark, max_words)
    if len(parts) == 1:
        shared, tag = _shared(parts[0])

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            auto = _automaton(shared, tag, window)
            return renewed(b, [cut_spans(t, auto, max_coverage) if t else t for t in b.column("text").to_pylist()])

        return named(arrow_map(docs, one, schema))

    def judged(b: pa.RecordBatch) -> pa.RecordBatch:
        new, first, gone = [], [], []
        for t, spans, n, was in zip(*(b.column(c).to_pylist() for c in ("text", "_spans", "_n", "_gone")), strict=True):
            hits = [(x["start"], x["end"]) for x in spans]
            first.append(n if n is not None else len(words_of(t)))
            gone.append(was + _size(hits))
            new.append(without(t, hits) if gone[-1] <= max_coverage * first[-1] else None)
        cols = [*(b.column(c) for c in names), pa.array(first, pa.int64()), pa.array(gone, pa.int64())]
        return renewed(pa.RecordBatch.from_arrays(cols, [*names, "_n", "_gone"]), new)

    done: DataFrame | None = None
    work = docs.withColumn("_n", F.lit(None).cast("long")).withColumn("_gone", F.lit(0).cast("long"))
    while True:
        hits = findings(work, parts, window).select("_k1", "_k2", F.col("spans").alias("_spans"))
        keyed = work.select("*", *text_key(F.col("text"))).join(hits, ["_k1", "_k2"], "left")
        clean = keyed.where("_spans is null").select(*names)
        done = clean if done is None else done.unionByName(clean)
        dirty = keyed.where("_spans is not null").select(*names, "_n", "_gone", "_spans")
        work = stored(arrow_map(dirty, judged, work.schema))
        if work.isEmpty():
            return named(done)


ORACLE = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM bw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT m FROM win),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM dw),
occ AS (
  SELECT p.doc_id, p.i, x.m, x.item_id
  FROM (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM pos, sizes WHERE i + m - 1 <= len(w)) p JOIN win x ON p.s = x.s AND p.m = x.m
), hit AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM occ) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n, string_agg(k, ',' ORDER BY k) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
       sha256(coalesce(i.s, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM dw d LEFT JOIN hit h USING (doc_id) LEFT JOIN ids i USING (doc_id)
"""
