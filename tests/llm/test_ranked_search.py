"""Ranked search against scoring every document, and the treaps against plain trees."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from inkspring.llm import ranked_search as R
from inkspring.llm.common import table

KINDS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total, df = len(counts), sum(c.total() for _, c in counts), Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 25 + (75 * c.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def check(spark, docs, items, **how):
    got = R.search(spark.createDataFrame(docs, KINDS[0]), spark.createDataFrame(items, KINDS[1]), **how).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs, items, how.get("k", 10))


@pytest.fixture(scope="module")
def tables(spark, sf):
    return [[tuple(r) for r in table(spark, sf, t).select(i, "text").collect()] for t, i in (("documents", "doc_id"), ("benchmark", "item_id"))]


def test_documents(spark, tables):
    check(spark, *tables)


def test_small_shards_and_blocks_change_nothing(spark, tables):
    check(spark, *tables, shard=7, max_words=200)
    check(spark, tables[0], tables[1][:5], k=1, shard=50)


def test_narrow_intervals(spark, tables, monkeypatch):
    """All documents are reached by cutting at nodes."""
    docs, items = tables
    vocabulary = {w: i for i, w in enumerate(sorted({w.encode() for _, t in items for w in terms(t)}))}
    counts = [Counter(terms(t)) for _, t in docs]
    n, total = sum(1 for c in counts if c), sum(c.total() for c in counts)
    df = Counter(t for c in counts for t in c)
    rows = [(vocabulary[t.encode()], d, tf, c.total()) for d, c in enumerate(counts) for t, tf in c.items() if t.encode() in vocabulary]
    term, doc, tf, size = (np.array(x, np.int64) for x in zip(*rows, strict=True))
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df[w.decode()] + 1))) for w in vocabulary])
    treaps = R.Treaps(term, doc, R.impacts(weight[term], tf, size, n, total), len(vocabulary), len(docs))
    for node in range(treaps.none):  # search order, heap order in steps, tops
        for child, side in ((treaps.left[node], -1), (treaps.right[node], 1)):
            if child != treaps.none:
                assert np.sign(treaps.doc[child] - treaps.doc[node]) == side
                assert treaps.impact[child] <= treaps.impact[node] * 2**0.25 + 1 and treaps.top[child] <= treaps.top[node]
    ids = np.array([i for i, _ in docs])
    want = brute(docs, items)
    for narrow, cells in ((1, 10**6), (5, 50), (10**6, 10**6)):
        monkeypatch.setattr(R, "CELLS", cells)
        got = []
        for item, text in items:
            own, times = np.unique([vocabulary[t.encode()] for t in terms(text)], return_counts=True)
            best = R.Best(1, 10)
            R.walk(treaps, own[None, :], times[None, :], best, ids, np.zeros(len(ids), bool), narrow)
            got += [(item, r, int(i), int(s)) for r, (i, s) in enumerate(zip(best.doc, best.score, strict=True), 1)]
        assert sorted(got, key=repr) == want


def test_treaps_stay_shallow_when_impacts_follow_the_documents():
    n = 5_000
    for impact in (np.arange(1, n + 1), np.arange(n, 0, -1), np.full(n, 7)):
        t = R.Treaps(np.zeros(n, np.int64), np.arange(n), impact.astype(np.int64), 1, n)
        depth, level = 0, np.array([t.root[0]])
        while len(level):
            level = np.concatenate([t.left[level], t.right[level]])
            level, depth = level[level != t.none], depth + 1
        assert depth < 200 and t.top[t.root[0]] == impact.max()


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "!?"), (4, "Alpha beta"), (5, "alpha BETA"), (None, "alpha beta"), (None, "alpha beta"), (6, "alpha " * 30_000 + "gamma"), (7, "alpha beta"), (7, "alpha beta"), (8, "É été"), (9, "é été"), (2**63 - 1, "alpha beta"), (-5, "beta"), (10, "x1 2"), *[(100 + i, "other words here") for i in range(20)]]
    items = [(1, "alpha beta"), (1, "gamma"), (2, None), (3, ""), (4, "nowhere at all"), (None, "beta beta alpha"), (5, "É été"), (6, "2 x1 2"), (7, "alpha beta"), (7, "alpha beta")]
    check(spark, docs, items)
    check(spark, docs, items, shard=2, max_words=1)
    check(spark, docs, [])
    check(spark, [], items)
    check(spark, [(1, None)], items)


def test_a_text_that_a_third_of_all_rows_hold(spark):
    docs = [(i, "the very same words in many rows") for i in range(600, 0, -1)] + [(1_000 + i, f"words of row {i} alone") for i in range(600)]
    check(spark, docs, [(1, "the same words"), (2, "row 17 alone"), (3, "many many words")])


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 1, 2, 3, 4), (2, "b c", 1, 2, 3, 4), (3, "d", 1, 2, 3, 4)], ["doc_id", "text", "item_id", "rank", "score", "terms"])
    items = spark.createDataFrame([("q", "a b", 1, 2)], ["item_id", "text", "doc_id", "item"])
    got = R.search(docs, items)
    assert dict(got.dtypes)["item_id"] == "string"
    assert sorted(tuple(r) for r in got.collect()) == [("q", *r[1:]) for r in brute([(1, "a b"), (2, "b c"), (3, "d")], [(0, "a b")])]
