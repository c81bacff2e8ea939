"""The n-gram Jaccard join against all pairs."""

import re
import time
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from inkspring.llm import jaccard
from inkspring.llm.common import SHUFFLES_GO, stored, table

SCHEMA = "doc_id long, text string"


def brute(rows):
    def lower(t):
        return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")

    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        k = min(5, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    linked = dict.fromkeys(ids, 0)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b]:
                o = len(sets[a] & sets[b])
                if 100 * o >= 75 * (len(sets[a]) + len(sets[b]) - o):
                    linked[a] += 1
                    linked[b] += 1
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), linked[i]) for i in ids}


def check(spark, rows):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in jaccard.jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)


def test_all_pairs_small_table(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    check(spark, rows)


def test_chains_ties_and_odd_texts(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[i : i + 40])) for i in range(0, 20)]  # each overlaps its neighbours
    rows += [(50, None), (51, ""), (52, " \t\n"), (53, "one two"), (54, "ONE  two"), (55, "one two three"), (56, "É two"), (57, "é two")]
    # exactly 75%: 4 of 4 and 1 more, 3 of 4 shingles
    rows += [(70, "a b c d e f g h"), (71, "a b c d e f g"), (72, "a b c d e f g h i j")]
    rows += [(90 + i, " ".join(f"same{k}" for k in range(30)) + (f" tail{i}" if i % 3 else "")) for i in range(60)]
    check(spark, rows)


def test_empty_table(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_keep_one(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, "A b c d e f", "y"), (3, "", "z"), (3, "", "z"), (4, None, "z"), (5, "other words", None)]
    rows += [(None, "null id one", "n"), (None, "null id two", "n"), (None, "null id two", "n"), (None, "other words", "n"), (6, "same id one text", "s"), (6, "same id another text", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in jaccard.keep_one(df).collect()))
    assert got == [(False, 1, "a b c d e f"), (False, 3, ""), (False, 3, ""), (False, 4, ""), (False, 5, "other words"), (False, 6, "same id another text"), (False, 6, "same id one text"), (True, 0, "null id one"), (True, 0, "null id two")]


def test_large_near_copy_groups_and_far_members(spark, monkeypatch):
    import random

    rng = random.Random(8)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(260):  # one long list and several homes; some members too far from each other to be linked
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(400)}"
        rows.append((i, " ".join(w[rng.randint(0, 6) : len(w) - rng.randint(0, 6)])))
    other = [f"c{i}" for i in range(50)]
    rows += [(1000 + i, " ".join([*other[: 50 - i % 9], f"t{i}"])) for i in range(70)]
    rows += [(2000 + i, " ".join([*base[:40], *other[:40], f"m{i}"])) for i in range(40)]
    monkeypatch.setattr(jaccard, "LONG_LIST", 5)
    monkeypatch.setattr(jaccard, "BUCKET", 500)
    monkeypatch.setattr(jaccard, "CHUNK", 900)
    check(spark, rows)


def test_nodes_of_their_own_for_sets_that_share_half_a_fingerprint(spark, monkeypatch):
    prints = spark.createDataFrame([(1, 5, 7), (1, 5, 7), (1, 5, 8), (1, 6, 7), (0, 9, 1), (0, 9, 2)], "n long, s1 long, s2 long")
    twins = jaccard.twins_of(prints)
    assert set(twins) == {(5, 7), (5, 8)}
    nodes = {(r["s1"], r["s2"]): r["node"] for r in jaccard._nodes(prints, twins).collect()}
    assert nodes[6, 7] == 6 and {nodes[k] for k in twins} == set(twins.values()) and nodes[5, 7] != nodes[5, 8]
    # the same answers when every set is taken for such a twin
    rows = [(i, f"t{i // 2} " * 3 + " ".join(f"w{i // 4}x{k}" for k in range(20))) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    every = {(r["s1"], r["s2"]): r["node"] for r in jaccard.fingerprints(docs).select("s1", "s2", F.xxhash64("s1", "s2").alias("node")).distinct().collect()}
    monkeypatch.setattr(jaccard, "twins_of", lambda prints: every)
    check(spark, rows)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, "one two three four five six", "a", 1, 2, 3) for i in (4, 5)], "doc_id long, text string, node string, th int, n int, comp int")
    assert sorted(tuple(r) for r in jaccard.jaccard_components(df).collect()) == [(4, 2, 1, 4, 4), (5, 2, 1, 4, 4)]


def test_shuffle_files_go_with_the_write(spark):
    """What a stored table was made from takes no disk while the next ones are made."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in Path(d).rglob("shuffle_*.data")}
    before, setting = files(), spark.conf.get(SHUFFLES_GO)
    out = stored(spark.range(0, 10_000, 1, 4).groupBy((F.col("id") % 100).alias("k")).count())
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(SHUFFLES_GO) == setting and sorted(tuple(r) for r in out.collect()) == [(k, 100) for k in range(100)]


def test_small_pieces_take_no_more_than_a_node_a_shingle(spark, sf, monkeypatch):
    """With many buckets (a large input) a piece has hardly a set twice; with few it lists each set once."""
    docs, dealt = table(spark, sf, "documents").limit(200), []
    frame = type(docs)
    plain = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, *by: dealt.append(self) or plain(self, *by))
    for buckets in (2, 20_000):
        jaccard.postings(docs, np.empty(0, np.uint64), buckets, {})
    pieces = [[(len(r["who"] or ""), len(r["nodes"])) for r in d.where("n is null").select("who", "nodes").collect()] for d in dealt]
    assert all(who + nodes <= 8 * max(who // 2, nodes // 8) for p in pieces for who, nodes in p)
    assert all(who for who, _ in pieces[0]) and len(pieces[1]) > 100
