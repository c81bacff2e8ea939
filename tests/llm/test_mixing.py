"""Mixing: targets, nearness, repeats, reruns and the mixed texts."""

import re
from collections import Counter, defaultdict

from inkspring.llm import mixing
from inkspring.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_targets_cap_and_reshare():
    t = mixing.targets({"b": 100, "a": 1, None: 10})
    # a: weight 5, stops at 3; b: weight 2; null: weight 1 stops at 30; b takes the rest
    assert t["a"] == 3 and t[None] == 30 and abs(sum(t.values()) - 111) < 1e-9


def test_documents(spark, sf):
    docs = table(spark, sf, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    size = {i: len(words(t)) for i, t, _ in rows}
    per = Counter()
    for i, _, s in rows:
        per[s] += size[i]
    goal = mixing.targets(per)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == per[r["source"]]
        assert abs(r["target"] - goal[r["source"]]) < 1e-6 * max(1, goal[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, n in taken.items():
        assert abs(n - goal[s]) <= 0.02 * goal[s] + 64
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(docs.repartition(3)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_mixed_texts_have_the_taken_words(spark, sf):
    docs = table(spark, sf, "documents")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    held = Counter()
    for r in mixing.mixed_documents(docs).collect():
        held[r["doc_id"]] += len(words(r["text"]))
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in held.items() if v}


def test_odd_rows(spark):
    rows = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (3, "x y", "en", None, 3), (3, "x y", "en", None, 3), (None, " z ", None, "b", 3), (5, "\tq\n", "e", "a", 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df).collect()
    assert len(got) == 6 and sorted(r["size"] for r in got) == [0, 0, 1, 1, 2, 2]
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mixed_documents(df).columns == df.columns
    mixing.mixed_documents(df).collect()
    assert mixing.mix(df.limit(0)).count() == 0


def test_permutation_is_one():
    import numpy as np

    for n in (1, 2, 3, 10, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 7).tolist()) == list(range(n))


def test_twins_of_different_sources_keep_their_columns(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(1, text, "en", "web", 1), (1, text, "de", "book", 2), (1, text, "de", None, 3), (2, "x " * 300, "en", "web", 4), (2, "x " * 300, "en", "web", 4), (None, text, None, "book", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, k1 int")
    goal = mixing.targets({"book": 800, "web": 1000, None: 400})
    taken, held = Counter(), Counter()
    for r in mixing.mix(df).collect():
        assert abs(r["target"] - goal[r["source"]]) < 1e-6
        taken[r["doc_id"], r["source"]] += r["taken"]
    known = {(r[0], r[3], r[2], r[4]) for r in rows}
    for r in mixing.mixed_documents(df).collect():
        assert (r["doc_id"], r["source"], r["lang"], r["k1"]) in known
        held[r["doc_id"], r["source"]] += len(words(r["text"]))
    per = Counter()
    for (_, s), n in taken.items():
        per[s] += n
    assert all(abs(per[s] - g) <= 0.02 * g + 64 for s, g in goal.items())
    assert held == taken


def test_word_counts_and_pieces(spark, monkeypatch):
    import pyarrow as pa

    texts = [None, "", " ", "a", " a", "a ", "a\tb\x0bc", "\u00a0x \u2003", "é ü", "x" * 100_000 + " y", "a\x1fb \x85"]
    assert mixing.sizes_of(pa.array(texts)).tolist() == [len(words(t)) for t in texts]
    assert mixing.sizes_of(pa.array(texts).slice(3, 5)).tolist() == [len(words(t)) for t in texts[3:8]]
    assert mixing.sizes_of(pa.array([], pa.string())).tolist() == [] and mixing.sizes_of(pa.array([None], pa.string())).tolist() == [0]
    # a third of the rows are one row: it is cut into pieces, and nothing is lost
    monkeypatch.setattr(mixing, "_ROWS_PER_PIECE", 7)
    monkeypatch.setattr(mixing, "_RUN", 2)
    monkeypatch.setattr(mixing, "_ROWS_PER_BUCKET", 5)
    monkeypatch.setattr(mixing, "SLOTS_PER_SHARD", 16)
    df = spark.createDataFrame([(5, "one two three four five six seven", None, "a", 1)] * 50 + [(i, f"t{i} " * (i % 40), None, "ab"[i % 2], 2) for i in range(100)], SCHEMA)
    got = mixing.mix(df).collect()
    assert len(got) == 150 and sum(r["doc_id"] == 5 and r["size"] == 7 for r in got) == 50
    goal = {r["source"]: r["target"] for r in got}
    for s, g in goal.items():
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - g) <= 0.05 * g + 64
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)


def test_clashing_columns(spark):
    names = "size source_size target src bucket start times k2 block drawn pass _runs _row _size buckets each piece".split()
    df = spark.createDataFrame([(i, f"w{i} " * i, "en", "ab"[i % 2], *range(len(names))) for i in range(1, 30)], "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} int" for n in names))
    assert mixing.mix(df).count() == 29
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and {tuple(r)[4:] for r in out.collect()} == {tuple(range(len(names)))}
