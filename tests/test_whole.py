"""Queries and operators over whole inputs, against plain Python."""

import json
import re
import unicodedata
from itertools import combinations_with_replacement

import numpy as np
import pytest

from inkspring.operators import pairs as P
from inkspring.plans import QUERIES
from inkspring.plans.graphs import vector_clusters
from inkspring.registry import table


@pytest.fixture(scope="module")
def vectors(spark, sf):
    rows = sorted((r["vec_id"], r["label"], r["embedding"]) for r in table(spark, sf, "embeddings").select("vec_id", "label", "embedding").collect())
    x = np.array([r[2] for r in rows], dtype=np.float64)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)).round(5)
    return [r[0] for r in rows], [r[1] for r in rows], x, d


def clusters(ids, near):
    top = {i: i for i in ids}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in zip(*np.nonzero(near), strict=True):
        u, v = root(ids[a]), root(ids[b])
        top[max(u, v)] = min(u, v)
    return {i: root(i) for i in ids}


def test_clusters_link_any_two_near_vectors(spark, sf, vectors):
    ids, _, _, d = vectors
    want = clusters(ids, d < 1.15)
    assert {r["vec_id"]: r["first"] for r in QUERIES["X4_threshold_clusters"](spark, sf).collect()} == want
    # cut by many blocks, and at a limit that leaves many clusters
    e = table(spark, sf, "embeddings")
    for limit in (1.15, 1.0):
        assert {r["vec_id"]: r["first"] for r in vector_clusters(e, limit, block=60).collect()} == clusters(ids, d < limit)
    assert any(want[a] == want[b] and (a - b) % 20 for a in ids[:50] for b in ids[:50])


def test_copies_and_odd_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(600)] + [(700, [0.0, 1.0]), (701, None), (702, [0.0, 1.00001]), (703, [9.0, 9.0])]
    got = {r["vec_id"]: r["first"] for r in vector_clusters(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 0.5, block=50).collect()}
    assert {got[i] for i in range(600)} == {0} and [got[i] for i in (700, 701, 702, 703)] == [700, 701, 700, 703]


def test_rounded_distances_are_those_of_differences():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(50, 8)) * 1000, rng.normal(size=(40, 8)) * 1000
    y[:10] = x[:10] + 1e-5
    assert np.array_equal(P.rounded(x, y), np.rint(np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2)) * 1e5) / 1e5)


def test_every_crop_takes_part(spark, sf, vectors):
    ids, labels, x, _ = vectors
    names = sorted(set(labels))
    means = np.array([x[[k == n for k in labels]].mean(axis=0) for n in names])
    to_mean = np.sqrt(((x[:, None] - means[None]) ** 2).sum(axis=2)).round(5)
    scores = {(r["vec_id"], r["candidate"]): (r["score"], r["place"]) for r in QUERIES["J14_candidate_scores"](spark, sf).collect()}
    assert len(scores) == len(ids) * len(names)
    for i, v in enumerate(ids):
        order = sorted((to_mean[i, k], n) for k, n in enumerate(names))
        assert all(abs(scores[v, n][0] - s) < 2e-5 and scores[v, n][1] == p for p, (s, n) in enumerate(order, 1))
    anchors = [(n, i) for k, n in enumerate(names) for _, _, i in sorted((to_mean[i, k], v, i) for i, v in enumerate(ids) if labels[i] == n)[:4]]
    want = {}
    for i, v in enumerate(ids):
        best = min((round(float(np.sqrt(((x[i] - x[j]) ** 2).sum())), 5), n) for n, j in anchors)
        if best[0] < 1.3:
            want[v] = best
    assert {r["vec_id"]: (r["distance"], r["person"]) for r in QUERIES["J13_nearest_anchor"](spark, sf).collect()} == want


def test_every_event_has_a_place(spark, sf):
    turns, events = table(spark, sf, "conversations").collect(), table(spark, sf, "events").collect()
    rows = [(r["conv_id"], r["turn"], 0, len(r["text"])) for r in turns] + [(r["event_id"] % 100, r["user_id"] % 8, 1, len(r["props"])) for r in events]
    place, want = {}, []
    for r in sorted(rows):
        place[r[0]] = place.get(r[0], 0) + 1
        want.append((*r, place[r[0]]))
    assert sorted((r["conv_id"], r["turn"], r["kind"], r["n"], r["place"]) for r in QUERIES["W18_reading_pages"](spark, sf).collect()) == sorted(want)


def test_consensus_looks_at_all_vectors(spark, sf, vectors):
    ids, labels, x, _ = vectors
    from inkspring.operators import registry as R

    e = table(spark, sf, "embeddings")
    for got in (QUERIES["A8_consensus_mean"](spark, sf), P.consensus(e, "label", "vec_id", "embedding", 16, block=7)):
        means = {r["label"]: r["mean"] for r in got.collect()}
        assert set(means) == set(labels)
        for n, mean in means.items():
            assert np.allclose(mean, R.unit_mean(x[[k == n for k in labels]], 16))


def test_consensus_of_few_copies_and_opposites(spark):
    rows = [(1, 1, [2.0, 0.0]), (2, 1, [1.0, 0.0]), (2, 2, [-1.0, 0.0])] + [(3, i, [0.0, 1.0]) for i in range(100)] + [(3, 200 + i, [1.0, 0.1 * i]) for i in range(20)]
    got = {r["label"]: r["mean"] for r in P.consensus(spark.createDataFrame(rows, "label int, vec_id long, embedding array<float>"), "label", "vec_id", "embedding", 16, block=9).collect()}
    assert got == {1: [1.0, 0.0], 2: [1.0, 0.0], 3: [0.0, 1.0]}


def test_pairs_are_counted_before_the_shuffle(spark, sf, vectors):
    ids, labels, _, d = vectors
    e = table(spark, sf, "embeddings")
    rows = P.spread(e, "label", "vec_id", "embedding", 1.2, block=9).collect()
    near = P.closest(e, "label", "vec_id", "embedding", 3, block=9).collect()
    for n in set(labels):
        at = [i for i, k in enumerate(labels) if k == n]
        want = sorted((d[i, j], ids[i], ids[j]) for i in at for j in at if i < j)
        mine = [r for r in rows if r["label"] == n]
        assert sum(r["n"] for r in mine) == len(want) and sum(r["near"] for r in mine) == sum(v < 1.2 for v, _, _ in want)
        assert min((r["d"], r["a"], r["b"]) for r in mine if r["a"] is not None) == want[0]
        for r in near:
            if r["label"] == n:
                i = ids.index(r["id"])
                assert [(x["d"], x["id"]) for x in r["near"]] == sorted((d[i, j], ids[j]) for j in at if j != i)[:3]


def test_texts_are_taken_whole(spark, sf):
    from inkspring.operators import names as N
    from inkspring.operators import stateful as S

    turns = {(r["conv_id"], r["turn"]): r["text"] for r in table(spark, sf, "conversations").collect()}
    of = lambda name: {(r["conv_id"], r["turn"]): r for r in QUERIES[name](spark, sf).collect()}
    units, parts, ranges, lines, sizes = map(of, ("P15_units", "P16_name_parts", "W22_allocate", "W23_fit_lines", "W24_font_search"))
    assert any(len(t) > 200 for t in turns.values()) and any(len(t.split()) > 40 for t in turns.values())
    for k, t in turns.items():
        w = t.split()
        assert list(zip(units[k]["starts"], units[k]["ends"], strict=True)) == [(a, b) for _, a, b in N.units(t)] and units[k]["key"] == "".join(x for x, _, _ in N.units(t))
        assert parts[k]["parts"] == len(re.split("[ -]+", t))
        assert json.loads(ranges[k]["ranges"])[-1][1] == len(w)
        assert lines[k]["lines"] == len(S.fit_lines(w, [120.0] * 10, 6.0) or []) and sizes[k]["size"] == (S.largest_size(w, [160.0] * 6, list(range(4, 25))) or 0)


def test_allocate_finds_the_least_cost():
    from inkspring.operators import stateful as S

    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 7, 12):
        for areas in ([1.0, 2.0, 1.0], [3.0, 1.0], [0.0, 0.0]):
            sizes = rng.integers(0, 5, n).tolist()
            total, room = sum(sizes) or 1, sum(areas) or 1.0
            ways = [[(a, b) for a, b in zip((0, *c), (*c, n), strict=True)] for c in combinations_with_replacement(range(n + 1), len(areas) - 1)]
            cost = lambda w: sum((sum(sizes[a:b]) / total - x / room) ** 2 for (a, b), x in zip(w, areas, strict=True))  # noqa: E731, B023
            assert np.isclose(cost(S.allocate(sizes, areas)), min(map(cost, ways)))


def test_documents_are_taken_whole(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    of = lambda name: {r["doc_id"]: r for r in QUERIES[name](spark, sf).collect()}
    key, safe, fold, cell, mark = map(of, ("P11_story_key", "P31_oom_and_scrub", "T7_folding", "T12_cell_escape", "X16_token_length"))
    assert any(len(t) > 200 for t in docs.values())
    for i, t in docs.items():
        low = unicodedata.normalize("NFC", t).lower().replace("ß", "ss")
        assert fold[i]["folded"] == low and fold[i]["low"] == t.lower()
        assert key[i]["key"] == re.sub(r"[^\w]+", "-", low).strip("-")
        assert safe[i]["safe"] == re.sub('[<>|{}"]', "", t)
        assert cell[i]["cell"] == t.replace("&", "&amp;").replace("<", "&lt;").replace("|", "\\|").replace("\n", " ")
        p = t.find(".")
        assert (mark[i]["n"], mark[i]["truncated"], mark[i]["empty"]) == (p if p >= 0 else len(t), p < 0, p == 0)


def test_every_span_is_moved(spark, sf):
    from inkspring.operators import names as N

    def brute(t):
        hits = [s for _, spans in N.apply_rules(t, [("the", "thee")])[1] for s in spans]
        return [(*m.span(), *N.move_span(m.span(), hits, 4)) for m in re.finditer(r"\S+", t)]

    odd = "the 'the' x\u0301 The-end, then the"
    assert [(*a, *b) for a, b in N.moved_words(odd, "the", "thee")] == brute(odd)
    got = {(r["conv_id"], r["turn"]): r["spans"] for r in QUERIES["T4_move_span"](spark, sf).collect()}
    moved = 0
    for r in table(spark, sf, "conversations").collect():
        spans = got[r["conv_id"], r["turn"]]
        assert [tuple(x) for x in spans] == brute(r["text"])
        new = N.apply_rules(r["text"], [("the", "thee")])[0]
        for a, b, x, y in spans:
            if x is not None and y - x == b - a:
                assert new[x:y] == r["text"][a:b]
                moved += x > a
    assert moved
