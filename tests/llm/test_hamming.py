"""Exact top-k search against all pairs."""

import numpy as np

from inkspring.llm import hamming
from inkspring.llm.common import table

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=10, every=50):
    ok = [(i, np.array([x is not None and x > 0 for x in v])) for i, v in rows if i is not None and v is not None and len(v) == 64]
    out = []
    for i, v in ok:
        if i % every == 0:
            best = sorted((int((v != w).sum()), j) for j, w in ok)[:k]
            out += [(i, r + 1, j, d) for r, (d, j) in enumerate(best)]
    return sorted(out)


def check(spark, rows, **kw):
    got = hamming.search(spark.createDataFrame(rows, SCHEMA), **kw).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, kw.get("k", 10))


def test_table(spark, sf):
    check(spark, [(r["vec_id"], list(r["embedding"])) for r in table(spark, sf, "embeddings").select("vec_id", "embedding").collect()])


def test_copies_ties_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    same, near = rng.normal(size=64), rng.normal(size=64)
    rows = [(i, same.tolist()) for i in range(120)] + [(i, (near * np.where(np.arange(64) == i % 7, -1, 1)).tolist()) for i in range(120, 260)]
    rows += [(300, same.tolist()), (300, same.tolist()), (301, None), (None, same.tolist()), (350, [1.0]), (400, [0.0] * 63 + [None]), (401, [float("nan")] * 64)]
    check(spark, rows)
    check(spark, rows, k=3)


def test_few_rows_and_none(spark):
    check(spark, [(0, [1.0] * 64), (1, [-1.0] * 64)])
    assert hamming.search(spark.createDataFrame([], SCHEMA)).count() == 0


def test_small_chunks_give_the_same(spark, sf):
    base = hamming.codes(table(spark, sf, "embeddings"))
    asked = base.where("id % 50 = 0")
    a = sorted(tuple(r) for r in hamming.top_k(base, asked).collect())
    assert a == sorted(tuple(r) for r in hamming.top_k(base, asked, chunk=9).collect())
    assert a == sorted(tuple(r) for r in hamming.top_k(base, asked, chunk=30, queries_a_task=2).collect())


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, [1.0] * 64, 1, 2, 3, 4) for i in (0, 1)], SCHEMA + ", id int, code int, seg int, query int")
    assert sorted(tuple(r) for r in hamming.search(df).collect()) == [(0, 1, 0, 0), (0, 2, 1, 0)]


def test_a_code_that_a_third_of_all_rows_have(spark):
    """Queries and answers of one code are dealt over tasks and come back whole."""
    import random

    from inkspring.llm import hamming

    rng = random.Random(8)
    same = [1.0 if i % 3 else -1.0 for i in range(64)]
    rows = [(i, same if i % 3 == 0 else [rng.choice([-1.0, 1.0]) for _ in range(64)]) for i in range(1_500)]
    got = {}
    for r in hamming.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["distance"], r["vec_id"]))
    for q, v in rows[::50]:
        want = sorted((sum((a > 0) != (b > 0) for a, b in zip(v, w, strict=True)), i) for i, w in rows)[:10]
        assert sorted(got.pop(q)) == [(k, d, i) for k, (d, i) in enumerate(want, 1)]
    assert not got
