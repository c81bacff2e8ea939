"""The pipeline, stage by stage, against plain versions of what each stage must do."""

import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

import corpus_pipeline as c
from inkspring.llm import mixing
from inkspring.llm.common import stored, table
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import brute as groups


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    steps = [docs]
    for _, f in c.STAGES:
        steps.append(stored(f(spark, steps[-1], sf)))
    rows = [[r.asDict() for r in s.collect()] for s in steps]
    assert all(s.columns == docs.columns for s in steps[:-1])
    before = {r["doc_id"]: r["text"] for r in rows[0]}
    good = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    kept = {r["doc_id"]: r["text"] for r in rows[1]}
    assert all(before[i] == t for i, t in kept.items()) and len(kept) == len(rows[1])
    right = [(i in kept) == bool(q) for i, q in good.items() if i in before]
    assert sum(right) >= 0.9 * len(right)
    want = groups(list(kept.items()))
    assert {r["doc_id"] for r in rows[2]} == {g for _, g, _ in want.values()} and len(rows[2]) == len({g for _, g, _ in want.values()})
    items = [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
    unique = {r["doc_id"]: r["text"] for r in rows[2]}
    was = {r[0]: r for r in contaminated(list(unique.items()), items)}
    clean = {r["doc_id"]: r["text"] for r in rows[3]}
    assert set(clean) == {i for i, r in was.items() if 2 * r[2] <= r[1]}
    assert all(clean[i] == unique[i] for i in clean if not was[i][2])
    assert not any(r[2] for r in contaminated(list(clean.items()), items))
    source = {r["doc_id"]: r["source"] for r in rows[3]}
    size = Counter()
    for i, t in clean.items():
        size[source[i]] += len(words(t))
    got = Counter()
    for r in rows[4]:
        got[r["source"]] += len(words(r["text"]))
        assert set(words(r["text"])) <= set(words(clean[r["doc_id"]])) and r["n_chars"] == (len(r["text"]) if r["text"] != clean[r["doc_id"]] else r["n_chars"])
    for s, goal in mixing.targets(size).items():
        assert abs(got[s] - goal) <= 0.02 * goal + 64
    assert Counter((r["doc_id"], r["text"]) for r in rows[5]) == Counter((r["doc_id"], r["text"]) for r in rows[4])
    places = defaultdict(list)
    for r in rows[5]:
        places[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert c.run(spark, sf).count() == len(rows[5])


@pytest.mark.parametrize(
    ("stage", "module", "function"),
    [(c.quality_stage, c.quality, "keep_good"), (c.near_duplicate_stage, c.jaccard, "keep_one"), (c.decontamination_stage, c.decontaminate, "remove_contaminated"), (c.mixing_stage, c.mixing, "mixed_documents")],
)
def test_python_gets_few_texts_at_a_time(spark, sf, monkeypatch, stage, module, function):
    """A stage's result is run by its reader, so the size of its Arrow batches must hold then."""

    def lengths(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    monkeypatch.setattr(module, function, lambda docs, *_: docs.mapInArrow(lengths, "n long"))
    rows, key = spark.range(0, 6_000, 1, 1), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for given, most in (("10000", 2_000), ("0", 2_000), ("500", 500)):  # 0: no limit; a smaller one stays
            spark.conf.set(key, given)
            got = [r["n"] for r in stage(spark, rows, sf).collect()]
            assert sum(got) == 6_000 and max(got) == most
    finally:
        spark.conf.set(key, before)
