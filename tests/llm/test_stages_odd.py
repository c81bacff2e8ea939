"""Every pipeline stage on nulls, repeats, long texts, clashing columns and an empty table."""

import pytest

import corpus_pipeline as c

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id int, _th string, text_hash int, start int, src string, score int, shard string, slot int, h int, comp int, `a b` int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("odd")
    item = " ".join(f"bench{i}" for i in range(12))
    spark.createDataFrame([(1, item), (None, "x"), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(1, 9)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    texts = [(1, "plain words of one text here"), (1, "plain words of one text here"), (2, None), (3, ""), (None, "no id here at all"), (None, None), (5, "long " * 60_000), (6, f"before it {item} and after that some more words follow to the end of it"), (7, "é ü ß\t\n"), (8, "ties ties ties ties ties ties")]
    rows = [(i, t, None if k % 3 else "en", None if k % 4 == 0 else f"s{k % 3}", None if k % 5 == 0 else len(t or ""), k, "t", k, k, "z", k, "w", k, k, k, k) for k, (i, t) in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    return str(d)


@pytest.mark.parametrize("k", range(5))
def test_stage(spark, folder, k):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    name, stage = c.STAGES[k]
    out = stage(spark, docs, folder)
    rows = out.collect()
    if k < 4:
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    known = {(r["doc_id"], r["a b"]): r for r in docs.collect()}
    for r in rows:
        was = known.get((r["doc_id"], r["a b"]))
        assert was is not None
        assert all(r[x] == was[x] for x in ("_id", "_th", "text_hash", "start", "src", "score", "h", "comp"))
    assert name != "sharding" or len(rows) == docs.count()
    assert stage(spark, docs.limit(0), folder).count() == 0
