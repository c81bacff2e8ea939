"""Quality classifier: held-out accuracy, what it may see, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkspring.llm import quality as q
from inkspring.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    return q.classify(docs, labels).join(labels, "doc_id", "left").toPandas()


def test_held_out_accuracy(scored):
    assert len(scored) == 1000 and scored["score"].between(0, 1).all()
    assert (scored["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored["doc_id"]]).all()
    assert (scored["predicted"] == (scored["score"] >= 0.3)).all()
    held = scored[scored["held_out"] & scored["quality"].notna()]
    good, bad = held[held["quality"] == 1]["score"].to_numpy(), held[held["quality"] == 0]["score"].to_numpy()
    auc = np.mean((good[:, None] > bad).astype(float) + 0.5 * (good[:, None] == bad))
    assert auc > 0.95
    assert (held["predicted"] == held["quality"]).mean() > 0.95


def test_held_out_labels_are_not_read(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumn("quality", F.when(q.remainder(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    stats = q.document_statistics(docs).cache()
    a, b = q.fit(stats, labels), q.fit(stats, turned)
    assert np.allclose(a.weights, b.weights) and np.allclose(a.values, b.values)


def test_odd_rows(spark):
    good = "The quick brown fox jumps over the lazy dog near the river bank and then sleeps under an old tree."
    rows = [(i, f"{good} Number {i} differs a little from the others here.", 1) for i in range(1, 41)]
    rows += [(i, "BUY NOW!! " * 20 + f"### {i}", 0) for i in range(41, 71)]
    docs = spark.createDataFrame([(i, t, 5) for i, t, _ in rows] + [(100, None, 1), (101, "", 1), (None, good, 1), (102, "x" * 500_000, 1), (1, rows[0][1], 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(900, 1), (100, None), (None, 1)], "doc_id long, quality int")
    got = q.classify(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["predicted"] == y for i, _, y in rows) and by[None]["held_out"] is False
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns and {i for i, _, y in rows if y} <= {r["doc_id"] for r in kept.collect()}


def test_no_labels_and_one_kind(spark):
    docs = spark.createDataFrame([(i, "some text here") for i in range(8)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in q.classify(docs, none).collect()} == {0.5}
    assert {r["score"] for r in q.classify(docs, spark.createDataFrame([(i, 1) for i in range(8)], none.schema)).collect()} == {1.0}
    assert q.classify(docs.limit(0), none).count() == 0


def test_against_an_independent_fit(spark):
    """Random Fourier features, ridge on all folds, isotonic on out-of-fold scores: written again over whole matrices."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = [(r["doc_id"], float(r["quality"] > 0)) for r in labels.orderBy("doc_id").collect() if r["quality"] is not None and r["doc_id"] in text]
    rows = [(i, y, zlib.crc32(str(i).encode()) % 5) for i, y in rows]
    rows = [r for r in rows if r[2] != 0]
    x, y, fold = np.array([q.statistics(text[i]) for i, _, _ in rows]), np.array([r[1] for r in rows]), np.array([r[2] - 1 for r in rows])
    mean, std = x.mean(axis=0), x.std(axis=0)
    rng = np.random.default_rng(q.SEED)
    w = rng.normal(size=(q.N_STATS, q.DIM)) / np.sqrt(q.N_STATS)
    b = rng.uniform(0, 2 * np.pi, q.DIM)
    feats = lambda a: np.hstack([np.sqrt(2 / q.DIM) * np.cos(np.clip((a - mean) / np.where(std > 1e-9, std, 1), -6, 6) @ w + b), np.ones((len(a), 1))])
    z = feats(x)

    def ridge(part):
        pen = np.full(q.DIM + 1, q.RIDGE * part.sum() / q.DIM)
        pen[-1] = 1e-9
        return np.linalg.lstsq(np.vstack([z[part], np.diag(np.sqrt(pen))]), np.concatenate([y[part], np.zeros(q.DIM + 1)]), rcond=None)[0]

    # the kernel that the features stand for
    inner = z[:40, :-1] @ z[:40, :-1].T
    gauss = np.exp(-((((x[:40, None] - x[None, :40]) / std) ** 2).sum(axis=2)) / (2 * q.N_STATS))
    assert np.abs(inner - gauss).mean() < 0.1
    outs = np.empty(len(y))
    for k in range(q.FOLDS):
        outs[fold == k] = z[fold == k] @ ridge(fold != k)
    bins = np.round(outs * 1024) / 1024
    # pool adjacent violators
    pools = [[s, s, y[bins == s].mean(), (bins == s).sum()] for s in np.unique(bins)]
    k = 0
    while k < len(pools) - 1:
        if pools[k][2] > pools[k + 1][2] + 1e-15:
            a, c = pools[k], pools.pop(k + 1)
            pools[k] = [a[0], c[1], (a[2] * a[3] + c[2] * c[3]) / (a[3] + c[3]), a[3] + c[3]]
            k = max(0, k - 1)
        else:
            k += 1
    xs, ys = np.array([p for a, c, _, _ in pools for p in (a, c)]), np.array([v for _, _, v, _ in pools for _ in (0, 1)])
    want = np.clip(np.interp(feats(np.array([q.statistics(t) for t in text.values()])) @ ridge(np.ones(len(y), bool)), xs, ys), 0, 1)
    got = {r["doc_id"]: r["score"] for r in q.classify(docs, labels).collect()}
    assert np.abs(np.array([got[i] for i in text]) - want).max() < 0.01


def test_fitted_on_a_bounded_share(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    n = q.labelled(docs, labels, 10**6).count()
    some = q.labelled(docs, labels, 100).count()
    assert 40 < some < 180 < n
    got = q.classify(docs, labels, most=100).join(labels, "doc_id").toPandas()
    assert ((got["score"] >= 0.5) == (got["quality"] > 0)).mean() > 0.8


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(i, f"some text number {i}", "s", 1, 2, 3, 4) for i in range(1, 9)], "doc_id long, text string, score string, x int, y int, fold int, quality int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id long, quality int")
    assert q.classify(docs, labels).count() == 8
    out = q.keep_good(docs, labels, threshold=0.0)
    assert out.columns == docs.columns and {tuple(r)[2:] for r in out.collect()} == {("s", 1, 2, 3, 4)}
