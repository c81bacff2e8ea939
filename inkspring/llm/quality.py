"""Quality classifier: random Fourier features, ridge by partition-summed normal equations, isotonic calibration.

Every text becomes a dozen statistics of its characters, words and lines (nothing of its labels, language, source or id).
Standardised, they are mapped by random Fourier features, which approximate a Gaussian kernel. Each partition sums its
part of the normal equations per fold; the sums are added up row by row of the matrix, so the driver gets FOLDS
matrices of fixed size and solves for the ridge weights. Scores of folds left out are counted in bins and fitted by
isotonic regression, which turns ridge scores into probabilities.

The model is fitted on at most about FIT_DOCUMENTS labelled documents (``most`` is the parameter), drawn by a hash of
the id; their ids are a broadcast table of that size, so fitting reads the labelled texts where they lie. All documents
are scored in one pass.

Defined cases: null and empty texts have statistics of zero and are scored like any other, an empty table gives an empty
result; texts of any length are read whole, in memory in proportion to their own length; labels that are null or whose
document is missing are left out; repeated rows of a document are scored alike and each counts once per label row; with
no labels every score is 0.5, with one kind of label it is that kind; a null doc_id is never held out; a score equal to
the threshold is accepted, equal ridge scores get equal scores; extra columns keep their values whatever their names.
"""

from __future__ import annotations

import operator
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, set_aside, stored

DIM = 256
RIDGE = 1e-3
SEED = 11
FOLDS = 4
THRESHOLD = 0.3
HELD_OUT_MOD = 5
#: Labelled documents that the model is fitted on, at most about.
FIT_DOCUMENTS = 200_000
_BINS = 1024

_CLASS = np.full(256, 6, np.uint8)  # others: symbols
for _k, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\x0b\x0c\r", b".,;:'\"()-", b"!?")):
    _CLASS[np.frombuffer(_bytes, np.uint8)] = _k
_CLASS[128:] = 7
N_STATS = 15


def statistics(text: str | None) -> list[float]:
    """N_STATS numbers about a whole text."""
    if not text:
        return [0.0] * N_STATS
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    low, up, digit, _, point, mark, symbol, other = np.bincount(_CLASS[raw], minlength=8).tolist()
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_STATS
    lens = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    follow = words[1:]
    pairs = len(set(zip(words, follow, strict=False)))
    lines = [x for x in text.split("\n") if x]
    size = len(raw)
    return [
        float(np.log1p(n)), float(lens.mean()), float(lens.std()), up / max(1, low + up + other), digit / size, point / size, mark / size, symbol / size,
        len(counts) / n, float(np.log1p(len(counts)) / np.log1p(n)), pairs / max(1, n - 1), sum(map(operator.eq, words, follow)) / n,
        max(counts.values()) / n, 1 - len(set(lines)) / max(1, len(lines)), float((lens <= 3).mean()),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, x (statistics) of every row of ``docs(doc_id, text)``."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        x = [statistics(t) for t in b.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, x array<double>")


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(HELD_OUT_MOD)).cast("int")


@dataclass
class Model:
    """Fixed size, however many labels there are."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    bounds: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        w, b = rng.normal(size=(N_STATS, DIM)) / np.sqrt(N_STATS), rng.uniform(0, 2 * np.pi, DIM)
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / DIM) * np.cos(z @ w + b), np.ones((len(x), 1))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.values[0])
        return np.clip(np.interp(self.ridge(x), self.bounds, self.values), 0, 1).round(6)


def _matrix(b: pa.RecordBatch, column: str = "x") -> np.ndarray:
    return b.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)


def fit(stats: DataFrame, labels: DataFrame, ridge: float = RIDGE) -> Model:
    """A model from ``stats(doc_id, x)`` and ``labels(doc_id, quality)``, without the held-out fold."""
    spark = stats.sparkSession
    known = labels.where("quality is not null and doc_id is not null").select("doc_id", (F.col("quality") > 0).cast("double").alias("y"))
    train = stored(stats.join(known, "doc_id").where(remainder(F.col("doc_id")) != 0).select("x", "y", (remainder(F.col("doc_id")) - 1).alias("fold")))
    cells = [f(F.get("x", F.lit(i))) for i in range(N_STATS) for f in (F.avg, F.stddev_pop)]
    got = train.agg(F.count("*"), F.avg("y"), *cells).first()
    if not got[0] or got[1] in (0.0, 1.0):
        return Model(np.zeros(N_STATS), np.ones(N_STATS), None, np.zeros(1), np.array([0.5 if not got[0] else got[1]]))
    moments = np.array(got[2:], float).reshape(-1, 2)
    model = Model(moments[:, 0], np.where(moments[:, 1] > 1e-9, moments[:, 1], 1.0), None, np.zeros(1), np.zeros(1))
    size = DIM + 2  # the last column is the label: one matrix holds both sides of the equations

    def sums(batches):
        held = np.zeros((FOLDS, size, size))
        for b in batches:
            if b.num_rows:
                z = np.hstack([model.features(_matrix(b)), b.column("y").to_numpy()[:, None]])
                fold = b.column("fold").to_numpy()
                for k in range(FOLDS):
                    part = z[fold == k]
                    held[k] += part.T @ part
        rows = [(k, i, held[k, i].tobytes()) for k in range(FOLDS) for i in range(size)] if held.any() else []
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["fold", "i", "v"])

    def add(t: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(v) for v in t["v"].to_pylist()], axis=0)
        return pa.table({"fold": t["fold"][:1], "i": t["i"][:1], "v": pa.array([total.tobytes()], pa.binary())})

    schema = "fold int, i int, v binary"
    equations = np.zeros((FOLDS, size, size))
    for r in train.mapInArrow(sums, schema).groupBy("fold", "i").applyInArrow(add, schema).collect():
        equations[r["fold"], r["i"]] = np.frombuffer(r["v"])
    total = equations.sum(axis=0)

    def solve(e: np.ndarray) -> np.ndarray:
        n = max(1.0, e[DIM, DIM])
        penalty = ridge * n * np.eye(DIM + 1) / DIM
        penalty[DIM, DIM] = 1e-9
        return np.linalg.solve(e[:-1, :-1] + penalty, e[:-1, -1])

    left_out = [solve(total - equations[k]) for k in range(FOLDS)]

    def out_of_fold(b: pa.RecordBatch) -> pa.RecordBatch:
        z, fold = model.features(_matrix(b)), b.column("fold").to_numpy()
        s = np.einsum("ij,ij->i", z, np.stack(left_out)[fold])
        return pa.RecordBatch.from_arrays([pa.array(np.clip(np.round(s * _BINS), -2 * _BINS, 3 * _BINS).astype(np.int64)), b.column("y")], ["bin", "y"])

    bins = arrow_map(train.select("x", "y", "fold"), out_of_fold, "bin long, y double").groupBy("bin").agg(F.avg("y").alias("y"), F.count("*").cast("double").alias("w"))
    bins = stored(bins.select((F.col("bin") / _BINS).alias("s"), "y", "w"))
    iso = IsotonicRegression(featuresCol="s", labelCol="y", weightCol="w").fit(bins)
    model.weights = solve(total)
    model.bounds, model.values = np.array(iso.boundaries.toArray()), np.array(iso.predictions.toArray())
    return model


def score_statistics(stats: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted from statistics."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(_matrix(b)), pa.float64())], ["doc_id", "score"])

    scored = arrow_map(stats.select("doc_id", "x"), run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def labelled(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> DataFrame:
    """doc_id, text of the documents to fit on: those with a label outside the held-out fold, or a hashed share of them."""
    known = labels.where("quality is not null and doc_id is not null").where(remainder(F.col("doc_id")) != 0)
    ids = known.select("doc_id").distinct()
    n = ids.count()
    if n > most:
        ids = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * most / n))
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")


def model_of(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> Model:
    return fit(document_statistics(labelled(docs, labels, most)), labels)


def classify(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` with held_out, score (probability of good quality) and predicted."""
    return score_statistics(document_statistics(docs), model_of(docs, labels, most))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = FIT_DOCUMENTS) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns as they are."""
    docs, named = set_aside(docs)
    model = model_of(docs, labels, most)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([statistics(t) for t in b.column("text").to_pylist()]).reshape(-1, N_STATS)
        return b.filter(pa.array(model.score(x) >= threshold))

    return named(arrow_map(docs, run, docs.schema))
