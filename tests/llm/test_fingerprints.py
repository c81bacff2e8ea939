"""Fingerprints against a plain version of hashing, order and comparison."""

import hashlib
import re

import xxhash
from pyspark.sql import functions as F

from inkspring.llm import fingerprints as P
from inkspring.llm.common import table

SIGN = 2**63


def hash_of(*values):
    """Spark's xxhash64: each value's hash is the seed of the next."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v if isinstance(v, bytes) else (v % 2**64).to_bytes(8, "little"), seed)
    return seed - 2**64 if seed >= SIGN else seed


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    padded = [0] * 4 + [hash_of(w.encode()) for w in words]
    return {hash_of(*padded[i : i + 5]) for i in range(len(words))}


def print_of(text):
    every = sorted(shingles(text))
    limit = -SIGN + 2**64 // P.SCALE
    below = [h for h in every if h < limit]
    kept = below if len(below) >= P.FLOOR else every[: P.FLOOR]
    top = SIGN - 1 if len(kept) == len(every) else limit - 1 if len(below) >= P.FLOOR else kept[-1]
    return top, kept


def written(p):
    return f"{p[0] + SIGN:016x}:" + ",".join(f"{h + SIGN:016x}" for h in p[1])


def near(a, b):
    top = min(a[0], b[0])
    x, y = ({h for h in p[1] if h <= top} for p in (a, b))
    return len(x & y) / len(x | y) if x | y else float(not a[1] and not b[1])


def brute(rows):
    sign = lambda r: hash_of(r[1].encode()) & (SIGN - 1) if r[0] is None else hash_of(r[1].encode()) | -SIGN
    key = lambda r: (r[0] is None, r[0] or 0, sign(r))
    rows = [(i, t or "") for i, t in rows]
    order = sorted(set(rows), key=key)
    out = []
    for r in rows:
        i = order.index(r)
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        take = len(text) // 4
        edited = text[: len(text) - take] + after[:take]
        a, b, c = print_of(text), print_of(edited), print_of(after)
        out.append((r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), written(a), written(b), round(near(a, b), 9), round(near(a, c), 9)))
    return sorted(out, key=repr)


def check(spark, rows):
    got = P.digest(P.compare(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got), key=repr) == brute(rows)


def test_documents(spark, sf):
    check(spark, [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()])


def test_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(30_000))
    check(spark, [(5, None), (5, ""), (None, "a b c d e f g h"), (None, None), (-3, "x"), (9, long), (12, " \t\n"), (13, "É é 漢字 words 😀 and more of them"), (13, "É é 漢字 words 😀 and more of them"), (13, "another text of the same id"), (2**63 - 1, "last of all ids")])
    check(spark, [(1, "one two three four five six seven eight")])
    check(spark, [(1, "one two three four five six"), (1, "one two three four five six")])
    assert P.digest(P.compare(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_a_row_and_a_text_that_a_third_of_all_rows_hold(spark):
    check(spark, [(7, "the very same row again and again")] * 300 + [(1_000 + i, "the very same text in many rows") for i in range(300)] + [(5_000 + i, f"own text number {i} of this table") for i in range(300)])


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h", 1, 2, 3, 4, 5), (2, "i j k l m n o p", 1, 2, 3, 4, 5)], ["doc_id", "text", "n_chars", "fingerprint", "edited", "_doc", "_row"])
    got = P.digest(P.compare(df)).collect()
    assert sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got), key=repr) == brute([(1, "a b c d e f g h"), (2, "i j k l m n o p")])


def test_containment_of_unequal_texts_and_merging(spark):
    words = [f"w{i}" for i in range(20_000)]
    book, page, other = " ".join(words), " ".join(words[5_000:7_000]), " ".join(f"v{i}" for i in range(2_000))
    df = spark.createDataFrame([(book, page, other)], "a string, b string, c string").select(*[P.fingerprint(F.col(c)).alias(c) for c in "abc"])
    r = df.select(P.containment(F.col("b"), F.col("a")).alias("inside"), P.containment(F.col("c"), F.col("a")).alias("outside"), P.likeness(F.col("a"), F.col("b")).alias("like"), P.merged(F.col("b"), F.col("c")).alias("both"), "b", "c").first()
    assert r["inside"] > 0.98 and r["outside"] == 0 and abs(r["like"] - 0.1) < 0.03
    top, kept = print_of(page), print_of(other)
    assert list(r["both"]["hashes"]) == sorted({h for p in (top, kept) for h in p[1] if h <= min(top[0], kept[0])})


def test_estimates_are_near_the_whole_sets(spark, sf):
    rows = [r["text"] for r in table(spark, sf, "documents").select("text").collect() if r["text"] and len(r["text"].split()) > 400]
    df = spark.createDataFrame([(t, t[: len(t) * 3 // 4] + " other words at the end of it") for t in rows], "a string, b string")
    got = df.select("a", "b", P.likeness(P.fingerprint(F.col("a")), P.fingerprint(F.col("b"))).alias("x")).collect()
    errors = []
    for r in got:
        x, y = shingles(r["a"]), shingles(r["b"])
        errors.append(abs(r["x"] - len(x & y) / len(x | y)))
    assert len(errors) > 20 and sum(errors) / len(errors) < 0.06 and max(errors) < 0.25


def test_equal_texts_are_equal_and_edits_are_nearer_than_neighbours(spark, sf):
    got = P.digest(P.compare(table(spark, sf, "documents"))).join(table(spark, sf, "documents").select("doc_id", "text"), "doc_id").collect()
    prints = {}
    for r in got:
        assert prints.setdefault(r["text"], r["fingerprint"]) == r["fingerprint"]
    long = [r for r in got if r["n_chars"] >= 100]
    assert sum(r["near_edited"] > r["near_next"] for r in long) >= 0.97 * len(long)
