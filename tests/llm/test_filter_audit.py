"""Filter audit against plain counting over all orders."""

import re
from collections import Counter
from itertools import permutations

from inkspring.llm import filter_audit
from inkspring.llm.common import table

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    masks = []
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs):
            fails.add("E")
        masks.append((lang or "", fails, i))
    out, removals = [], Counter()
    for part in {p for p, _, _ in masks}:
        for order in permutations("ABCDE"):
            live = [(f, i) for p, f, i in masks if p == part]
            gone = []
            for step, letter in enumerate(order, 1):
                hit, redundant = [x for x in live if letter in x[0]], sum(letter in f for f, _ in gone)
                live = [x for x in live if letter not in x[0]]
                gone += hit
                removals[part, letter] += len(hit)
                unique = sum(f == {letter} for p, f, _ in masks if p == part)
                out.append((part, "".join(order), step, len(live), len(hit), redundant, unique, sum(i in good for _, i in hit), sum(i in toxic for _, i in hit)))
    return sorted((*r, removals[r[0], r[1][r[2] - 1]]) for r in out)


def check(spark, docs, labels):
    got = filter_audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(map(tuple, got)) == brute(docs, labels)


def test_documents(spark, sf):
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text", "lang").collect()]
    check(spark, docs, [tuple(r) for r in table(spark, sf, "labels").select("doc_id", "quality", "toxic").collect()])


def test_odd_rows(spark):
    words = " ".join(f"w{i}" for i in range(200))
    docs = [
        (1, None, None), (2, "", "en"), (3, "", ""), (None, "", "en"), (None, words, "en"), (None, words, "en"), (4, words, "en"), (4, words, "en"), (5, words, "de"), (5, "x", "de"),
        (6, "a " * 100_000 + "|", "en"), (7, "A" * 3 + "b" * 97, "en"), (8, "A" * 3 + "b" * 96, "en"), (9, "  ", "en"), (10, "\x0b\x0c\r\n\t ", "en"), (11, words + " é$", "en"),
    ]
    labels = [(4, 1, None), (4, 0, 1), (5, 1, 1), (99, 1, 1), (None, 1, 1), (8, None, 1), (2, 1, 0)]
    check(spark, docs, labels)
    check(spark, docs[:1], [])
    assert filter_audit.audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0


def test_a_text_and_a_row_that_a_third_of_all_rows_hold(spark):
    docs = [(i, "the same text", "en") for i in range(300)] + [(7_000, "one row", "de")] * 300 + [(1_000 + i, f"text {i}", "en") for i in range(300)]
    check(spark, docs, [(0, 1, 0), (5, 1, 1), (7_000, 0, 1)])


def test_clashing_columns(spark):
    names = ["doc_id", "text", "lang", "part", "mask", "key", "words", "n", "good", "first", "step"]
    df = spark.createDataFrame([(1, "a", "en", *range(8)), (2, "a", "en", *range(8))], names)
    got = filter_audit.audit(df, spark.createDataFrame([(1, 1, 0, 9)], "doc_id long, quality int, toxic int, good int")).collect()
    assert sorted(map(tuple, got)) == brute([(1, "a", "en"), (2, "a", "en")], [(1, 1, 0)])
