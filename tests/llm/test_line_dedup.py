"""Line dedup against a plain loop, and texts put together again."""

import hashlib
import re
from collections import defaultdict

from inkspring.llm import line_dedup
from inkspring.llm.common import table


def brute(rows):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 10 and len(holders[key(x)]) > 1 and min(holders[key(x)]) != i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in line_dedup.digest(line_dedup.dedup_lines(df)).collect()) == brute(rows)


def test_documents(spark, sf):
    check(spark, [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()])


def test_odd_rows(spark):
    long = "a line of some length"
    check(spark, [(1, None), (2, ""), (3, long), (4, f" {long.upper()}\r\n{long}\n\nx"), (5, "\n"), (6, f"{long}\n{long}"), (6, f"{long}\n{long}"), (7, "ééééééééé\n" + "é" * 10), (8, "É" * 10 + "\n" + "é" * 10), (9, "x" * 200_000 + "\nx")])


def test_threshold_and_empty(spark):
    df = spark.createDataFrame([(i, "a line of some length\nown" + str(i)) for i in range(3)], "doc_id long, text string")
    assert [r["n_dropped"] for r in line_dedup.dedup_lines(df, min_docs=3).orderBy("doc_id").collect()] == [0, 1, 1]
    assert [r["n_dropped"] for r in line_dedup.dedup_lines(df, min_docs=4).collect()] == [0, 0, 0]
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_a_line_found_everywhere_and_clashing_columns(spark):
    line = "the very same line in all of them"
    check(spark, [(i, f"{line}\nown line number {i}\n{line if i % 3 else 'x'}") for i in range(900)])
    df = spark.createDataFrame([(i, f"{line}\nx", "t", 1, 2, 3) for i in (1, 2)], "doc_id long, text string, _text string, _doc int, pos int, keeper int")
    assert sorted((r["doc_id"], r["n_dropped"], r["text"]) for r in line_dedup.dedup_lines(df).collect()) == [(1, 0, f"{line}\nx"), (2, 1, "x")]
