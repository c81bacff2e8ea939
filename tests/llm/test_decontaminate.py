"""Benchmark decontamination against a plain search, in one slice and in several."""

import hashlib
import re

from inkspring.llm import decontaminate as d
from inkspring.llm.common import table


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, window=10):
    wins = {}
    for k, t in items:
        w = words(t)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            wins.setdefault(tuple(w[i : i + m]), set()).add(str(k))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for m in {len(x) for x in wins}:
            for j in range(len(w) - m + 1):
                if ks := wins.get(tuple(w[j : j + m])):
                    hit |= set(range(j, j + m))
                    found |= ks
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def check(spark, docs, items, **k):
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(tuple(r) for r in d.report(d.scan_documents(a, b, **k)).collect()) == brute(docs, items)


def test_documents_in_one_and_more_slices(spark, sf):
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
    check(spark, docs, items)
    check(spark, docs, items, max_words=3000)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(25))
    items = [(1, long), (2, "Short one"), (3, ""), (4, None), (5, "short ONE!"), (6, "w1 " * 12), (7, " ".join(f"w{i}" for i in range(5, 16)))]
    docs = [(1, None), (2, ""), (3, "a short, one b"), (4, long.upper()), (5, " ".join(f"w{i}" for i in range(3, 13))), (6, "w1 " * 30), (7, "w3 w4 short"), (8, "short one short one"), (9, "é " * 50_000 + long)]
    check(spark, docs, items)
    check(spark, docs, items, max_words=20)
    check(spark, docs, [])


def test_removal_cuts_spans_and_drops_covered_documents(spark):
    item = " ".join(f"q{i}" for i in range(12))
    docs = [(1, f"{'A Before, ' * 20}{item.upper()}{' After B.' * 20}", "x", 0), (2, item, "x", 0), (3, "clean text", "x", 9), (4, None, None, None)]
    a = spark.createDataFrame(docs, "doc_id long, text string, source string, n_chars long")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: r for r in d.remove_contaminated(a, b).collect()}
    assert set(got) == {1, 3, 4} and got[1]["text"] == "A Before, " * 20 + " After B." * 20 and got[1]["n_chars"] == len(got[1]["text"])
    assert got[3]["text"] == "clean text" and got[3]["n_chars"] == 9
    assert d.report(d.scan_documents(spark.createDataFrame(list(got.values()), a.schema), b)).where("contaminated").count() == 0


def test_removal_is_the_same_in_slices(spark):
    # item texts of 30 words; hash of the ids deals them into slices
    texts = {i: " ".join(f"i{i}w{j}" for j in range(30)) for i in range(8)}
    fill = lambda n: " ".join(f"f{j}" for j in range(n))
    docs = [(0, "clean words, only", "x", 3), (1, None, "x", None), (2, "", "x", 0)]
    for a in texts:
        for b in texts:
            if a != b:
                # 30 of 100 words by each of two items; and a cut span of one joins a window of the other
                docs.append((100 + 10 * a + b, f"{texts[a]} {fill(20)} {texts[b]} {fill(20)}", "x", 1))
                half = texts[b].split()
                docs.append((300 + 10 * a + b, f"{fill(40)} {' '.join(half[:8])} {texts[a]} {' '.join(half[8:16])} {fill(40)}", "x", 1))
    docs += docs[-2:]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, n_chars long")
    bench = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    assert len(d.slices(bench, 60)) > 1
    # coverage is of the words a text had at first: 24 of 50 and then 10 more
    inner = texts[1].split()
    late = f"{fill(8)} {' '.join(inner[:5])} {' '.join(texts[0].split()[:24])} {' '.join(inner[5:10])} {fill(8)}"
    assert d.remove_contaminated(spark.createDataFrame([(1, late, "x", 1)], frame.schema), bench).count() == 0
    rows = lambda **k: sorted(map(repr, d.remove_contaminated(frame, bench, **k).collect()))
    one, many = rows(), rows(max_words=60)
    assert one == many and len(one) == 3 + 56 + 1
    left = spark.createDataFrame(d.remove_contaminated(frame, bench, max_words=60).collect(), frame.schema)
    assert d.report(d.scan_documents(left, bench)).where("contaminated").count() == 0


def test_two_items_around_clean_words(spark):
    # each item covers a third: together more than half
    a, b = (" ".join(f"{x}{j}" for j in range(12)) for x in "ab")
    docs = spark.createDataFrame([(1, f"{a} {' '.join(f'c{j}' for j in range(12))} {b}"), (2, "clean"), (3, None), (2, "clean"), (4, f"{a} {' '.join(f'c{j}' for j in range(40))} {b}")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, a), (2, b), (3, "z1 z2 z3 z4 z5 z6"), (4, None), (2, b)], "item_id long, text string")
    rows = lambda **k: sorted(map(repr, d.remove_contaminated(docs, bench, **k).collect()))
    one = rows()
    assert len(one) == 4 and one == rows(max_words=12) == rows(max_words=100) == rows(max_words=10**6)


def test_clashing_columns(spark):
    item = " ".join(f"q{i}" for i in range(12))
    cols = "doc_id long, text string, _k1 string, _spans int, items string, spans string, n_words string, _n int, _gone string, `a.b` int"
    docs = spark.createDataFrame([(1, f"{'w ' * 20}{item}", "k", 1, "i", "s", "n", 2, "g", 3), (2, None, "k", 1, "i", "s", "n", 2, "g", 3)], cols)
    bench = spark.createDataFrame([(1, item, 5), (2, "other words", 6)], "item_id long, text string, k int")
    for m in (5, 10**6):
        got = d.remove_contaminated(docs, bench, max_words=m)
        assert got.columns == docs.columns and {tuple(r)[2:] for r in got.collect()} == {("k", 1, "i", "s", "n", 2, "g", 3)}
        assert sorted(tuple(r)[:3] for r in d.scan_documents(docs, bench, max_words=m).select("doc_id", "n_words", "items").collect()) == [(1, 32, ["1"]), (2, 0, [])]
