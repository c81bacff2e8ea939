"""URL filter: explicit rules against a plain loop, mined rules on held-out labels."""

import re

import pytest
from pyspark.sql import functions as F

from inkspring.llm import url_filter as u
from inkspring.llm.common import table


@pytest.fixture(scope="module")
def mined(spark):
    return u.mine(u.labelled_urls(spark)).cache()


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for verdict, rule in u.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def check(spark, rows, mined):
    got = u.judge(spark.createDataFrame(rows, "page_id long, url string, host string"), mined).collect()
    assert len(got) == len(rows)
    want = {i: brute(x) for i, x, _ in rows}
    for r in got:
        host, path, rule, verdict = want[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["mined"] else "allow"))
    return {r["page_id"]: r for r in got}


def test_pages(spark, sf, mined):
    got = check(spark, [(*r, "x") for r in table(spark, sf, "pages").select("page_id", "url").collect()], mined)
    for r in got.values():
        if r["rule"] is None:
            assert (r["verdict"] == "block") == bool(re.search("casino|bets|pills|ads-|spam|adult", r["host"])), r


def test_odd_rows(spark, mined):
    rows = [
        (1, None), (2, ""), (3, "no scheme/en/"), (4, "HTTP://WWW.Example.COM/en/7?x#y"), (5, "x://com/en/"), (6, "x://com"), (7, "x://a.example.net/de/81#t"), (8, "x://?q"), (9, "x://h#://com/en/"),
        (10, "a://b://com/en/"), (11, "x://telecom/en/1"), (12, "x://ÄB.org/es/\n1"), (13, "https://free-casino.example.org/en/" + "a" * 100_000), (14, "x://com/EN/"), (15, "x://a.org/es/"), (15, "x://a.org/es/"),
    ]
    got = check(spark, [(*r, None) for r in rows], mined)
    assert got[13]["verdict"] == "block" and got[1]["verdict"] == "allow"
    assert u.judge(spark.createDataFrame([], "page_id long, url string"), mined).count() == 0


def test_held_out_labels(spark):
    rows = u.labelled_urls(spark, 6_000).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(2)))
    mined = u.mine(rows.where("fold = 0"))
    held = rows.where("fold = 1").select(F.monotonically_increasing_id().alias("page_id"), "url", "block").toPandas()
    got = u.judge(spark.createDataFrame(held[["page_id", "url"]]), mined, rules=[]).toPandas().merge(held, on="page_id")
    right = (got["verdict"] == "block") == (got["block"] == 1)
    assert right.mean() > 0.97


def test_mined_rules_are_minimal_and_slices_agree(spark, mined, sf):
    rules = [frozenset(r["tokens"]) for r in mined.collect()]
    assert rules and not any(a < b for a in rules for b in rules)
    pages = table(spark, sf, "pages")
    a = sorted((r["page_id"], r["verdict"]) for r in u.judge(pages, mined).collect())
    assert a == sorted((r["page_id"], r["verdict"]) for r in u.judge(pages, mined, max_rules=7).collect())


def test_no_labels(spark):
    assert u.mine(spark.createDataFrame([], "url string, block int")).count() == 0
    assert u.mine(spark.createDataFrame([(None, 1), ("x://y", None)], "url string, block int")).count() == 0


def test_pairs_and_triples_decide(spark, mined):
    """No single token is a rule; without the pairs or the triples held-out bait gets through, hosts never seen included."""
    rules = [tuple(r["tokens"]) for r in mined.collect()]
    assert {len(r) for r in rules} == {2, 3}
    old = u.labelled_urls(spark).select("url")
    held = u.labelled_urls(spark, 20_000).join(old, "url", "left_anti").select(F.monotonically_increasing_id().alias("page_id"), "url", "block").toPandas()

    def rates(some):
        frame = spark.createDataFrame([(list(r),) for r in some], "tokens array<string>")
        got = u.judge(spark.createDataFrame(held[["page_id", "url"]]), frame, rules=[]).toPandas().merge(held, on="page_id")
        hit, bad = got["verdict"] == "block", got["block"] == 1
        return (hit & bad).sum() / max(1, hit.sum()), (hit & bad).sum() / bad.sum()

    precision, recall = rates(rules)
    assert precision > 0.99 and recall > 0.97
    assert rates([r for r in rules if len(r) == 2])[1] < 0.9 and rates([r for r in rules if len(r) == 3])[1] < 0.5
    # one token of each pair alone blocks much that is ordinary
    assert rates([(t,) for r in rules for t in r])[0] < 0.8


def test_words_by_themselves_are_allowed(spark, mined):
    rows = [(i, f"https://{h}.example.org/en/1{t}", None) for i, (h, t) in enumerate([("farm", ""), ("school-click", ""), ("casino-history", ""), ("win-win", ""), ("shop", "?aff=3"), ("river-news", "/bonus/7")])]
    got = check(spark, rows, mined)
    assert {r["verdict"] for r in got.values()} == {"allow"}
    rows = [(1, "http://xk2.example.org/prize?affid=9", None), (2, "http://go.anything.example.com/redirect?target=7", None), (3, "http://go.anything.example.com/redirect?id=7", None)]
    assert [r["verdict"] for _, r in sorted(check(spark, rows, mined).items())] == ["block", "block", "allow"]


def test_minimal_rules_against_all_combinations(spark):
    from itertools import combinations

    urls = [("x://a.b/c", 1), ("x://a.b/d", 1), ("x://a/c", 0), ("x://b/c", 0), ("x://c.d.e/", 1), ("x://c.d/", 0), ("x://d.e/", 0), ("x://c.e/", 0), ("x://f/", 1), ("x://f.a/", 1)] * 3
    frame = spark.createDataFrame(urls, "url string, block int")
    got = {tuple(r["tokens"]) for r in u.mine(frame, 0.9, 0.0, 3, 1.0).collect()}
    baskets = [(frozenset(r["t"]), b) for r, (_, b) in zip(frame.select(u.tokens_of(F.col("url")).alias("t")).collect(), urls, strict=True)]
    every = sorted({t for s, _ in baskets for t in s})
    want: set = set()
    for n in range(1, 5):
        for c in combinations(every, n):
            bad = [b for s, b in baskets if set(c) <= s]
            if sum(bad) >= 3 and sum(bad) >= 0.9 * len(bad) and not any(set(w) < set(c) for w in want):
                want.add(c)
    assert got == want


def test_clashing_columns(spark, mined):
    df = spark.createDataFrame([(1, "https://free-casino.example.org/x", "h", "p", 5, "t")] * 2, "page_id long, url string, host string, path string, mined int, tokens string")
    assert [(r["host"], r["path"], r["verdict"]) for r in u.judge(df, mined).collect()] == [("free-casino.example.org", "/x", "block")] * 2


def test_a_bait_word_in_a_third_of_all_labels_is_mined(spark):
    """Common tokens that decide give a rule, common ones that do not give none, and rare pairs stay as they are."""
    rows = [(f"http://evil{'' if i % 2 else '.shop'}.example.com/page/{i}", 1) for i in range(200)]
    rows += [(f"http://good.example.com/page/{i}", 0) for i in range(300)] + [(f"http://rare-pair.example.com/page/{i}", 1) for i in range(20)]
    rows += [(f"http://rare.example.com/page/{i}", 0) for i in range(30)] + [(f"http://pair.example.com/page/{i}", 0) for i in range(30)]
    from inkspring.llm import url_filter

    mined = {tuple(r["tokens"]): (round(r["confidence"], 6), round(r["support"], 4)) for r in url_filter.mine(spark.createDataFrame(rows, "url string, block int")).collect()}
    n = len(rows)
    assert mined[("h:evil",)] == (1.0, round(200 / n, 4)) and mined[("h:pair", "h:rare")] == (1.0, round(20 / n, 4))
    assert not any(set(t) <= {"h:example", "h:com", "p:page"} for t in mined)
    assert all(len(t) == 1 or not any(set(s) < set(t) for s in mined) for t in mined)
