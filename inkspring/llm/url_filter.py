"""URL filters: explicit rules first, mined association rules for the rest.

Explicit rules name a host (with its subdomains) and a path prefix; the longest that fits decides. All other URLs are
judged by combinations of URL tokens that Spark's FP-growth finds in labelled URLs: rules ``tokens -> block`` with
enough support and confidence, without those that contain a shorter rule. Tokens in more than MAX_SHARE of the labelled
URLs are mined in a second pass, over what the first one leaves without a rule. In the labelled URLs hardly any token decides alone: a gambling word beside
``history`` is no casino, and an affiliate number or a prize page by itself no bait; pairs and triples of host, path and
query words are. The mined rules form an inverted index (every rule under its rarest token), so a URL looks up its own
tokens and compares only the rules found there. The index is broadcast, so its size is checked: more rules than
MAX_RULES are matched in slices, with the same result.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule, and is allowed unless mined
rules say otherwise; URLs of any length are read whole; repeated rows are answered alike; an empty table gives an empty
result; no labels mine no rules, so nothing is blocked but by explicit rules; labels that are null and URLs that are
null are left out of mining; equally long explicit rules: the larger text decides; extra columns are not read, whatever
their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, arrow_map, stored

#: (verdict, host and path prefix) of the contract.
RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
MIN_CONFIDENCE = 0.9
#: A mined rule holds in at least this share of the labelled URLs and at least so many of them.
MIN_SUPPORT, MIN_COUNT = 0.001, 5
#: Tokens of more than this share of the labelled URLs are mined only for what the others leave without a rule.
MAX_SHARE = 0.12
#: Most mined rules of one broadcast index (some 10 MB in a worker).
MAX_RULES = 50_000

# Words for the labelled URLs. Each topic with the words that make bait of it.
BAIT = {
    "casino": "win bonus free", "poker": "win live free", "bets": "free best win", "jackpot": "win bonus now", "lottery": "win buy now", "pills": "cheap buy best",
    "viagra": "cheap buy now", "pharma": "cheap best deals", "loan": "cheap now deals", "spam": "farm click best", "ads": "track click farm", "adult": "x hot live",
    "porn": "x hot free", "warez": "free best now", "phish": "farm click track", "crack": "free x now",
}
PRIZES, PARTNERS = "bonus offer deal prize promo".split(), "aff affid clickid subid".split()
GATES, JUMPS, AIMS = ["go", "out"], ["redirect", "jump"], ["url", "target"]
ORDINARY = "news blog shop docs wiki forum mail help support library school museum weather travel recipes garden music sports science health history city books photo art film open data code learn work home team club daily review guide".split()
NAMES = "river stone cloud maple north silver field lake harbor bridge summit valley meadow forest canyon cedar willow falcon otter raven".split()


def labelled_urls(spark: SparkSession, n: int = 12_000) -> DataFrame:
    """url, block (1 or 0): labelled URLs put together from the word lists.

    Bait is a topic with one of its words in the host; or a prize page with a partner number, on a host never seen
    before; or a gate, a jump and an aim. The other two thirds use the same words apart: a topic or a bait word beside
    an ordinary one, prize pages without partners, partner numbers on ordinary pages, two parts of three of a jump.
    """
    words = lambda ws: F.split(F.lit(" ".join(ws)), " ")
    draw = lambda j, m: F.pmod(F.xxhash64("id", F.lit(j)), F.lit(m)).cast("int")
    pick = lambda ws, j: F.get(words(ws), draw(j, len(ws)))
    pairs = [f"{t} {w}" for t, ws in BAIT.items() for w in ws.split()]
    pair = F.split(F.get(F.split(F.lit(",".join(pairs)), ","), draw(1, len(pairs))), " ")
    pair = F.when(draw(2, 2) == 0, pair).otherwise(F.reverse(pair))
    new = F.translate(F.substr(F.sha2(F.col("id").cast("string"), 256), F.lit(1), F.lit(10)), "0123456789", "ghijklmnop")
    bait = sorted({w for ws in BAIT.values() for w in ws.split()})
    number = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(100_000)).cast("string")
    page = F.concat(pick(["en", "de", "fr", "es"], 6), F.lit("/"), number, pick(["", "/", ".html", "#top", "?page=2&ref=x", "?utm_source=feed"], 8))
    query = lambda name: F.concat(F.lit("?"), name, F.lit("="), number)
    plain = F.concat_ws("-", pick(NAMES, 3), pick(ORDINARY, 4))
    kind = draw(5, 10)
    jump = lambda gate, how, aim: (F.concat_ws(".", gate, new), F.concat(how, query(aim)))
    bad = [
        (kind < 5, F.concat_ws("-", pair), page),
        (kind < 8, new, F.concat(pick(PRIZES, 9), query(pick(PARTNERS, 10)))),
        (kind < 10, *jump(pick(GATES, 11), pick(JUMPS, 12), pick(AIMS, 13))),
    ]
    good = [
        (kind < 3, F.concat_ws("-", pick([*BAIT], 14), pick(ORDINARY, 4)), page),
        (kind < 6, F.concat_ws("-", pick(bait, 15), pick(ORDINARY, 4)), page),
        (kind < 7, plain, page),
        (kind < 8, F.when(draw(16, 2) == 0, plain).otherwise(new), F.when(draw(17, 2) == 0, F.concat(pick(PRIZES, 9), F.lit("/"), number)).otherwise(F.concat(pick(ORDINARY, 18), query(pick(PARTNERS, 10))))),
        (kind < 9, *jump(pick(GATES, 11), pick(JUMPS, 12), pick(["page", "id"], 19))),
        (kind < 10, *jump(F.when(draw(20, 2) == 0, pick(GATES, 11)).otherwise(pick(["www", "m"], 21)), F.when(draw(20, 2) == 0, pick(ORDINARY, 18)).otherwise(pick(JUMPS, 12)), pick(AIMS, 13))),
    ]
    block = draw(0, 3) == 0

    def chosen(rows: list, part: int) -> Column:
        out = rows[-1][part]
        for row in rows[-2::-1]:
            out = F.when(row[0], row[part]).otherwise(out)
        return out

    host, path = (F.when(block, chosen(bad, i)).otherwise(chosen(good, i)) for i in (1, 2))
    front = F.concat(pick(["https://", "http://"], 22), pick(["", "www.", "m.", "blog."], 23))
    return spark.range(0, n, 1, 4).select(F.concat(front, host, pick([".example.com/", ".example.net/", ".example.org/"], 24), path).alias("url"), block.cast("int").alias("block"))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL: words of the host (h:), of the path (p:) and names of the query (q:)."""
    words = lambda c, tag: F.transform(F.filter(F.split(c, r"[^a-z0-9\x{80}-\x{10FFFF}]+"), lambda w: w != ""), lambda w: F.concat(F.lit(tag), w))
    low = F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER)
    query = F.regexp_extract(low, r"(?s)^[^?#]*\?([^#]*)", 1)
    return F.array_distinct(F.concat(words(host_of(url), "h:"), words(F.translate(path_of(url), UPPER, LOWER), "p:"), words(query, "q:")))


_MARK = "=block"


def _rules(rows: DataFrame, tokens: DataFrame, n: int, least: float, min_confidence: float) -> DataFrame:
    """Rules tokens -> block of ``rows(row, t, block)``, of all ``tokens``; support is a share of ``n``."""
    kept = rows.select("row", F.explode("t").alias("token")).join(tokens, "token").groupBy("row").agg(F.collect_list("token").alias("t"))
    items = rows.select("row", "block").join(kept, "row", "left").withColumn("t", F.coalesce("t", F.array().cast("array<string>")))
    baskets = items.select(F.when(F.col("block") > 0, F.array_append("t", F.lit(_MARK))).otherwise(F.col("t")).alias("items"))
    held = rows.count()
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, least * n / held), minConfidence=min_confidence).fit(baskets)
    return model.associationRules.where(F.array_contains("consequent", _MARK)).select(F.array_sort("antecedent").alias("tokens"), "confidence", (F.col("support") * held / n).alias("support"))


def mine(labelled: DataFrame, min_confidence: float = MIN_CONFIDENCE, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT, max_share: float = MAX_SHARE) -> DataFrame:
    """tokens, confidence, support: minimal token combinations that mean ``block`` in ``labelled(url, block)``.

    Tokens that nearly all URLs have would be in most combinations, so they are mined second: for the blocked URLs that
    no rule of the other tokens fits, with every token that is frequent in these, against all URLs that are not blocked.
    """
    rows = labelled.where("url is not null and block is not null").select(F.monotonically_increasing_id().alias("row"), tokens_of(F.col("url")).alias("t"), "block")
    rows = stored(rows)
    n = rows.count()
    if not n:
        return labelled.sparkSession.createDataFrame([], "tokens array<string>, confidence double, support double")
    least = min(1.0, max(min_support, min_count / n))
    often = lambda some: some.select(F.explode("t").alias("token")).groupBy("token").agg(F.count("*").alias("c")).where(F.col("c") >= least * n)
    told = often(rows)
    rules = stored(_rules(rows, told.where(F.col("c") <= max(max_share * n, min_count)).select("token"), n, least, min_confidence))
    # a URL is met by the rules that share their first token with it
    first = rules.select(F.get("tokens", F.lit(0)).alias("token"), "tokens")
    fits = rows.where("block > 0").select("row", "t", F.explode("t").alias("token")).join(first, "token").where(F.size(F.array_except("tokens", "t")) == 0).select("row").distinct()
    rest = stored(rows.where("block > 0").join(fits, "row", "left_anti"))
    common = stored(often(rest).select("token"))
    if not common.isEmpty():
        rules = stored(rules.unionByName(_rules(rest.unionByName(rows.where("block = 0")), common, n, least, min_confidence)).dropDuplicates(["tokens"]))
    # a rule that contains another one adds nothing: its parts are looked up, not all pairs of rules. They are no more than
    # the frequent combinations that FP-growth has listed already, as all parts of a frequent one are frequent
    rules = stored(rules.withColumn("id", F.concat_ws("\0", "tokens")))
    parts = rules.where("size(tokens) > 1").withColumn("mask", F.explode(F.expr("sequence(1L, shiftleft(1L, size(tokens)) - 2)")))
    parts = parts.select("id", F.expr("concat_ws('\\0', filter(tokens, (t, i) -> (shiftright(mask, i) & 1) = 1))").alias("sub"))
    covered = parts.join(rules.select(F.col("id").alias("sub")), "sub").select("id").distinct()
    return rules.join(covered, "id", "left_anti").drop("id")


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest explicit rule that fits; nulls if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule in sorted(rules, key=lambda r: (len(r[1]), r[1]), reverse=False):
        rule_host, slash, rule_path = rule.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(slash + rule_path))
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, said).otherwise(verdict)
    return text, verdict


def _slices(mined: DataFrame, max_rules: int) -> Iterator[list[tuple[str, ...]]]:
    """Mined rules in bounded slices; only one slice at a time comes to the driver."""
    n = max(1, -(-mined.count() // max_rules))
    for i in range(n):
        yield [tuple(r[0]) for r in mined.where(F.pmod(F.xxhash64("tokens"), F.lit(n)) == i).select("tokens").collect()]


_INDEX: dict = {}


def _index(shared, tag: str) -> dict[str, list[frozenset]]:
    """Inverted index: each rule under the token that the fewest rules have."""
    if tag not in _INDEX:
        _INDEX.clear()
        count: dict[str, int] = {}
        for rule in shared.value:
            for t in rule:
                count[t] = count.get(t, 0) + 1
        index: dict[str, list[frozenset]] = {}
        for rule in shared.value:
            index.setdefault(min(rule, key=lambda t: (count[t], t)), []).append(frozenset(rule))
        _INDEX[tag] = index
    return _INDEX[tag]


def judge(pages: DataFrame, mined: DataFrame, rules: list[tuple[str, str]] = RULES, max_rules: int = MAX_RULES) -> DataFrame:
    """Every row of ``pages(page_id, url)`` with host, path, rule, verdict and mined (whether a mined rule fits)."""
    rows = pages.select("page_id", "url", tokens_of(F.col("url")).alias("tokens"), F.lit(False).alias("mined"))
    schema = rows.schema
    for part in _slices(mined, max_rules):
        if not part:
            continue
        shared, tag = rows.sparkSession.sparkContext.broadcast(part), uuid.uuid4().hex

        def match(b: pa.RecordBatch, shared=shared, tag=tag) -> pa.RecordBatch:
            index = _index(shared, tag)
            hits = []
            for tokens, was in zip(b.column("tokens").to_pylist(), b.column("mined").to_pylist(), strict=True):
                own = set(tokens)
                hits.append(was or any(rule <= own for t in tokens for rule in index.get(t, ())))
            return pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), b.column("tokens"), pa.array(hits, pa.bool_())], ["page_id", "url", "tokens", "mined"])

        rows = arrow_map(rows, match, schema)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"), "mined")
    text, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    return rows.select("page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, F.when(F.col("mined"), "block").otherwise("allow")).alias("verdict"), "mined")
