"""Secret scan with DataFrame functions only: rule spans, plus strings that look random.

Rule spans are regular expressions (assignments, access keys, long hex runs). The method adds to them: two character
Markov models, one trained on labelled random strings and one on labelled ordinary identifiers, score every long
unbroken run of key characters; a run is a secret if its mean log-likelihood ratio per character pair is at least
``MIN_RATIO``. Links, embedded base64 data and UUIDs look random but are no secrets: they are passed over (rule spans
in them stay), but for the password before a link's host and the values of parameters named after credentials. The models are pair counts (an aggregate, at most a few thousand rows), so the driver holds a table of
fixed size; scanning has no shuffle and each text is handled whole, where it lies.

Defined cases: a null text is an empty one and has no spans, an empty table gives an empty result; texts and runs of any
length are read whole, in memory in proportion to their own length; repeated rows are answered alike; runs that touch a
rule span are not repeated; spans that start together are ordered by kind; a ratio equal to the limit is a secret; an
empty sample table gives equal models, so nothing is added; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
MIN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"

#: Characters of the models; others share class 0. A run is scored if it has at least MIN_RUN of them.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-="
MIN_RUN = 20
# Names of link parameters that hold credentials.
CREDENTIALS = "key|token|secret|sig|signature|auth|password|passwd|pass|pwd|credential|access_token|access_key|api_key|apikey|client_secret|refresh_token"
#: What is passed over, without a verdict: links, embedded data, UUIDs. Of a link, what comes after ``user:`` before the host
#: and after a credential's name is read on. Group 1 is a run to be scored.
RUN = (
    rf"(?<![A-Za-z])[A-Za-z]{{2,12}}://(?:[^\s<>\"'/?#@:]*:(?=[^\s<>\"'/?#@]*@)|[^\s<>\"']*?[?&#;](?i:{CREDENTIALS})=|[^\s<>\"']+)"
    r"|base64,[A-Za-z0-9+/=]+|(?<![0-9A-Za-z-])[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}(?![0-9A-Za-z-])"
    # names are looked back for only where an equals sign stands before
    + "|(?:(?<![A-Za-z0-9+/_=-])|(?<==)(?:" + "|".join(f"(?<=(?i:{name})=)" for name in CREDENTIALS.split("|")) + rf"))([A-Za-z0-9+/_=-]{{{MIN_RUN},}})"
)
#: Least mean log-likelihood ratio (nats per pair) of a secret.
MIN_RATIO = 0.5

# Parts of ordinary identifiers, for the labelled samples.
PARTS = (
    "get set is has add remove update delete create build make load save read write open close start stop run init find search sort "
    "filter map reduce count index value key name type size length width height color text title body header footer page user account "
    "order item product price total amount date time year month day hour minute second file path folder image video audio content "
    "message error warning status result response request handler manager service factory provider controller model view table column "
    "row cell field form button label input output stream buffer queue stack list array string number object class method function "
    "module package version config option setting default custom local global public private static final abstract interface event "
    "listener callback thread process task job worker client server network socket connection session cache memory storage database "
    "query parameter argument variable constant local parent child node tree graph edge vertex point line shape layer group element "
    "the and that with this from have about which their would there international understanding nicht aber oder werden durch zwischen "
    "pour dans avec plus cette entre comme sobre entre desde cuando porque general information development organization"
).split()


def labelled_samples(spark: SparkSession, n: int = 3_000) -> DataFrame:
    """text, random (1 or 0): strings drawn by hashing, and identifiers, paths and numbers put together from PARTS."""
    parts = F.split(F.lit(" ".join(PARTS)), " ")
    pick = lambda j: F.get(parts, F.pmod(F.xxhash64("id", F.lit(j)), F.lit(len(PARTS))).cast("int"))
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 512)
    base64 = F.base64(F.unhex(digest))
    length = F.lit(20) + F.pmod(F.xxhash64("id"), F.lit(24)).cast("int")
    cut = lambda c: F.substr(c, F.lit(1), length)
    number = F.regexp_replace(digest, "[^0-9]", "")
    rows = spark.range(0, n, 1, 4)
    made = {
        1: [cut(digest), cut(base64), cut(F.translate(base64, "+/=", "-_")), cut(F.upper(digest)), cut(F.regexp_replace(base64, "[^A-Za-z0-9]", "")), cut(F.regexp_replace(F.upper(base64), "[^A-Z0-9]", ""))],
        0: [
            F.concat(pick(1), F.initcap(pick(2)), F.initcap(pick(3)), F.initcap(pick(4))), F.concat_ws("_", pick(1), pick(2), pick(3), pick(4)), F.upper(F.concat_ws("_", pick(1), pick(2), pick(3))),
            F.concat_ws("-", pick(1), pick(2), pick(3), pick(4)), F.concat_ws("/", pick(1), pick(2), pick(3), F.substr(number, F.lit(1), F.lit(4))), F.concat(pick(1), pick(2), pick(3), pick(4)), F.upper(F.concat(pick(1), pick(2), pick(3), pick(4))),
            F.substr(number, F.lit(1), F.lit(24)), F.concat_ws("/", *[F.concat_ws("-", *[F.substr(number, F.lit(k + a), F.lit(m)) for a, m in ((0, 4), (4, 2), (6, 2))]) for k in (1, 9, 17)]), F.concat(F.repeat(F.lit("-"), 12), pick(1), F.repeat(F.lit("="), 12), pick(2), F.repeat(F.lit("_"), 12)), F.repeat(F.substr(F.lit(ALPHABET), F.pmod(F.xxhash64("id", F.lit(9)), F.lit(len(ALPHABET))).cast("int") + 1, F.lit(1)), length),
        ],
    }
    each = F.array(*[F.struct(x.alias("text"), F.lit(label).alias("random")) for label, xs in made.items() for x in xs])
    return rows.select(F.explode(each).alias("s")).select("s.text", "s.random")


def train(samples: DataFrame, smoothing: float = 1.0) -> list[float]:
    """log P(b | a, random) - log P(b | a, ordinary) for every pair of classes, at a * n + b.

    ``samples(text, random)``: rows of null text or label are left out. Pair counts are aggregated on the executors.
    """
    n = len(ALPHABET) + 1
    rows = samples.where("text is not null and random is not null and char_length(text) > 1").select((F.col("random") > 0).cast("int").alias("random"), F.transform(F.split("text", ""), _class).alias("k"))
    pairs = rows.select("random", F.explode(F.transform(F.sequence(F.lit(1), F.size("k") - 1), lambda i: F.get("k", i - 1) * n + F.get("k", i))).alias("pair"))
    counts: list[dict] = [{}, {}]
    for r in pairs.groupBy("random", "pair").count().collect():
        counts[r["random"]][r["pair"]] = r["count"]
    out = []
    for a in range(n):
        totals = [sum(c.get(a * n + b, 0) for b in range(n)) + smoothing * n for c in counts]
        for b in range(n):
            p = [(c.get(a * n + b, 0) + smoothing) / t for c, t in zip(counts, totals, strict=True)]
            out.append(round(math.log(p[1] / p[0]), 4))
    return out


def _class(x: Column) -> Column:
    return F.instr(F.lit(ALPHABET), x)


def ratio(c: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio per character pair of a string (0 for less than two characters)."""
    n = len(ALPHABET) + 1
    scores = F.split(F.lit(",".join(map(str, table))), ",").cast("array<double>")
    total = lambda k: F.aggregate(F.sequence(F.lit(1), F.size(k) - 1), F.lit(0.0), lambda s, i: s + F.get(scores, F.get(k, i - 1) * n + F.get(k, i)))
    return F.when(F.char_length(c) < 2, 0.0).otherwise(_let(F.transform(F.split(c, ""), _class), lambda k: total(k) / (F.size(k) - 1)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_STEP = 64
_SPANS = "array<struct<start:int,end:int>>"


def spans(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None, group: int = 0) -> Column:
    """Code-point spans (end exclusive) of the leftmost non-overlapping matches whose ``group`` satisfies ``keep``.

    Positions are running sums of the lengths between and of the matches, summed by runs of _STEP so that a text with
    very many matches costs no square of them.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = hits if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    good = F.transform(groups, lambda g: keep(g) if keep else F.lit(True))
    sized = F.zip_with(F.split(text, pattern, -1), F.zip_with(hits, good, lambda h, g: F.struct(F.char_length(h).alias("n"), g.alias("ok"))), lambda gap, h: F.struct(F.char_length(gap).alias("gap"), F.coalesce(h["n"], F.lit(0)).alias("n"), F.coalesce(h["ok"], F.lit(False)).alias("ok")))

    def placed(rows: Column) -> Column:
        part = lambda c: F.slice(rows, c * _STEP + 1, F.lit(_STEP))
        runs = F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / _STEP).cast("int"))
        sums = F.transform(runs, lambda c: F.aggregate(part(c), F.lit(0), lambda s, x: s + x["gap"] + x["n"]))

        def one(totals: Column, c: Column) -> Column:
            base = F.aggregate(F.slice(totals, F.lit(1), c), F.lit(0), lambda s, x: s + x)
            empty = F.struct(base.alias("at"), F.array().cast(_SPANS).alias("out"))

            def step(s: Column, x: Column) -> Column:
                a = s["at"] + x["gap"]
                b = a + x["n"]
                out = F.when(x["ok"], F.concat(s["out"], F.array(F.struct(a.alias("start"), b.alias("end"))))).otherwise(s["out"])
                return F.struct(b.alias("at"), out.alias("out"))

            return F.aggregate(part(c), empty, step, lambda s: s["out"])

        return _let(sums, lambda totals: F.flatten(F.transform(runs, lambda c: one(totals, c))))

    return F.when(F.rlike(text, F.lit(pattern)), _let(sized, placed)).otherwise(F.array().cast(_SPANS))


def find_secrets(docs: DataFrame, table: list[float], min_ratio: float = MIN_RATIO) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` with assign, access, hex and random: arrays of spans.

    ``random`` has the runs that the Markov models hold for random and that no rule span touches.
    """
    t = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        spans(t, ASSIGN, lambda v: F.char_length(v) >= MIN_VALUE, 2).alias("assign"),
        spans(t, ACCESS).alias("access"),
        spans(t, HEX).alias("hex"),
        spans(t, RUN, lambda v: ratio(v, table) >= min_ratio, 1).alias("random"),
    )
    rule = F.concat("assign", "access", "hex")
    free = F.filter("random", lambda r: ~F.exists(rule, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return rows.withColumn("random", F.when((F.size("random") > 0) & (F.size(rule) > 0), free).otherwise(F.col("random")))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the digest of the rule spans and all spans as text, ordered by start, then kind."""
    kinds = ["assign", "access", "hex", "random"]

    def tagged(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(kinds.index(kind)).alias("order"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    def joined(names: list[str]) -> Column:
        each = F.array_sort(F.concat(*map(tagged, names)))
        return F.array_join(F.transform(each, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in kinds[:3]],
        F.sha2(joined(kinds[:3]), 256).alias("base_sha256"),
        joined(kinds).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )
