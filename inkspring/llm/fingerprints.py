"""Document fingerprints with DataFrame functions only: every shingle hash below a fixed fraction of the hash range.

A text's shingles are the five words that end at each of its words (fewer at its start), words being runs of anything but
white space, in small letters. A fingerprint holds all distinct shingle hashes below ``1 / SCALE`` of the range, and the
``FLOOR`` smallest ones where those are fewer, with the limit up to which it is complete; a text of at most FLOOR distinct
shingles is held whole. Two fingerprints are compared below the smaller of their limits, where both are complete, so
the size of the texts does not matter: containment of a passage in a book is estimated from the same hashes as the likeness
of two pages, and the fingerprint of a union is made from fingerprints alone (``merged``).

``compare`` also fingerprints an edited version of each document, whose last quarter comes from the next document. The
order of documents is found on keys (ranges of ids, then the row after in each range, then the edges of the ranges);
texts are shuffled once, and only the piece that the neighbour needs is sent on.

Defined cases: a null text is an empty one; a text without words has an empty fingerprint, and two of these are alike
(1.0), one and any other text are not (0.0); texts of any length are read whole, in memory in proportion to their own
length; rows of one doc_id are ordered by a hash of their text, null ids come last; repeated rows (same id and text) are
one document and are answered alike, each of them; a single document is its own next one; an empty table gives an empty
result; extra columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, spread_join, stored

WIDTH = 5
#: One in SCALE of all hashes is retained, FLOOR of a text at least.
SCALE, FLOOR = 16, 64
_MIN, _MAX = -(2**63), 2**63 - 1


def fingerprint(text: Column, scale: int = SCALE, floor: int = FLOOR, width: int = WIDTH) -> Column:
    """struct(top, hashes): the ascending retained hashes, complete up to and including ``top``."""
    bare = F.btrim(F.lower(text), F.lit(BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    once = lambda value, make: F.get(F.transform(F.array(value), make), F.lit(0))  # noqa: E731  binds a value, so that it is computed once
    padded = F.concat(F.array_repeat(F.lit(0).cast("long"), width - 1), F.transform(words, lambda w: F.xxhash64(w)))
    shingles = once(padded, lambda p: F.transform(p, lambda _, i: F.when(i < F.size(p) - (width - 1), F.xxhash64(*[F.get(p, i + j) for j in range(width)]))))
    limit = F.lit(_MIN + 2**64 // scale)

    def retained(hashes: Column) -> Column:
        n = F.greatest(F.least(F.size(hashes), F.lit(floor)), F.size(F.filter(hashes, lambda h: h < limit)))
        return F.struct(F.when(n == F.size(hashes), F.lit(_MAX)).otherwise(F.greatest(limit - 1, F.get(hashes, n - 1))).alias("top"), F.slice(hashes, F.lit(1), n).alias("hashes"))

    return once(F.array_sort(F.array_distinct(F.array_compact(shingles))), retained)


def _shared(a: Column, b: Column, of: Column) -> Column:
    """The hashes of ``of`` below both limits."""
    top = F.least(a["top"], b["top"])
    return F.filter(of["hashes"], lambda h: h <= top)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of both that are in both, 0 to 1."""
    both = F.size(F.array_intersect(_shared(a, b, a), _shared(a, b, b)))
    union = F.size(_shared(a, b, a)) + F.size(_shared(a, b, b)) - both
    return F.when(union > 0, both / union).otherwise(F.when((F.size(a["hashes"]) == 0) & (F.size(b["hashes"]) == 0), 1.0).otherwise(0.0))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too; an empty ``a`` is contained in everything."""
    own = F.size(_shared(a, b, a))
    return F.when(own > 0, F.size(F.array_intersect(_shared(a, b, a), _shared(a, b, b))) / own).otherwise(F.when(F.size(a["hashes"]) == 0, 1.0).otherwise(0.0))


def merged(a: Column, b: Column) -> Column:
    """The fingerprint of all shingles of both."""
    top = F.least(a["top"], b["top"])
    return F.struct(top.alias("top"), F.array_sort(F.array_union(_shared(a, b, a), _shared(a, b, b))).alias("hashes"))


def written(f: Column) -> Column:
    """A fingerprint as text: top, then the hashes, as hexadecimal numbers in ascending order."""
    digits = lambda h: F.lpad(F.lower(F.hex(h.bitwiseXOR(F.lit(_MIN)))), 16, "0")  # noqa: E731  unsigned, as the order is
    return F.concat_ws(":", digits(f["top"]), F.array_join(F.transform(f["hashes"], digits), ","))


_KEY = ["_doc", "_h1", "_h2"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    none, h = F.col("doc_id").isNull(), F.xxhash64(text)
    # the sign of the first hash puts null ids after the largest id
    first = F.when(none, h.bitwiseAND(F.lit(_MAX))).otherwise(h.bitwiseOR(F.lit(_MIN)))
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(_MAX)).alias("_doc"), first.alias("_h1"), F.xxhash64(text, F.lit(1)).alias("_h2"), text.alias("text"))


def successors(keys: DataFrame) -> DataFrame:
    """``keys(_doc, _h1, _h2, ...)``, each key once, with ``next``: the key after it, the first one after the last."""
    key = F.struct(*_KEY)
    dealt = stored(keys.repartitionByRange(*_KEY).withColumn("_range", F.spark_partition_id()))
    # one row a range: as many as partitions
    order = Window.orderBy("_range")
    first = dealt.groupBy("_range").agg(F.min(key).alias("first"))
    edges = first.select("_range", F.coalesce(F.lead("first").over(order), F.first("first").over(order)).alias("edge"))
    inside = F.lead(key).over(Window.partitionBy("_range").orderBy(*_KEY))
    return dealt.withColumn("next", inside).join(edges, "_range").select(*keys.columns, F.coalesce("next", "edge").alias("next"))


def compare(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited (text), fingerprint, edited_fingerprint, next_fingerprint: a row for every row of ``docs``."""
    keyed = _keyed(docs)
    rows = stored(keyed.select("doc_id", *_KEY, F.char_length("text").cast("long").alias("n_chars")).withColumn("_row", F.monotonically_increasing_id()))
    groups = rows.groupBy(*_KEY).agg(F.max("doc_id").alias("doc_id"), F.max("n_chars").alias("n_chars"), F.count("*").alias("copies"))
    most = groups.agg(F.max("copies")).first()[0] or 0
    after = stored(successors(groups.select(*_KEY, "doc_id", "n_chars")))
    texts = keyed.select(*_KEY, "text")
    if most > 1:
        # repeated rows are one document from here on; min is pre-aggregated
        texts = texts.groupBy(*_KEY).agg(F.min("text").alias("text"))
    texts = texts.withColumn("fingerprint", fingerprint(F.col("text")))
    take = F.floor(F.col("n_chars") / 4).cast("int")
    wanted = after.select(*[F.col(f"next.{k}").alias(k) for k in _KEY], F.struct(*_KEY).alias("_to"), "doc_id", "n_chars", take.alias("_take"))
    sent = texts.join(wanted, _KEY).select(*[F.col(f"_to.{k}").alias(k) for k in _KEY], "doc_id", "n_chars", "_take", F.substr("text", F.lit(1), F.col("_take")).alias("_piece"), F.col("fingerprint").alias("next_fingerprint"))
    edited = F.concat(F.substr("text", F.lit(1), (F.col("n_chars") - F.col("_take")).cast("int")), "_piece")
    out = texts.join(sent, _KEY).withColumn("edited", edited).withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    if most > 1:
        out = spread_join(rows.select(*_KEY, "_row"), out, _KEY, "_row", most)
    return out.select("doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "next_fingerprint")


def digest(compared: DataFrame) -> DataFrame:
    own, edited, following = (F.col(c) for c in ("own", "other", "following"))
    named = compared.select("doc_id", "n_chars", "edited", F.col("fingerprint").alias("own"), F.col("edited_fingerprint").alias("other"), F.col("next_fingerprint").alias("following"))
    return named.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), written(own).alias("fingerprint"), written(edited).alias("edited_fingerprint"),
        likeness(own, edited).alias("near_edited"), likeness(own, following).alias("near_next"),
        containment(own, edited).alias("contained_in_edited"), containment(own, following).alias("contained_in_next"),
    )
