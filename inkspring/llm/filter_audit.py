"""Filter interaction audit: what every order of five quality filters keeps and removes, from a histogram of masks.

Four filters are native expressions over a text and give four bits of a failure mask; the fifth bit says that a smaller
doc_id has the same text. For it texts are grouped by their SHA-256, which gives the smallest doc_id of each (a
pre-aggregated min, so a text with any number of copies costs one row a task). Rows become counts of (part, mask), at
most 32 cells a part; all 120 orders of the filters are enumerated from these cells alone. Texts are read once and never
shuffled: what moves is a row of some 60 bytes a document.

Defined cases: a null text is an empty one (and equal to it); a null or empty lang is the part ''; an empty table gives no
rows; texts of any length are read whole; each row counts by itself, so repeated rows all count, and rows of the smallest
doc_id with a text all pass the copy filter; a null doc_id is neither smaller nor larger than others, so such rows pass
it, and no label belongs to them; of several labels of one doc_id any 1 counts; labels of unknown documents and null
labels count nothing; ratios equal to a limit pass; extra columns are not read, whatever their names.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, forget, stored

MIN_WORDS = 200
#: Least share of distinct words, largest share of capitals, both in percent.
MIN_DISTINCT, MAX_CAPITALS = 50, 3
SYMBOLS = "[#$%&*|]"
#: The filters in the order of their bits; the last one is the copy filter.
LETTERS = "ABCDE"


def text_filters(text: Column, words: Column) -> list[Column]:
    """Failure conditions of the filters on one text, in the order of their bits; ``words`` is the array of its words."""
    count, chars = F.size(words), F.char_length(text)
    capitals = chars - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    return [count < MIN_WORDS, 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * count, 100 * capitals > MAX_CAPITALS * chars, F.rlike(text, F.lit(SYMBOLS))]


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, key (of the text), mask (without the bit of the copy filter): one row a document, no shuffle."""
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    bare = F.btrim("text", F.lit(BLANKS))
    rows = rows.withColumn("words", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+")))
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_filters(F.col("text"), F.col("words")))]
    return rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("key"), sum(bits[1:], bits[0]).alias("mask"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: the histogram of failure masks, with the labelled documents of each cell."""
    rows = stored(failures(docs))
    least = rows.where("doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    # repeated rows are counted before they meet anything, so that no (key, doc_id) is frequent
    counted = rows.where("doc_id is not null").groupBy("doc_id", "key", "part", "mask").agg(F.count("*").alias("n"))
    whole = counted.join(least, ["key", "doc_id"], "left").withColumn("mask", F.col("mask") + F.when(F.col("first"), 0).otherwise(1 << (len(LETTERS) - 1)))
    # at most a row for each part and mask of a doc_id meets its labels
    whole = whole.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    marked = whole.join(marks, "doc_id", "left").select("part", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    loose = rows.where("doc_id is null").select("part", "mask", F.lit(1).cast("long").alias("n"), F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    total = lambda c: F.sum(F.col("n") * F.col(c)).alias(c)
    out = stored(marked.unionByName(loose).groupBy("part", "mask").agg(F.sum("n").alias("n"), total("good"), total("toxic")))
    forget(rows)
    return out


def orders(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """The effect of every filter at its place in every order, per part; ``cells(part, mask, n, good, toxic)``."""
    every = F.split(F.lit(",".join(map("".join, permutations(letters)))), ",")
    # a part has at most 2 ** len(letters) cells
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    steps = parts.select("part", "cells", F.explode(every).alias("filter_order")).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    bit = f"shiftleft(1, instr('{letters}', %s) - 1)"
    before = f"aggregate(slice(split(filter_order, ''), 1, step - 1), 0, (s, f) -> s | {bit % 'f'})"
    steps = steps.select("*", F.expr(bit % "substr(filter_order, step, 1)").alias("bit"), F.expr(before).alias("before"))
    fails, clear = "c.mask & bit <> 0", "c.mask & before = 0"
    total = lambda when, what="c.n": F.expr(f"aggregate(cells, 0L, (s, c) -> s + if({when}, {what}, 0L))")
    return steps.select(
        "part", "filter_order", "step",
        total(f"{clear} AND NOT {fails}").alias("kept"),
        total(f"{clear} AND {fails}").alias("removed"),
        total(f"{fails} AND NOT {clear}").alias("redundant"),
        total("c.mask = bit").alias("unique_fails"),
        total(f"{clear} AND {fails}", "c.good").alias("good_lost"),
        total(f"{clear} AND {fails}", "c.toxic").alias("toxic_lost"),
        # in all orders each failing filter of a cell is first equally often
        total(fails, f"c.n * ({factorial(len(letters))} div bit_count(c.mask))").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    return orders(cells(docs, labels))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), m AS (
  SELECT doc_id, part,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask
  FROM (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM t)
), k AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1
), d AS (
  SELECT part, mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM m LEFT JOIN k USING (doc_id)
), f AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(l, b)
), o AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31
), s AS (
  SELECT filter_order, step::INT AS step, bits[step] AS bit, list_sum([0] || bits[1:step - 1])::INT AS before
  FROM o, range(1, 6) AS r(step)
), x AS (
  SELECT part, filter_order, step, bit,
         count(*) FILTER (mask & (before | bit) = 0) AS kept,
         count(*) FILTER (mask & before = 0 AND mask & bit <> 0) AS removed,
         count(*) FILTER (mask & before <> 0 AND mask & bit <> 0) AS redundant,
         count(*) FILTER (mask = bit) AS unique_fails,
         count(*) FILTER (mask & before = 0 AND mask & bit <> 0 AND good = 1) AS good_lost,
         count(*) FILTER (mask & before = 0 AND mask & bit <> 0 AND toxic = 1) AS toxic_lost
  FROM d, s GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM x
"""
