"""Line dedup with DataFrame functions only.

Lines are exploded once with their position, normalised and hashed to 128 bits, and kept as a table of hashes. Each hash
gets its smallest and largest document (a pre-aggregated min and max, so a line found everywhere costs one row a task). A
hash of two documents or more loses its lines outside the smallest one. The lines meet the few repeated hashes by salt,
so a line found everywhere is dealt over many tasks. What is to drop comes back per document as positions, and the text
is put together again from the slices between them, in time linear in the lines.

Defined cases: a null or empty text is one empty line, an empty table gives an empty result; texts and lines of any
length are handled whole, in memory in proportion to their own length; a null doc_id counts as one document after all
others; repeated document rows are one document and are answered alike; keys under ``min_chars`` code points always
stay; the smallest doc_id keeps a line, all its repeats included; extra columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, forget, spread_join, stored

MIN_CHARS = 10
MIN_DOCS = 2

def duplicate_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """_doc, _text, _drop: sorted positions of the lines to drop, for documents that lose any."""
    key = ascii_lower(F.btrim("line", F.lit(BLANKS)))
    lines = (
        docs.select(
            F.coalesce("doc_id", F.lit(2**63 - 1)).alias("_doc"),
            F.xxhash64("text").alias("_text"),
            F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"),
        )
        .where(F.char_length("line") >= min_chars)
        .select("_doc", "_text", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("_doc", "_text", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key", F.lit(2)).alias("h2"))
    )
    lines = stored(lines)
    if min_docs <= 2:
        often = lines.groupBy("h1", "h2").agg(F.min("_doc").alias("keeper"), F.max("_doc").alias("last"), F.count("*").alias("lines")).where("keeper < last")
    else:
        pairs = lines.groupBy("h1", "h2", "_doc").agg(F.count("*").alias("n"))
        often = pairs.groupBy("h1", "h2").agg(F.min("_doc").alias("keeper"), F.sum("n").alias("lines"), F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    often = stored(often.select("h1", "h2", "keeper", "lines"))
    most, n = often.agg(F.max("lines"), F.count("*")).first()
    met = spread_join(lines, often.select("h1", "h2", "keeper"), ["h1", "h2"], "_doc", most or 0, n)
    drops = stored(met.where("_doc > keeper").groupBy("_doc", "_text").agg(F.sort_array(F.collect_set("pos")).alias("_drop")))
    forget(lines, often)
    return drops


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` with n_lines, n_dropped and the text that is kept."""
    rows = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("_doc"), F.xxhash64("text").alias("_text"))
    drops = duplicate_lines(docs, min_chars, min_docs)
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    # the lambda binds the split text once; the kept lines are the slices between the dropped ones
    kept = F.expr(r"""
        transform(array(split(text, '\n', -1)), lines ->
          transform(array(concat(array(-1), _drop, array(size(lines)))), b ->
            array_join(flatten(transform(sequence(1, size(b) - 1), i ->
              slice(lines, b[i - 1] + 2, b[i] - b[i - 1] - 1))), '\n'))[0])[0]""")
    out = rows.join(drops, ["_doc", "_text"], "left")
    return out.select(
        "doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_drop").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("text"),
    )


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), d AS (
  SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
)
SELECT k.doc_id, count(*) AS n_lines,
       sum(CASE WHEN d.keeper < k.doc_id THEN 1 ELSE 0 END)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE d.keeper IS NULL OR d.keeper >= k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN d USING (key)
GROUP BY k.doc_id
"""
