"""Source and sink operators as queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspring.functions import vectors as V
from inkspring.functions.text import NOISE_RULES
from inkspring.operators import checks
from inkspring.operators import pairs as P
from inkspring.registry import query, table
from inkspring.sources import files


@query("S2_source_manifest", oracle="SELECT page_id, url AS path, sha256(html) AS sha256 FROM pages")
def source_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"), F.sha2("html", 256).alias("sha256"))


@query("S4_import_utterances", oracle="SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS reading_order, text FROM conversations")
def import_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as arrays of records, exploded again in array order."""
    t = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("dialogues"))
    docs = t.select("conv_id", F.lit(None).cast("array<struct<turn:bigint,text:string>>").alias("utterances"), "dialogues")
    return files.utterances(docs, "conv_id").withColumn("reading_order", F.col("reading_order").cast("long"))


@query("S5_raw_document", oracle="SELECT conv_id || ':t' || turn AS id, role, length(text) AS n, CASE WHEN role = 'system' THEN 'unknown' WHEN turn = 0 THEN 'first' WHEN text = '' THEN 'empty' ELSE 'matched' END AS speaker_status FROM conversations")
def raw_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned per-page arrays zipped into text records with ids and a four-way status."""
    g = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("r"))
    arrays = g.select("conv_id", F.arrays_zip(F.transform("r", lambda x: x["turn"]).alias("turn"), F.transform("r", lambda x: x["role"]).alias("role"), F.transform("r", lambda x: x["text"]).alias("text")).alias("z"))
    rows = arrays.select("conv_id", F.inline("z"))
    status = F.when(F.col("role") == "system", "unknown").when(F.col("turn") == 0, "first").when(F.col("text") == "", "empty").otherwise("matched")
    return rows.select(F.concat("conv_id", F.lit(":t"), "turn").alias("id"), "role", F.char_length("text").cast("long").alias("n"), status.alias("speaker_status"))


@query("S9_known_names", oracle="SELECT lower(trim(name)) AS name, string_agg(DISTINCT id::VARCHAR, ',' ORDER BY id::VARCHAR) AS ids FROM (SELECT p_partkey AS id, p_name AS name FROM part WHERE p_size < 45 UNION ALL SELECT p_partkey, p_type FROM part WHERE p_size < 45) GROUP BY 1")
def known_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and aliases to ids, leaving disabled ones out."""
    p = table(spark, sf_dir, "part").where("p_size < 45").select(F.col("p_partkey").cast("string").alias("id"), F.explode(F.array_prepend(F.array("p_type"), F.col("p_name"))).alias("name"))
    return p.groupBy(F.lower(F.trim("name")).alias("name")).agg(F.array_join(F.array_sort(F.collect_set("id")), ",").alias("ids"))


@query("S10_glossary", oracle="SELECT lower(p_name) AS source, min(p_partkey) AS id, count(*) > 1 AS duplicate FROM part WHERE p_type <> 'SMALL' GROUP BY 1")
def glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed entries by folded source; a repeated source is an error row."""
    return table(spark, sf_dir, "part").where("p_type <> 'SMALL'").groupBy(F.lower("p_name").alias("source")).agg(F.min("p_partkey").alias("id"), (F.count("*") > 1).alias("duplicate"))


@query("S11_overrides", oracle="SELECT doc_id, 'unknown' AS problem FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars > 500)")
def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual rows for ids that do not exist."""
    d = table(spark, sf_dir, "documents").where("n_chars > 500").select("doc_id")
    return table(spark, sf_dir, "labels").select("doc_id").join(d, "doc_id", "left_anti").select("doc_id", F.lit("unknown").alias("problem"))


@query(
    "S12_rules",
    oracle="SELECT category, key FROM (VALUES " + ", ".join(f"('{c}', '{v}')" for c, vs in NOISE_RULES.items() for v in vs) + """) d(category, key)
    UNION SELECT 'keep', lower(r_name) FROM region UNION SELECT 'sfx', lower(n_name) FROM nation""",
)
def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default noise rules with supplied ones added: keep lists from one table, sounds from another, each key once."""
    keep = [r[0] for r in table(spark, sf_dir, "region").select("r_name").collect()]
    sounds = [r[0] for r in table(spark, sf_dir, "nation").select("n_name").collect()]
    return checks.noise_rules(spark, {"keep": keep, "sfx": sounds}).select("category", "key")


@query("S14_transcript", oracle="SELECT conv_id AS page, '--- Page ' || conv_id || ' ---' || chr(10) || string_agg('<' || role || '>: ' || text, chr(10) ORDER BY turn) AS value FROM conversations WHERE role <> 'system' GROUP BY 1")
def transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "conversations")
    return files.transcript(t.select(F.col("conv_id").alias("page"), F.col("turn").alias("ord"), F.col("role").alias("speaker"), "text", (F.col("role") != "system").alias("essential")))


@query("S15_distance_rows", oracle="WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings) SELECT a.label, a.vec_id AS a, b.vec_id AS b, round(1 - list_distance(a.v, b.v) ** 2 / 2, 4) AS cosine FROM e a JOIN e b ON a.label = b.label AND b.vec_id > a.vec_id AND b.vec_id < a.vec_id + 40")
def distance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form pair distances of an identity's neighbouring crops, as the CSV sink takes them."""
    e = table(spark, sf_dir, "embeddings").select("label", "vec_id", "embedding")
    b = e.select("label", F.col("vec_id").alias("b"), F.col("embedding").alias("w"))
    d = V.distance("embedding", "w")
    return e.withColumnRenamed("vec_id", "a").join(b, "label").where("b > a and b < a + 40").select("label", "a", "b", F.round(1 - d * d / 2, 4).alias("cosine"))


@query("S15_distance_histogram", oracle="WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), d AS (SELECT a.label, (round(list_distance(a.v, b.v) * 100000)::BIGINT // 1000) / 100 AS distance FROM e a JOIN e b ON a.label = b.label AND a.vec_id < b.vec_id) SELECT label, distance, count(*) AS pairs, round(1 - distance * distance / 2, 4) AS cosine FROM d GROUP BY 1, 2")
def distance_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pair distances of an identity's crops, counted in hundredths (rounded down): pairs of blocks, no row a pair."""
    step = F.expr("cast(round(d * 100000) as long) div 1000") / 100
    d = P.spread(table(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", 1.2).groupBy("label", step.alias("distance")).agg(F.sum("n").alias("pairs"))
    return d.select("label", "distance", "pairs", F.round(1 - F.col("distance") * F.col("distance") / 2, 4).alias("cosine"))


@query("S20_transcript_pages", oracle="SELECT conv_id AS doc, ((turn + 2) // 2)::INT AS page, turn AS pos, role AS line FROM conversations WHERE turn % 2 = 0")
def transcript_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd pages of a transcript, renumbered; every turn is a page of one line here."""
    t = table(spark, sf_dir, "conversations")
    lines = t.select(F.col("conv_id").alias("doc"), "turn", F.explode(F.array(F.struct((F.col("turn") * 2).alias("pos"), F.format_string("--- Page %d ---", F.col("turn") + 1).alias("line")), F.struct((F.col("turn") * 2 + 1).alias("pos"), F.col("role").alias("line")))).alias("x"))
    out = files.pages_of_transcript(lines.select("doc", "x.pos", "x.line"))
    return out.select("doc", "page", F.expr("pos div 2").alias("pos"), "line")
