"""Banks of vectors, written from the embeddings and loaded again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspring.registry import query, table
from inkspring.sources import bank, shared

#: Vectors of one bank; every third bank has older settings, every seventh is of another model.
PER_BANK = 64


@query("S8_bank_load", oracle=f"""WITH e AS (SELECT vec_id // {PER_BANK} AS b, coalesce(label::VARCHAR, 'none') AS character, vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
a AS (SELECT b, character, count(*) AS vectors, max(len(embedding)) AS width, round(sum(embedding[1]::DOUBLE), 5) AS first FROM e GROUP BY 1, 2)
SELECT 'story ' || b AS story, CASE WHEN b % 7 <> 6 THEN character END AS character, CASE WHEN b % 7 <> 6 THEN vectors END AS vectors, CASE WHEN b % 7 <> 6 THEN width END AS width, CASE WHEN b % 7 <> 6 THEN first END AS first,
b % 3 = 0 AS upgraded, CASE WHEN b % 7 = 6 THEN 'model' END AS issue FROM a GROUP BY ALL""")
def bank_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of every bank and character; banks of another model give their issue instead."""
    e = table(spark, sf_dir, "embeddings").where("vec_id is not null and embedding is not null")
    k = F.floor(F.col("vec_id") / PER_BANK).cast("long")
    e = e.select(k.alias("b"), F.concat(F.lit("story "), k.cast("string")).alias("story"), F.coalesce(F.col("label").cast("string"), F.lit("none")).alias("character"), F.col("vec_id").alias("ord"), F.col("embedding").alias("vector"))
    config = F.create_map(*[x for key, v in bank.EXPECTED.items() for x in (F.lit(key), F.when((F.col("b") % 3 == 0) & F.lit(key.startswith("max")), "4").otherwise(str(v)))])
    doc = F.to_json(F.struct(F.lit(bank.VERSION).alias("schema_version"), F.col("story").alias("story_name"), F.when(F.col("b") % 7 == 6, "other").otherwise("this").alias("model_fingerprint"), config.alias("config")))
    path = shared.fresh(spark, "banks")
    bank.save(e.select("story", "character", "ord", "vector"), e.select("story", "b").distinct().select("story", doc.alias("json")), path)
    banks, vectors = bank.load(spark, path, "this")
    held = vectors.groupBy("story", "character").agg(F.count("*").alias("vectors"), F.max(F.size("vector")).cast("long").alias("width"), F.round(F.sum(F.get("vector", F.lit(0)).cast("double")), 5).alias("first"))
    return banks.select("story", "upgraded", "issue").join(held, "story", "left").select("story", "character", "vectors", "width", "first", "upgraded", "issue")
