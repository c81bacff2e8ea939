"""Anchors, contexts, speakers, receipts and bank edits over the star-schema tables.

Orders are utterances, their lines text boxes; suppliers are characters seen on pages (two a character of a page), their
nation the person; customers are clusters of people, their orders sightings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspring.operators import anchors as A
from inkspring.registry import query, table


def _associations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(suppliers with page and character, text-tail and text-character associations, pages)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal", F.expr("s_suppkey div 4").alias("page"), (F.col("s_suppkey") % 2).cast("int").alias("character"))
    pages = s.select("page").distinct()
    lines = pages.withColumn("text_index", F.explode(F.sequence(F.lit(1), F.lit(7))))
    tails = lines.where((F.col("page") + F.col("text_index")) % 4 != 0).withColumn("tail_index", F.col("text_index") % 3)
    characters = lines.withColumn("character", F.explode(F.array(F.lit(0), F.lit(1)))).where((F.col("page") + F.col("text_index") + F.col("character")) % 5 != 0)
    return s, tails, characters, pages.select("page", F.lit(2).alias("n_tails"), F.lit(2).alias("n_characters"))


_SIDES = """s AS (SELECT s_suppkey, s_nationkey, s_acctbal, s_suppkey // 4 AS page, s_suppkey % 2 AS character FROM supplier), pg AS (SELECT DISTINCT page FROM s),
l AS (SELECT l_orderkey, l_linenumber, min(l_suppkey) AS k FROM lineitem GROUP BY 1, 2), t AS (SELECT *, k // 4 AS page, l_linenumber % 3 AS tail, k % 2 AS character FROM l)"""


@query("J9_anchor_route", oracle=f"""WITH {_SIDES}, m AS (SELECT o_orderkey, s.s_nationkey AS person, o_orderpriority <> '1-URGENT' AND (t.page + l_linenumber) % 4 <> 0 AND (t.page + l_linenumber + t.character) % 5 <> 0 AND tail < 2 AND k = s.s_suppkey AND NOT s.s_acctbal < 0 AS good
  FROM orders JOIN t ON l_orderkey = o_orderkey JOIN s ON s.page = t.page AND s.character = t.character),
g AS (SELECT o_orderkey, count(*) AS originals, count(*) FILTER (good) AS anchors, count(DISTINCT CASE WHEN good THEN person END) AS n, min(CASE WHEN good THEN person END) AS low FROM m GROUP BY 1), u AS (SELECT DISTINCT l_orderkey AS o_orderkey FROM l)
SELECT o_orderkey AS utterance, coalesce(originals, 0) AS originals, coalesce(anchors, 0) AS anchors, coalesce(n, 0) = 1 AS locked, CASE WHEN n = 1 THEN low END AS person, CASE WHEN n > 1 THEN n ELSE 0 END AS conflicting FROM u LEFT JOIN g USING (o_orderkey)""")
def anchor_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utterances locked to one person by their own texts, or in conflict: associations, tails and the bank have a say."""
    s, tails, characters, pages = _associations(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("k"))
    text = F.concat_ws(":", "l_orderkey", "l_linenumber")
    texts = lines.select(text.alias("text"), F.expr("k div 4").alias("page"), F.col("l_linenumber").cast("int").alias("text_index"), (F.col("l_linenumber") % 3).cast("int").alias("tail_index"), (F.col("k") % 2).cast("int").alias("character"), F.col("k").alias("bank_id"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderpriority") == "1-URGENT").alias("caption"))
    sources = lines.join(orders, "l_orderkey").select(F.col("l_orderkey").alias("utterance"), text.alias("text"), "caption")
    seen = s.select("page", "character", F.col("s_suppkey").alias("cluster"), F.col("s_suppkey").alias("bank_id"))
    people = s.select(F.col("s_suppkey").alias("cluster"), F.col("s_nationkey").alias("person"))
    bank = s.select(F.col("s_suppkey").alias("bank_id"), (F.col("s_acctbal") < 0).alias("disabled"))
    return A.route(sources, texts, seen, people, tails, characters, pages, bank).withColumn("conflicting", F.size("conflicting").cast("long"))


@query("J10_tails_of_rows", oracle=f"WITH {_SIDES} SELECT l_orderkey AS row, tail::INT AS tail_index, string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber) AS sources, tail < 2 AS known FROM t JOIN pg USING (page) WHERE (page + l_linenumber) % 4 <> 0 GROUP BY 1, 2, 4")
def tails_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tails that the boxes of an utterance are linked with; those that their page has not are not known."""
    _, tails, _, pages = _associations(spark, sf_dir)
    boxes = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("k"))
    boxes = boxes.select(F.col("l_orderkey").alias("row"), F.expr("k div 4").alias("page"), F.col("l_linenumber").alias("ord"), F.col("l_linenumber").cast("string").alias("source"), F.col("l_linenumber").cast("int").alias("text_index"))
    return A.tail_evidence(boxes, tails, pages).withColumn("sources", F.array_join("sources", ","))


@query("J12_person_context", oracle="""WITH c AS (SELECT c_custkey, c_custkey // 3 AS person, c_mktsegment = 'BUILDING' AS current FROM customer), o AS (SELECT o_custkey, o_orderkey % 100 AS page, nullif(o_orderkey % 9, 0) AS bank FROM orders),
h AS (SELECT person, string_agg(DISTINCT c_custkey::VARCHAR, ',' ORDER BY c_custkey::VARCHAR) AS clusters FROM c WHERE current AND c_custkey IN (SELECT o_custkey FROM o WHERE page < 30) GROUP BY 1),
b AS (SELECT person, string_agg(DISTINCT bank::VARCHAR, ',' ORDER BY bank::VARCHAR) AS bank_ids FROM c JOIN o ON o_custkey = c_custkey WHERE bank IS NOT NULL GROUP BY 1), p AS (SELECT DISTINCT person, CASE WHEN person % 4 = 0 THEN 'p' || person END AS name FROM c)
SELECT person, name, coalesce(clusters, '') AS clusters, coalesce(bank_ids, '') AS bank_ids FROM p LEFT JOIN h USING (person) LEFT JOIN b USING (person) WHERE name IS NOT NULL OR clusters IS NOT NULL OR bank_ids IS NOT NULL""")
def person_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People who may be met on the first thirty pages, with their clusters there and all their bank ids."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("cluster"), F.expr("c_custkey div 3").alias("person"), (F.col("c_mktsegment") == "BUILDING").alias("current"))
    seen = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("cluster"), (F.col("o_orderkey") % 100).alias("page"), F.nullif(F.col("o_orderkey") % 9, F.lit(0)).alias("bank_id"))
    people = c.select("person").distinct().withColumn("name", F.when(F.col("person") % 4 == 0, F.concat(F.lit("p"), F.col("person").cast("string"))))
    pages = seen.select("page").where("page < 30").distinct()
    return A.person_context(c, seen, people, pages).select("person", "name", F.array_join("clusters", ",").alias("clusters"), F.array_join("bank_ids", ",").alias("bank_ids"))


@query("U13_speakers", oracle="""SELECT event_id, event_type AS person, CASE WHEN NOT (event_type <> 'error' AND user_id % 3 = 0 AND user_id % 2 = 0 AND event_type <> 'click') AND user_id % 3 = 0 THEN 'c' || user_id END AS cluster,
CASE WHEN event_type <> 'error' THEN concat_ws(',', CASE WHEN value > 10 AND event_type <> 'view' THEN 'source_anchor_disagrees' END, CASE WHEN event_id % 11 = 0 THEN 'source_anchors_disagree' END, CASE WHEN user_id % 3 = 0 AND user_id % 2 = 0 AND event_type <> 'click' THEN 'cluster_reference_disagrees' END) ELSE '' END AS conflicts FROM events""")
def speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred speakers with the sources that disagree; clusters of even users belong to 'click'."""
    e = table(spark, sf_dir, "events")
    cluster = F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("c"), F.col("user_id").cast("string")))
    owners = e.where("user_id % 2 = 0").select(F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("cluster"), F.lit("click").alias("owner")).distinct()
    two = F.when(F.col("event_id") % 11 == 0, F.array(F.lit("x"), F.lit("y"))).otherwise(F.array().cast("array<string>"))
    rows = e.withColumn("cluster", cluster).join(owners, "cluster", "left")
    s = A.resolved_speaker(F.col("event_type") != "error", F.col("event_type"), F.col("cluster"), F.when(F.col("value") > 10, "view"), two, F.col("owner"))
    return rows.select("event_id", s.alias("s")).select("event_id", "s.person", "s.cluster", F.array_join("s.conflicts", ",").alias("conflicts"))


@query("P30_identity_view", oracle="""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN 'i' || o_custkey // 2 ELSE 'c' || o_custkey END AS speaker, CASE WHEN o_orderstatus <> 'P' THEN 'i' || o_orderkey % 5 ELSE 'c' || o_orderkey % 5 END AS addressee,
CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 2 = 0 THEN 'i' || o_custkey % 3 ELSE 't' || o_custkey % 3 END AS mention FROM orders""")
def identity_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the current policy seen through identities: speaker, addressees and mentions that have one."""
    name = lambda tag, x: F.concat(F.lit(tag), F.expr(x).cast("string"))
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", "old").otherwise("now").alias("policy"), name("c", "o_custkey").alias("speaker"), name("i", "o_custkey div 2").alias("speaker_identity"),
        F.array(name("c", "o_orderkey % 5")).alias("addressees"), F.array(name("i", "o_orderkey % 5")).alias("addressee_identities"), F.array(F.struct(F.lit("m").alias("candidate"), name("t", "o_custkey % 3").alias("target"))).alias("mentions"),
        F.when(F.col("o_orderkey") % 2 == 0, F.create_map(F.lit("m"), name("i", "o_custkey % 3"))).otherwise(F.create_map().cast("map<string,string>")).alias("mention_identities"),
    )
    return A.identity_view(rows, "now").select("o_orderkey", "speaker", F.get("addressees", F.lit(0)).alias("addressee"), F.get("mentions", F.lit(0))["target"].alias("mention"))


@query("F18_checked_receipts", oracle="""WITH RECURSIVE p AS (SELECT p_partkey AS step, CASE WHEN p_partkey % 101 = 0 THEN 'missing' WHEN p_partkey % 97 = 0 THEN 'changed' WHEN p_partkey % 89 = 0 THEN 'dependencies' END AS own FROM part),
d AS (SELECT a.step, b.step AS needs FROM p a JOIN p b ON b.step = a.step // 4), bad(step) AS (SELECT step FROM p WHERE own IS NOT NULL UNION SELECT d.step FROM bad JOIN d ON d.needs = bad.step)
SELECT step, coalesce(own, CASE WHEN step IN (SELECT step FROM bad) THEN 'ancestor' END) AS issue FROM p""")
def checked_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts of steps against what is there now, with all they were made from; a part needs the one of a quarter of its number."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("step"), "p_name")
    hashed = lambda c: F.sha2(c, 256)
    receipts = p.select("step", hashed("p_name").alias("artifact_hash"), hashed(F.col("step").cast("string")).alias("input_hash"))
    every = lambda n: F.col("step") % n == 0
    now = p.where(~every(101)).select("step", hashed(F.when(every(97), F.concat("p_name", F.lit(" "))).otherwise(F.col("p_name"))).alias("artifact_hash"), hashed(F.when(every(89), "x").otherwise(F.col("step").cast("string"))).alias("input_hash"))
    needs = p.select("step", F.expr("step div 4").alias("needs")).join(p.select(F.col("step").alias("needs")), "needs", "left_semi")
    return A.checked(receipts, now, needs)


@query("U16_bank_edits", oracle="""WITH b AS (SELECT label AS character, count(*) AS vectors FROM embeddings WHERE label IS NOT NULL GROUP BY 1), e AS (SELECT vec_id AS seq, label AS character, vec_id % 3 AS k, vec_id // 7 AS i FROM embeddings WHERE vec_id % 7 = 0 AND label IS NOT NULL),
g AS (SELECT e.character, seq, CASE WHEN k = 1 THEN i * 2 END AS one, CASE WHEN k = 2 THEN i END AS crop FROM e JOIN b USING (character) WHERE k = 0 OR k = 1 AND i * 2 < vectors OR k = 2 AND i < (vectors + 1) // 2),
d AS (SELECT character, one AS p FROM g WHERE one IS NOT NULL UNION SELECT g.character, 2 * crop + j FROM g JOIN b USING (character), range(2) r(j) WHERE crop IS NOT NULL AND 2 * crop + j < vectors)
SELECT character, (SELECT 'name ' || max(seq) FROM e WHERE e.character = b.character AND k = 0) AS name, (SELECT count(*) FROM d WHERE d.character = b.character) AS prototypes, (SELECT count(DISTINCT crop) FROM g WHERE g.character = b.character) AS crops,
(SELECT count(*) FROM e WHERE e.character = b.character) - (SELECT count(*) FROM g WHERE g.character = b.character) AS refused FROM b""")
def bank_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bank after a log of edits: names, disabled prototypes and crops (two prototypes a crop), and what was refused."""
    e = table(spark, sf_dir, "embeddings").where("label is not null")
    sized = e.groupBy(F.col("label").alias("character")).agg(F.count("*").cast("int").alias("vectors"))
    crop = lambda i: F.concat(F.lit("crop "), i.cast("string"))
    bank = sized.withColumn("name", F.lit(None).cast("string")).withColumn("crops", F.transform(F.sequence(F.lit(0), F.expr("(vectors - 1) div 2").cast("int")), crop)).withColumn("prototype_crops", F.transform(F.sequence(F.lit(0), F.col("vectors") - 1), lambda i: crop(F.floor(i / 2))))
    kind, i = F.col("vec_id") % 3, F.expr("vec_id div 7").cast("int")
    edits = e.where("vec_id % 7 = 0").select(F.col("label").alias("character"), F.col("vec_id").alias("seq"), F.when(kind == 0, "rename").when(kind == 1, "disable_prototype").otherwise("disable_crop").alias("kind"), F.when(kind == 1, i * 2).otherwise(i).alias("index"), F.concat(F.lit(" name "), F.col("vec_id").cast("string")).alias("name"))
    done, refused = A.edited(bank, edits)
    lost = refused.groupBy("character").agg(F.count("*").alias("refused"))
    return done.join(lost, "character", "left").select("character", "name", F.size("disabled_prototypes").cast("long").alias("prototypes"), F.size("disabled_crops").cast("long").alias("crops"), F.coalesce("refused", F.lit(0)).alias("refused"))


@query("U17_promoted", oracle="""WITH n AS (SELECT max(s_suppkey) AS last FROM supplier), c AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS k FROM customer WHERE c_acctbal > 9000)
SELECT s_suppkey AS id, 'bank' AS place, 0 AS appearances FROM supplier UNION ALL SELECT last + k, 'bank', (SELECT count(DISTINCT o_orderdate) FROM orders WHERE o_custkey = c_custkey) FROM c, n
UNION ALL SELECT c_custkey, 'pending', (SELECT count(DISTINCT o_orderdate) FROM orders WHERE o_custkey = c_custkey) FROM customer WHERE NOT c_acctbal > 9000""")
def promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of high balance become characters after the suppliers, with their appearances; the others stay pending."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pending"), "c_acctbal")
    days = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("pending")).agg(F.collect_set(F.col("o_orderdate").cast("string")).alias("keys"))
    none = F.array().cast("array<string>")
    pending = c.join(days, "pending", "left").select("pending", F.col("pending").alias("seq"), F.coalesce("keys", none).alias("keys"))
    bank = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("character"), none.alias("appearance_keys"), F.lit(0).cast("long").alias("appearances"))
    after, left = A.promoted(bank, pending, c.where("c_acctbal > 9000").select("pending"))
    return after.select(F.col("character").alias("id"), F.lit("bank").alias("place"), "appearances").unionByName(left.select(F.col("pending").alias("id"), F.lit("pending").alias("place"), F.size("keys").cast("long").alias("appearances")))
