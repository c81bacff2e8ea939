"""Identity registration, providers and nested records as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkspring.operators import graph as G
from inkspring.operators import identity as I
from inkspring.operators import providers as P
from inkspring.operators import sequences as Q
from inkspring.registry import query, table


@query("U1_union_all", oracle="SELECT conv_id AS page, turn AS ord, 'utterance' AS kind FROM conversations UNION ALL SELECT user_id, event_id, 'effect' FROM events WHERE event_type = 'click'")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("page"), F.col("turn").alias("ord"), F.lit("utterance").alias("kind"))
    return a.unionByName(table(spark, sf_dir, "events").where("event_type = 'click'").select(F.col("user_id").alias("page"), F.col("event_id").alias("ord"), F.lit("effect").alias("kind")))


@query("U10_apply_links")
def apply_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between clusters in order of their events; ids five apart (of every fourth id) may not be one person."""
    e = table(spark, sf_dir, "events")
    links = e.where("event_type = 'signup' and value > 45").select(F.col("event_id").alias("ord"), F.col("user_id").alias("cluster"), (F.col("user_id") + 1 + F.col("event_id") % 3).alias("person"))
    ids = links.select(F.col("cluster").alias("a")).unionByName(links.select(F.col("person").alias("a"))).distinct().where("a % 4 = 0")
    return I.applied_links(links, ids.withColumn("b", F.col("a") + 5))


@query("U12_merge_in_order", oracle="SELECT conv_id, turn, coalesce(CASE WHEN turn % 2 = 0 THEN 'done' END, CASE WHEN length(text) > 500 THEN 'failed' END, 'open') AS state FROM conversations")
def merge_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed and failed rows merged back in source order."""
    t = table(spark, sf_dir, "conversations")
    done = t.where("turn % 2 = 0").select("conv_id", "turn", F.lit("done").alias("d"))
    failed = t.where(F.char_length("text") > 500).select("conv_id", "turn", F.lit("failed").alias("f"))
    return t.select("conv_id", "turn").join(done, ["conv_id", "turn"], "left").join(failed, ["conv_id", "turn"], "left").select("conv_id", "turn", F.coalesce("d", "f", F.lit("open")).alias("state"))


@query("U15_merge_characters", oracle="WITH b AS (SELECT c_custkey AS id, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1), m AS (SELECT id, CASE WHEN id % 10 = 7 THEN id - 1 ELSE id END AS into_id, n FROM b), t AS (SELECT into_id, sum(n)::BIGINT AS n FROM m GROUP BY 1) SELECT m.id, m.into_id AS \"into\", coalesce(t.n, 0) AS n, m.id <> m.into_id AS disabled FROM m LEFT JOIN t ON t.into_id = m.id")
def merge_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"))
    bank = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")).join(n, "id", "left").fillna(0, ["n"])
    return I.merged(bank, bank.where("id % 10 = 7").select("id", (F.col("id") - 1).alias("into")))


@query("E_postprocessor_chain", oracle="WITH g AS (SELECT user_id AS key, min(event_id) AS lo, max(event_id) AS hi, count(*) AS n FROM events WHERE value > 20 GROUP BY 1) SELECT key, CASE WHEN n = 1 THEN lo WHEN key % 2 = 0 THEN hi END AS choice, (CASE WHEN n = 1 THEN 0 WHEN key % 2 = 0 THEN 1 END)::BIGINT AS decided_by FROM g")
def postprocessor_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ambiguous matches through a chain: a single candidate, then the last one for even keys, else undecided."""
    g = table(spark, sf_dir, "events").where("value > 20").groupBy(F.col("user_id").alias("key")).agg(F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("id")))).alias("candidates"))
    only = lambda m: m["candidates"][0]["id"] if len(m["candidates"]) == 1 else None
    last = lambda m: m["candidates"][-1]["id"] if m["key"] % 2 == 0 else None
    return I.resolved_by(g, [only, last])


@query("C5_provider_calls", oracle="SELECT event_id AS key, sha256('fixed' || chr(0) || props) AS request_hash, substring(sha256(props), 1, 12) AS answer FROM events")
def provider_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests answered by a provider, equal ones once."""
    return P.answered(table(spark, sf_dir, "events").select(F.col("event_id").alias("key"), F.col("props").alias("request")), P.Fixed())


@query(
    "C11_fit_request",
    oracle="""WITH t AS (SELECT conv_id, turn, length(text) AS cost, CASE WHEN turn = max(turn) OVER (PARTITION BY conv_id) THEN 'target' WHEN turn % 3 = 0 THEN 'context' ELSE 'support' END AS kind FROM conversations),
    s AS (SELECT *, coalesce(sum(cost) FILTER (kind = 'target') OVER (PARTITION BY conv_id), 0) AS ts, coalesce(sum(cost) FILTER (kind = 'context') OVER (PARTITION BY conv_id), 0) AS cs, coalesce(sum(cost) FILTER (kind = 'support') OVER (PARTITION BY conv_id ORDER BY turn DESC), 0) AS newer FROM t)
    SELECT conv_id, turn, kind, CASE kind WHEN 'support' THEN newer + ts + cs <= 1500 WHEN 'context' THEN ts + cs <= 1500 ELSE TRUE END AS kept, ts <= 1500 AS fits FROM s""",
)
def fit_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last turn as target: the oldest support goes first, then the context."""
    last = F.col("turn") == F.max("turn").over(W.partitionBy("conv_id"))
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.char_length("text").alias("cost"), F.when(last, "target").when(F.col("turn") % 3 == 0, "context").otherwise("support").alias("kind"))
    return Q.fitted(t, "conv_id", "turn", "kind", "cost", 1500).select("conv_id", "turn", "kind", "kept", "fits")


@query(
    "C12_recovery_tree",
    oracle="""WITH RECURSIVE t AS (SELECT conv_id, turn, length(text) AS cost, '' AS node FROM conversations), r AS (SELECT *, 0 AS depth FROM t UNION ALL
      SELECT conv_id, turn, cost, node || CASE WHEN k < n // 2 THEN ':split:0' ELSE ':split:1' END, depth + 1 FROM (SELECT *, count(*) OVER (PARTITION BY conv_id, node, depth) AS n, sum(cost) OVER (PARTITION BY conv_id, node, depth) AS s, row_number() OVER (PARTITION BY conv_id, node, depth ORDER BY turn) - 1 AS k FROM r) WHERE s > 900 AND n > 1)
    SELECT conv_id, turn, arg_max(node, depth) AS node FROM r GROUP BY 1, 2""",
)
def recovery_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests above a budget halved until they fit or are one turn."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.char_length("text").alias("cost"))
    return G.halved(t, "conv_id", "turn", "cost", 900).select("conv_id", "turn", "node")


@query("C14_cache_key", oracle="SELECT event_id, sha256('v1' || chr(31) || props || chr(31) || sha256(event_type) || chr(31) || '512') AS key FROM events")
def cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key under which a rendered packet is kept: policy, packet, source digest and size limit."""
    return table(spark, sf_dir, "events").select("event_id", F.sha2(F.concat_ws(chr(31), F.lit("v1"), "props", F.sha2(F.col("event_type"), 256), F.lit("512")), 256).alias("key"))


def _register_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """Users as bank characters, two a person; their events as mentions of name groups."""
    e = table(spark, sf_dir, "events")
    user, k = F.col("user_id"), F.col("event_id")
    kind = F.when(k % 5 == 0, "introduction").when(k % 5 < 3, "direct_address").otherwise("reference")
    mentions = e.select(k.alias("ord"), F.expr("event_id div 2").alias("occurrence"), kind.alias("mtype"), (F.col("value") > 12).alias("confirmed"), F.concat(F.lit("g"), (F.expr("user_id div 2") * 3 + k % 2) % 9).alias("group_id"), (user - user % 2).alias("person"))
    members = e.select(user.alias("mid"), (user - user % 2).alias("person")).distinct()
    crops = e.where("value > 5").groupBy(user.alias("mid")).agg(F.count("*").alias("n"))
    groups = spark.createDataFrame([(f"g{i}", f"Name {i}") for i in range(8)], "group_id string, canonical_name string")
    named = members.where("person % 20 = 0").select("person").distinct()
    anchors = spark.createDataFrame([("g0", 0), ("g1", 20), ("g1", 40), ("g2", 2)], "group_id string, person long")
    return mentions, members, crops, groups, named, anchors


@query("U11_register")
def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which name group every bank character's mentions choose, and whether it may be used."""
    return I.registered(*_register_inputs(spark, sf_dir))[0]


@query("U11_register_names")
def register_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of persons after the proposed links."""
    return I.registered(*_register_inputs(spark, sf_dir))[2]


@query("R2_nest_and_unnest", oracle="SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R'")
def nest_and_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_partkey", "l_quantity", "l_returnflag")).alias("l"))
    return n.select("l_orderkey", F.inline(F.filter("l", lambda x: x["l_returnflag"] == "R"))).select("l_orderkey", "l_partkey", "l_quantity")


@query("T10_display_ids", oracle=r"SELECT doc_id, regexp_replace(source || ' of doc' || doc_id, 'doc(\d+)', 'document \1') AS text FROM documents")
def display_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace(F.concat("source", F.lit(" of doc"), "doc_id"), r"doc(\d+)", "document $1").alias("text"))


@query("F20_entity_filter", oracle="WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+')) AS w FROM documents) SELECT doc_id, count(*) AS n FROM w WHERE lower(w) NOT IN ('the', 'der', 'la', 'in', 'of') AND length(w) > 2 GROUP BY 1")
def entity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct capitalised words that are no pronoun or particle."""
    words = F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0)))
    kept = F.filter(words, lambda w: ~F.lower(w).isin("the", "der", "la", "in", "of") & (F.char_length(w) > 2))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(kept).cast("long").alias("n")).where("n > 0")


@query("E20_run_receipts", oracle="SELECT user_id, event_type AS step, count(*) AS attempts, round(sum(value), 6) AS runtime, arg_max(event_id, (ts, event_id)) AS receipt FROM events GROUP BY 1, 2")
def run_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts, time over all of them, and the latest receipt of every step."""
    return table(spark, sf_dir, "events").groupBy("user_id", F.col("event_type").alias("step")).agg(F.count("*").alias("attempts"), F.round(F.sum("value"), 6).alias("runtime"), F.max_by("event_id", F.struct("ts", "event_id")).alias("receipt"))
