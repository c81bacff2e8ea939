"""Joins, aggregations, set operations, upserts and versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkspring.functions import text as T
from inkspring.functions import vectors as V
from inkspring.operators import pairs as P
from inkspring.operators import registry as R
from inkspring.operators import sequences as Q
from inkspring.registry import query, table


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# Joins


@query("J1_equi", oracle="SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey")
def equi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@query("J2_outer_link", oracle="SELECT c_custkey, count(o_orderkey) AS orders, count(DISTINCT o_orderstatus) AS kinds FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 300000 GROUP BY 1")
def outer_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = table(spark, sf_dir, "orders").where("o_totalprice > 300000").groupBy("o_custkey").agg(F.count("*").alias("orders"), F.countDistinct("o_orderstatus").alias("kinds"))
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.join(big, c["c_custkey"] == big["o_custkey"], "left").select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), F.coalesce("kinds", F.lit(0)).alias("kinds"))


@query(
    "J9_route",
    oracle="""WITH r AS (SELECT o_orderkey, list(DISTINCT s_nationkey) AS people FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey JOIN customer ON c_custkey = o_custkey WHERE l_returnflag = 'R' AND c_acctbal > 0 GROUP BY 1)
    SELECT o_orderkey, len(people) AS n, CASE WHEN len(people) = 1 THEN 'locked' ELSE 'conflicting' END AS status, CASE WHEN len(people) = 1 THEN people[1] END AS person FROM r""",
)
def route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through their returned lines to suppliers: one person locks, several conflict."""
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_orderkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey"), F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    chain = orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), F.col("s_suppkey") == F.col("l_suppkey"))
    found = chain.groupBy("o_orderkey").agg(F.collect_set("s_nationkey").alias("people"))
    one = F.size("people") == 1
    return found.select("o_orderkey", F.size("people").cast("long").alias("n"), F.when(one, "locked").otherwise("conflicting").alias("status"), F.when(one, F.get("people", F.lit(0))).alias("person"))


@query("J10_tail_evidence", oracle="SELECT l_orderkey, l_shipdate, count(DISTINCT l_partkey) AS sources, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS kinds FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size < 20 GROUP BY 1, 2")
def tail_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").where("p_size < 20").select("p_partkey"), F.col("p_partkey") == F.col("l_partkey"))
    return j.groupBy("l_orderkey", "l_shipdate").agg(F.countDistinct("l_partkey").alias("sources"), F.array_join(F.array_sort(F.collect_set("l_linestatus")), ",").alias("kinds"))


@query("J11_union_people", oracle="SELECT 'c' || c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT 's' || s_suppkey, s_name FROM supplier")
def union_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_name").alias("name"))
    return c.unionByName(table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.col("s_name").alias("name")))


@query("J12_scope_context", oracle="SELECT c_nationkey, count(*) AS people, round(sum(c_acctbal), 2) AS balance FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') GROUP BY 1")
def scope_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(scope, "c_custkey", "left_semi").groupBy("c_nationkey").agg(F.count("*").alias("people"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


_E = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"


_MEANS = f"{_E}, x AS (SELECT label, i, avg(v[i]) AS m FROM e, range(1, 65) t(i) GROUP BY 1, 2), c AS (SELECT label, list(m ORDER BY i) AS m FROM x GROUP BY 1)"


@query(
    "J13_nearest_anchor",
    oracle=f"""WITH {_MEANS}, a AS (SELECT label, v FROM (SELECT label, v, row_number() OVER (PARTITION BY label ORDER BY round(list_distance(v, m), 5), vec_id) AS k FROM e JOIN c USING (label)) WHERE k <= 4),
    d AS (SELECT x.vec_id, a.label AS person, min(round(list_distance(x.v, a.v), 5)) AS d FROM e x, a GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, person) AS k FROM d WHERE d < 1.3) SELECT vec_id, person, d AS distance FROM r WHERE k = 1""",
)
def nearest_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every crop to the identity of the nearest anchor under a threshold, ties to the lowest identity; anchors are the
    four crops nearest to each identity's mean."""
    e = table(spark, sf_dir, "embeddings")
    best = Q.nearest_to_mean(e, "label", "vec_id", "embedding", 4).select("label", "vec_id")
    anchors = e.join(F.broadcast(best), ["label", "vec_id"]).select(F.col("label").alias("person"), "embedding")
    return R.nearest(e.select("vec_id", "embedding"), anchors, 1.3)


@query(
    "J14_candidate_scores",
    oracle=f"""WITH {_MEANS}
    SELECT vec_id, c.label AS candidate, round(list_distance(v, m), 5) AS score, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_distance(v, m), 5), c.label) AS place FROM e, c""",
)
def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observation against the mean vector of every identity (a table of identities, broadcast by size)."""
    e = table(spark, sf_dir, "embeddings")
    return R.scores(e.select("vec_id", "embedding"), R.means(e, "label", "embedding").withColumnRenamed("label", "candidate"))


@query("J15_pairs", oracle="SELECT least(a, b) AS a, greatest(a, b) AS b, count(*) AS n FROM (SELECT role AS a, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations) WHERE b IS NOT NULL AND a <> b GROUP BY 1, 2")
def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unordered pairs of consecutive speakers."""
    t = table(spark, sf_dir, "conversations").select(F.col("role").alias("x"), F.lead("role").over(W.partitionBy("conv_id").orderBy("turn")).alias("y")).where("x <> y")
    return t.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count("*").alias("n"))


@query("J16_address_semi", oracle="SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 7) OR l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3)")
def address_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges with either end among the people of a batch: two semi joins, the second without the first's rows."""
    e = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    p = table(spark, sf_dir, "part").where("p_size = 7").select(F.col("p_partkey").alias("l_partkey"))
    s = table(spark, sf_dir, "supplier").where("s_nationkey = 3").select(F.col("s_suppkey").alias("l_suppkey"))
    return e.join(p, "l_partkey", "left_semi").select("l_orderkey", "l_partkey", "l_suppkey").unionByName(e.join(p, "l_partkey", "left_anti").join(s, "l_suppkey", "left_semi").select("l_orderkey", "l_partkey", "l_suppkey"))


@query("J17_publish_flags", oracle="SELECT d.doc_id, concat_ws(',', CASE WHEN l.doc_id IS NULL THEN 'unlabelled' END, CASE WHEN quality = 0 THEN 'quality' END, CASE WHEN toxic = 1 THEN 'toxic' END) AS reasons FROM documents d LEFT JOIN labels l USING (doc_id)")
def publish_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "labels").withColumn("known", F.lit(True))  # noqa: E741
    flags = F.array(F.when(F.col("known").isNull(), "unlabelled"), F.when(F.col("quality") == 0, "quality"), F.when(F.col("toxic") == 1, "toxic"))
    return table(spark, sf_dir, "documents").select("doc_id").join(l, "doc_id", "left").select("doc_id", F.array_join(F.array_compact(flags), ",").alias("reasons"))


@query("J19_hash_mapping", oracle="SELECT a.event_id AS a, b.event_id AS b FROM events a JOIN events b ON sha256(a.props) = sha256(b.props) AND a.user_id = b.user_id AND a.event_id < b.event_id WHERE a.event_type = 'error' AND b.event_type = 'view'")
def hash_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of two runs matched by content hash and place."""
    side = lambda kind, name: events(spark, sf_dir).where(F.col("event_type") == kind).select(F.col("event_id").alias(name), "user_id", F.sha2("props", 256).alias("sha"))
    return side("error", "a").join(side("view", "b"), ["user_id", "sha"]).where("a < b").select("a", "b")


@query("J20_narrowing", oracle="""WITH a AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS x FROM events WHERE value < 3 GROUP BY 1), b AS (SELECT user_id, list(DISTINCT event_type) AS y FROM events WHERE value > 40 GROUP BY 1)
SELECT user_id, array_to_string(CASE WHEN len(list_intersect(x, y)) > 0 THEN list_sort(list_intersect(x, y)) ELSE x END, ',') AS ids FROM a LEFT JOIN b USING (user_id)""")
def narrowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The owner's ids, narrowed to those of the recipient where they share any."""
    a = events(spark, sf_dir).where("value < 3").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("x"))
    b = events(spark, sf_dir).where("value > 40").groupBy("user_id").agg(F.collect_set("event_type").alias("y"))
    both = F.array_intersect("x", F.coalesce("y", F.array().cast("array<string>")))
    return a.join(b, "user_id", "left").select("user_id", F.array_join(F.when(F.size(both) > 0, both).otherwise(F.col("x")), ",").alias("ids"))


@query("J21_coverage", oracle="SELECT 'missing' AS kind, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'unknown', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, l = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")  # noqa: E741
    count = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count(d.join(l, "doc_id", "left_anti"), "missing").unionByName(count(l.join(d, "doc_id", "left_anti"), "unknown"))


# Aggregations


@query("A2_chapter_counts", oracle="SELECT l_suppkey, count(DISTINCT (l_orderkey, l_partkey)) AS n FROM lineitem GROUP BY 1")
def chapter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_orderkey", "l_partkey").alias("n"))


@query("A3_membership", oracle="SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, count(DISTINCT ts::DATE) AS days FROM events GROUP BY 1")
def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types"), F.countDistinct(F.to_date("ts")).alias("days"))


@query("A4_name_votes", oracle="SELECT user_id, event_type, count(*) AS votes FROM (SELECT DISTINCT user_id, event_type, props FROM events) GROUP BY 1, 2")
def name_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("user_id", "event_type", "props").distinct().groupBy("user_id", "event_type").agg(F.count("*").alias("votes"))


@query("A5_rank_record", oracle="SELECT user_id, event_type, count(*) AS n, count(*) FILTER (WHERE value > 20) AS introductions, count(*) FILTER (WHERE value < 2) AS direct, min(event_id) AS first FROM events GROUP BY 1, 2")
def rank_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 20).alias("introductions"), F.count_if(F.col("value") < 2).alias("direct"), F.min("event_id").alias("first"))


@query(
    "A6_propose",
    oracle="""WITH s AS (SELECT user_id % 200 AS appearance, event_type AS person, count(DISTINCT props) AS n, bool_or(value > 30) AS visual FROM events GROUP BY 1, 2), k AS (SELECT *, count(*) OVER (PARTITION BY appearance) AS people FROM s)
    SELECT appearance, person, n, CASE WHEN people > 4 THEN 'conflict' WHEN visual THEN 'visual_support' WHEN n >= 2 THEN 'repeated_support' ELSE 'needs_review' END AS status FROM k""",
)
def propose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support of a person for an appearance by distinct occurrences; too many people conflict."""
    s = events(spark, sf_dir).groupBy((F.col("user_id") % 200).alias("appearance"), F.col("event_type").alias("person")).agg(F.countDistinct("props").alias("n"), F.bool_or(F.col("value") > 30).alias("visual"))
    people = F.count("*").over(W.partitionBy("appearance"))
    return s.withColumn("_p", people).select("appearance", "person", "n", F.when(F.col("_p") > 4, "conflict").when(F.col("visual"), "visual_support").when(F.col("n") >= 2, "repeated_support").otherwise("needs_review").alias("status"))


@query("A8_consensus_mean")
def consensus_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit mean of the most compact group of up to sixteen neighbours among all vectors of each identity."""
    return P.consensus(table(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", 16)


@query("A10_catalog", oracle="SELECT c_nationkey, string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey) AS members FROM customer GROUP BY 1")
def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_join(F.sort_array(F.collect_set("c_custkey")), ",").alias("members"))


@query("A11_background_stats", oracle="SELECT l_orderkey, count(*) AS n, round(avg(CASE WHEN l_tax < 0.05 THEN 1.0 ELSE 0 END), 6) AS bright, round(greatest(stddev_pop(l_tax), stddev_pop(l_discount)), 6) AS spread FROM lineitem GROUP BY 1 HAVING count(*) >= 4")
def background_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.col("l_tax") < 0.05, 1.0).otherwise(0.0)), 6).alias("bright"), F.round(F.greatest(F.stddev_pop("l_tax"), F.stddev_pop("l_discount")), 6).alias("spread")).where("n >= 4")


@query("A12_capacity", oracle="SELECT doc_id, sum(length(line))::BIGINT AS width, count(*) AS lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1")
def capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.split("text", "\n", -1)
    return table(spark, sf_dir, "documents").select("doc_id", F.aggregate(lines, F.lit(0).cast("long"), lambda s, x: s + F.char_length(x)).alias("width"), F.size(lines).cast("long").alias("lines"))


@query("A13_evidence_hashes", oracle="SELECT user_id, string_agg(h, ',' ORDER BY h) AS hashes FROM (SELECT DISTINCT user_id, sha256(props) AS h FROM events WHERE event_type = 'error') GROUP BY 1")
def evidence_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where("event_type = 'error'").groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_set(F.sha2("props", 256))), ",").alias("hashes"))


@query("A14_grouping_coverage", oracle="SELECT lang, count(*) AS detected, count(l.doc_id) AS grouped, string_agg(CASE WHEN l.doc_id IS NULL THEN d.doc_id::VARCHAR END, ',' ORDER BY d.doc_id) AS ungrouped FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def grouping_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("known"))  # noqa: E741
    j = table(spark, sf_dir, "documents").select("doc_id", "lang").join(l, "doc_id", "left")
    return j.groupBy("lang").agg(F.count("*").alias("detected"), F.count("known").alias("grouped"), F.array_join(F.sort_array(F.collect_list(F.when(F.col("known").isNull(), F.col("doc_id")))), ",").alias("ungrouped"))


@query("A15_counts", oracle="SELECT count(DISTINCT conv_id) AS scenes, count(*) AS utterances, count(*) FILTER (WHERE role = 'system') AS unresolved, sum(length(text))::BIGINT AS chars FROM conversations")
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").agg(F.countDistinct("conv_id").alias("scenes"), F.count("*").alias("utterances"), F.count_if(F.col("role") == "system").alias("unresolved"), F.sum(F.char_length("text")).alias("chars"))


@query("A16_histograms", oracle="SELECT lang, source, count(*) AS n FROM documents GROUP BY GROUPING SETS ((lang), (source), ())")
def histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several histograms in one pass."""
    return table(spark, sf_dir, "documents").groupingSets([["lang"], ["source"], []], "lang", "source").agg(F.count("*").alias("n"))


@query("A17_stage_summary", oracle="SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 10) AS matched, count(*) FILTER (WHERE value <= 10) AS rest FROM events GROUP BY 1")
def stage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 10).alias("matched"), F.count_if(F.col("value") <= 10).alias("rest"))


@query("A18_top_errors", oracle="SELECT props, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1 ORDER BY n DESC, props LIMIT 8")
def top_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where("event_type = 'error'").groupBy("props").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "props").limit(8)


@query("A19_distance_stats", oracle=f"WITH {_E}, d AS (SELECT x.label, x.vec_id AS a, y.vec_id AS b, round(list_distance(x.v, y.v), 5) AS d FROM e x JOIN e y ON x.label = y.label AND x.vec_id < y.vec_id) SELECT label, min(d) AS least, quantile_cont(d, 0.5) AS median, max(d) AS most, arg_min(a, (d, a, b)) AS a, arg_min(b, (d, a, b)) AS b, count(*) FILTER (WHERE d < 1.2) AS near FROM d GROUP BY 1")
def distance_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spread of the crops of an identity."""
    d = P.spread(table(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", 1.2)
    d = d.groupBy("label", "d").agg(F.sum("n").alias("n"), F.sum("near").alias("near"), F.min(F.when(F.col("a").isNotNull(), F.struct("a", "b"))).alias("p"))
    nearest = F.min(F.when(F.col("p").isNotNull(), F.struct("d", "p.a", "p.b")))
    return d.groupBy("label").agg(F.min("d").alias("least"), F.percentile("d", F.lit(0.5), F.col("n")).alias("median"), F.max("d").alias("most"), nearest.alias("n"), F.sum("near").alias("near")).select("label", "least", "median", "most", "n.a", "n.b", "near")


@query("A20_blended_score", oracle=f"WITH {_E}, d AS (SELECT x.vec_id AS a, round(list_distance(x.v, y.v), 5) AS d, row_number() OVER (PARTITION BY x.vec_id ORDER BY round(list_distance(x.v, y.v), 5), y.vec_id) AS k FROM e x JOIN e y ON x.label = y.label AND x.vec_id <> y.vec_id) SELECT a AS vec_id, round(0.6 * min(d) + 0.4 * avg(d), 4) AS score FROM d WHERE k <= 3 GROUP BY 1")
def blended_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    three = P.closest(table(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", 3)
    three = three.where(F.size("near") > 0).select(F.col("id").alias("vec_id"), F.transform("near", lambda x: x["d"]).alias("t"))
    total = F.aggregate("t", F.lit(0.0), lambda s, x: s + x)
    return three.select("vec_id", F.round(0.6 * F.get("t", F.lit(0)) + 0.4 * total / F.size("t"), 4).alias("score"))


@query("A21_match_rates", oracle=r"SELECT role, count(*) AS n, count(*) FILTER (WHERE trim(regexp_replace(text, '[\s\x{00A0}]+', ' ', 'g'), ' ') = text) AS equal FROM conversations GROUP BY 1")
def match_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").groupBy("role").agg(F.count("*").alias("n"), F.count_if(T.squeeze("text") == F.col("text")).alias("equal"))


@query("A23_metrics_scrape", oracle="SELECT user_id, coalesce(max(CASE WHEN event_type = 'purchase' THEN value END), max(CASE WHEN event_type = 'click' THEN value END), 0) AS peak, coalesce(sum(json_extract(props, '$.k')::BIGINT), 0)::BIGINT AS total FROM events GROUP BY 1")
def metrics_scrape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric by its name or an older alias, and the sum of samples parsed from text."""
    of = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("value")))
    return events(spark, sf_dir).groupBy("user_id").agg(F.coalesce(of("purchase"), of("click"), F.lit(0.0)).alias("peak"), F.coalesce(F.sum(F.get_json_object("props", "$.k").cast("long")), F.lit(0)).alias("total"))


@query("A24_overall_status", oracle="SELECT user_id, CASE WHEN bool_or(event_type = 'error') THEN 'failed' WHEN bool_and(event_type = 'view') THEN 'completed' WHEN bool_or(event_type = 'purchase') THEN 'running' ELSE 'pending' END AS status FROM events GROUP BY 1")
def overall_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_type")
    return events(spark, sf_dir).groupBy("user_id").agg(F.when(F.bool_or(e == "error"), "failed").when(F.bool_and(e == "view"), "completed").when(F.bool_or(e == "purchase"), "running").otherwise("pending").alias("status"))


# Set operations, upserts and versions


@query("U2_set_algebra", oracle="""WITH a AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND value > 20), b AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'view' AND value > 20)
SELECT 'both' AS kind, count(*) AS n FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'either', count(*) FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'first', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""")
def set_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = lambda kind: events(spark, sf_dir).where((F.col("event_type") == kind) & (F.col("value") > 20)).select("user_id").distinct()
    a, b = ids("error"), ids("view")
    n = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return n(a.intersect(b), "both").unionByName(n(a.union(b).distinct(), "either")).unionByName(n(a.exceptAll(b), "first"))


@query("U3_ordered_distinct", oracle="SELECT user_id, string_agg(event_type, ',' ORDER BY first) AS types FROM (SELECT user_id, event_type, min((ts, event_id)) AS first FROM events GROUP BY 1, 2) GROUP BY 1")
def ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = events(spark, sf_dir).groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("first"))
    return once.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "event_type"))), lambda x: x["event_type"]), ",").alias("types"))


@query("U4_dedup_last", oracle="SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2")
def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.last_wins(events(spark, sf_dir), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("U5_upsert", oracle="WITH k AS (SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, event_type, value, (n > 1) AS superseded FROM k")
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last writer wins by key, with a warning where rows were superseded."""
    return R.last_wins(events(spark, sf_dir), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "value", (F.col("_times") > 1).alias("superseded"))


@query("U6_overlay", oracle="SELECT d.doc_id, coalesce(CASE WHEN toxic = 1 THEN 'blocked' END, source) AS source, coalesce(quality, -1) AS quality FROM documents d LEFT JOIN labels l USING (doc_id)")
def overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted patches replace fields, others stay."""
    patch = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "blocked").alias("p_source"), F.col("quality").alias("p_quality"))
    return R.overlaid(table(spark, sf_dir, "documents").select("doc_id", "source", F.lit(-1).alias("quality")), patch, "doc_id", ["source", "quality"])


@query(
    "U7_corrections",
    oracle="""WITH p AS (SELECT event_id, user_id AS target, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events WHERE event_type = 'click')
    SELECT event_id, target, CASE WHEN target NOT IN (SELECT doc_id FROM documents) THEN 'unknown' WHEN k > 1 THEN 'duplicate' WHEN value > 30 THEN 'out_of_scope' ELSE 'accepted' END AS status FROM p""",
)
def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposals: known target, one each, in scope; the first reason against is told."""
    p = events(spark, sf_dir).where("event_type = 'click'").select("event_id", F.col("user_id").alias("target"), "value", F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).alias("k"))
    known = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("target"), F.lit(True).alias("known")).distinct()
    return p.join(known, "target", "left").select("event_id", "target", F.when(F.col("known").isNull(), "unknown").when(F.col("k") > 1, "duplicate").when(F.col("value") > 30, "out_of_scope").otherwise("accepted").alias("status"))


@query("U8_add_names", oracle="SELECT c_nationkey, substring(c_mktsegment, 1, 4) AS surface, count(*) AS refs, min(c_custkey) AS first, (min(c_custkey) = min(min(c_custkey)) OVER (PARTITION BY c_nationkey)) AS is_primary FROM customer GROUP BY 1, 2")
def add_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name forms of a person with their references; the first one seen is primary."""
    f = table(spark, sf_dir, "customer").groupBy("c_nationkey", F.substring("c_mktsegment", 1, 4).alias("surface")).agg(F.count("*").alias("refs"), F.min("c_custkey").alias("first"))
    return f.withColumn("is_primary", F.col("first") == F.min("first").over(W.partitionBy("c_nationkey")))


@query("U9_replace_index", oracle="SELECT p_name AS name, p_partkey AS id FROM part WHERE p_size >= 10 UNION ALL SELECT upper(p_name), p_partkey FROM part WHERE p_size < 10")
def replace_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of changed ids leave the index and come back rebuilt."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    changed = p.where("p_size < 10").select("p_partkey", F.upper("p_name").alias("name"))
    kept = p.select("p_partkey", F.col("p_name").alias("name")).join(changed.select("p_partkey"), "p_partkey", "left_anti")
    return kept.unionByName(changed).select("name", F.col("p_partkey").alias("id"))


@query("U13_resolve_speaker", oracle="SELECT user_id, event_id, CASE WHEN value > 20 THEN event_type WHEN user_id % 2 = 0 THEN 'view' ELSE 'unknown' END AS speaker, concat_ws(',', CASE WHEN value > 20 AND user_id % 2 = 0 AND event_type <> 'view' THEN 'anchor_conflict' END, CASE WHEN value <= 20 AND user_id % 2 <> 0 THEN 'unresolved' END) AS codes FROM events")
def resolve_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    inferred, anchor = F.when(F.col("value") > 20, F.col("event_type")), F.when(F.col("user_id") % 2 == 0, F.lit("view"))
    codes = F.array(F.when(inferred.isNotNull() & anchor.isNotNull() & (inferred != anchor), "anchor_conflict"), F.when(inferred.isNull() & anchor.isNull(), "unresolved"))
    return events(spark, sf_dir).select("user_id", "event_id", F.coalesce(inferred, anchor, F.lit("unknown")).alias("speaker"), F.array_join(F.array_compact(codes), ",").alias("codes"))


@query("U14_bind_names", oracle="SELECT user_id, arg_max(event_type, (CASE event_type WHEN 'signup' THEN 2 WHEN 'purchase' THEN 1 ELSE 0 END, -event_id)) AS name, count(DISTINCT event_type) - 1 AS aliases FROM events GROUP BY 1")
def bind_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name of highest priority, the earliest of these; the others are aliases."""
    rank = F.when(F.col("event_type") == "signup", 2).when(F.col("event_type") == "purchase", 1).otherwise(0)
    return events(spark, sf_dir).groupBy("user_id").agg(F.max_by("event_type", F.struct(rank, -F.col("event_id"))).alias("name"), (F.countDistinct("event_type") - 1).alias("aliases"))


@query("U16_soft_delete", oracle="SELECT vec_id, label, (vec_id % 7 = 0) AS disabled FROM embeddings")
def soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", (F.col("vec_id") % 7 == 0).alias("disabled"))


@query("U17_promote", oracle="SELECT c_custkey AS id, 'bank' AS place FROM customer WHERE c_acctbal > 0 UNION ALL SELECT c_custkey, 'pending' FROM customer WHERE c_acctbal <= 0")
def promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    moved = c.where("c_acctbal > 0").select("id", F.lit("bank").alias("place"))
    return moved.unionByName(c.join(moved, "id", "left_anti").select("id", F.lit("pending").alias("place")))


@query("U18_record_appearance", oracle="SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id, props FROM events) GROUP BY 1")
def record_appearance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only unseen keys count, so a replay changes nothing."""
    seen = events(spark, sf_dir).where("event_id % 2 = 0").select("user_id", "props").distinct()
    fresh = events(spark, sf_dir).select("user_id", "props").distinct().join(seen, ["user_id", "props"], "left_anti")
    return seen.unionByName(fresh).groupBy("user_id").agg(F.count("*").alias("n"))


@query("U19_reconcile", oracle="""WITH o AS (SELECT user_id, arg_min(event_type, (ts, event_id)) AS v, bool_or(value > 60) AS ok FROM events GROUP BY 1), n AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS v FROM events WHERE value > 5 GROUP BY 1)
SELECT user_id, CASE WHEN o.ok THEN o.v ELSE coalesce(n.v, o.v) END AS value, (o.ok AND n.v IS NOT NULL AND n.v <> o.v) AS conflict FROM o LEFT JOIN n USING (user_id)""")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A confirmed value is never overwritten; a differing new one is a conflict."""
    o = events(spark, sf_dir).groupBy("user_id").agg(F.min_by("event_type", F.struct("ts", "event_id")).alias("old"), F.bool_or(F.col("value") > 60).alias("confirmed"))
    n = events(spark, sf_dir).where("value > 5").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("new"))
    return R.reconciled(o, n, "user_id")


@query("U20_publish_versions", oracle="WITH v AS (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before, ts FROM events) SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version FROM v WHERE before IS NULL OR before <> event_type")
def publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only versions: a row is published when its value differs from the one before."""
    return R.versions(events(spark, sf_dir), "user_id", ["ts", "event_id"], "event_type").select("user_id", "event_id", "event_type", "version")


@query("U21_revert", oracle="SELECT user_id, event_type AS value, version FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back FROM events) WHERE back = 2")
def revert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state before the latest commit of each key."""
    rows = events(spark, sf_dir).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))).alias("h"))
    return rows.where("size(h) > 1").select("user_id", F.element_at("h", -2)["event_type"].alias("value"), (F.size("h") - 1).cast("long").alias("version"))


@query("U22_reuse", oracle="""WITH a AS (SELECT user_id, list(DISTINCT sha256(props)) AS h FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1), b AS (SELECT user_id, list(DISTINCT sha256(props)) AS h FROM events WHERE ts < TIMESTAMP '2024-01-05' GROUP BY 1)
SELECT user_id, (len(list_intersect(a.h, b.h)) = len(a.h)) AS reused FROM a JOIN b USING (user_id)""")
def reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result is reused while its evidence is within what it was made from."""
    h = lambda day, name: events(spark, sf_dir).where(F.col("ts") < F.lit(day).cast("timestamp_ntz")).groupBy("user_id").agg(F.collect_set(F.sha2("props", 256)).alias(name))
    return h("2024-01-10", "now").join(h("2024-01-05", "was"), "user_id").select("user_id", (F.size(F.array_except("now", "was")) == 0).alias("reused"))


@query("U23_fallback_terms", oracle="SELECT o_orderkey, CASE WHEN c_acctbal < 0 THEN 'younger' WHEN c_acctbal < 5000 THEN 'peer' ELSE 'older' END AS a_to_b, CASE WHEN c_acctbal < 0 THEN 'older' WHEN c_acctbal < 5000 THEN 'peer' ELSE 'younger' END AS b_to_a FROM orders JOIN customer ON c_custkey = o_custkey")
def fallback_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed terms from an ordinal comparison of two people."""
    age = F.when(F.col("c_acctbal") < 0, -1).when(F.col("c_acctbal") < 5000, 0).otherwise(1)
    term = lambda x: F.when(x < 0, "younger").when(x == 0, "peer").otherwise("older")
    j = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return j.select("o_orderkey", term(age).alias("a_to_b"), term(-age).alias("b_to_a"))
