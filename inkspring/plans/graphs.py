"""Graph operators: hierarchy, edges, redirects, components, closure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkspring.operators import graph as G
from inkspring.operators import pairs as P
from inkspring.plans.windows import _SCENES, scenes
from inkspring.registry import query, table


@query("P18_canonical", oracle="WITH RECURSIVE r AS (SELECT c_custkey AS id, c_custkey AS cur FROM customer UNION ALL SELECT id, cur // 2 FROM r WHERE cur >= 2) SELECT id, min(cur) AS root FROM r GROUP BY 1")
def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redirects id -> id / 2 followed to their end."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return G.resolved(c, c.where("id >= 2").select("id", F.expr("id div 2").alias("to")))


@query("P19_replace_ids", oracle="SELECT l_orderkey, l_linenumber, l_partkey, 'p' || (l_partkey % 500) AS part, l_suppkey, coalesce('s' || CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey END, 's?') AS supp FROM lineitem")
def replace_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids replaced through ledgers; an unknown id is marked."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.concat(F.lit("p"), F.col("p_partkey") % 500).alias("part"))
    supp = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("l_suppkey"), F.concat(F.lit("s"), "s_suppkey").alias("supp"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rows.join(parts, "l_partkey", "left").join(supp, "l_suppkey", "left").select("l_orderkey", "l_linenumber", "l_partkey", "part", "l_suppkey", F.coalesce("supp", F.lit("s?")).alias("supp"))


@query("P30_row_view", oracle="SELECT o_orderkey, o_custkey // 2 AS identity, o_custkey FROM orders")
def row_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows seen through their canonical identity."""
    canon = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.expr("c_custkey div 2").alias("identity"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(canon, "o_custkey", "left").select("o_orderkey", F.coalesce("identity", "o_custkey").alias("identity"), "o_custkey")


@query(
    "G1_hierarchy",
    oracle=f"""WITH {_SCENES}, c AS (SELECT *, (row_number() OVER (PARTITION BY user_id, scene ORDER BY ts, event_id) - 1) // 8 AS chunk FROM s)
    SELECT user_id, 'scene:' || scene AS scene_id, 'scene:' || scene || ':event:' || (chunk + 1) AS event_key, string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id) AS targets, count(*) AS n FROM c GROUP BY user_id, scene, chunk""",
)
def hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes and their events of at most eight targets."""
    return G.hierarchy(scenes(spark, sf_dir), "user_id", "scene", ["ts", "event_id"], "event_id", 8)


_TURNS = "t AS (SELECT conv_id, turn, role, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations)"


@query("G2_connections", oracle=f"WITH {_TURNS} SELECT 'contains' AS type, 'conv:' || conv_id AS src, 'turn:' || conv_id || ':' || turn AS dst FROM t UNION SELECT 'next', 'turn:' || conv_id || ':' || turn, 'turn:' || conv_id || ':' || next FROM t WHERE next IS NOT NULL")
def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.connections(table(spark, sf_dir, "conversations"))


@query("G3_assemble", oracle=f"WITH {_TURNS}, e AS (SELECT 'contains' AS type, 'conv:' || conv_id AS src, 'turn:' || conv_id || ':' || turn AS dst FROM t UNION SELECT 'next', 'turn:' || conv_id || ':' || turn, 'turn:' || conv_id || ':' || next FROM t WHERE next IS NOT NULL UNION SELECT 'speaker', 'turn:' || conv_id || ':' || turn, 'role:' || role FROM t) SELECT type, count(*) AS edges, count(DISTINCT src) AS sources, count(DISTINCT dst) AS targets FROM e GROUP BY 1")
def assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole multigraph, counted by edge type."""
    t = table(spark, sf_dir, "conversations")
    speakers = t.select(F.lit("speaker").alias("type"), F.concat_ws(":", F.lit("turn"), "conv_id", "turn").alias("src"), F.concat(F.lit("role:"), "role").alias("dst"))
    return G.connections(t).unionByName(speakers).distinct().groupBy("type").agg(F.count("*").alias("edges"), F.countDistinct("src").alias("sources"), F.countDistinct("dst").alias("targets"))


_LINKS = "e AS (SELECT DISTINCT 'd' || (event_id // 50) AS a, 'u' || user_id AS b FROM events WHERE event_type = 'purchase' AND value > 25)"


@query("G5_components", oracle=f"WITH RECURSIVE {_LINKS}, bb AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e), r AS (SELECT DISTINCT x AS node, x AS seen FROM bb UNION SELECT r.node, bb.y FROM r JOIN bb ON bb.x = r.seen) SELECT node, min(seen) AS component FROM r GROUP BY 1")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connected components over shared purchases: hash-to-min with pointer jumping, reliably checkpointed."""
    e = table(spark, sf_dir, "events").where("event_type = 'purchase' and value > 25")
    e = e.select(F.concat(F.lit("d"), F.expr("event_id div 50")).alias("a"), F.concat(F.lit("u"), "user_id").alias("b")).distinct()
    return G.components(e)


@query("G6_identity_clique", oracle="SELECT s_nationkey AS person, a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b USING (s_nationkey) WHERE a.s_suppkey < b.s_suppkey")
def identity_clique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of the ids of one person (a person has few)."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("person"), "s_suppkey")
    return s.withColumnRenamed("s_suppkey", "a").join(s.withColumnRenamed("s_suppkey", "b"), "person").where("a < b")


@query("G7_ancestors", oracle="""WITH RECURSIVE d AS (SELECT p.p_partkey AS step, q.p_partkey AS needs FROM part p JOIN part q ON q.p_partkey = p.p_partkey // 2 OR (p.p_partkey % 5 = 0 AND q.p_partkey = p.p_partkey // 5)),
r AS (SELECT step, needs FROM d UNION SELECT r.step, d.needs FROM r JOIN d ON d.step = r.needs) SELECT step, needs AS ancestor FROM r""")
def ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that each step needs, near or far: a part needs the one of half its number, or of a fifth of it."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("step"))
    needs = p.withColumn("needs", F.explode(F.array(F.expr("step div 2"), F.when(F.col("step") % 5 == 0, F.expr("step div 5"))))).where("needs is not null")
    # the ids of all parts are estimated small from their file, and would be sent to the driver
    return G.ancestors(needs.join(p.withColumnRenamed("step", "needs").hint("merge"), "needs", "left_semi"))


@query("X4_threshold_clusters", oracle="""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), e AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id WHERE round(list_distance(x.v, y.v), 5) < 1.15),
r AS (SELECT vec_id AS node, vec_id AS seen FROM v UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen), c AS (SELECT node, min(seen) AS first FROM r GROUP BY 1) SELECT node AS vec_id, first FROM c""")
def threshold_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters over all vectors: any two nearer than the threshold are linked; named by their first member."""
    return vector_clusters(table(spark, sf_dir, "embeddings"), 1.15)


def vector_clusters(e: DataFrame, limit: float, block: int = P.BLOCK) -> DataFrame:
    near = G.components(P.links(e, "vec_id", "embedding", limit, block)).withColumnRenamed("node", "vec_id")
    return e.select("vec_id").join(near, "vec_id", "left").select("vec_id", F.coalesce("component", "vec_id").alias("first"))


@query("S18_mermaid", oracle="SELECT conv_id, string_agg('t' || turn || '[' || role || '] --> t' || next, chr(10) ORDER BY turn) AS chart FROM (SELECT conv_id, turn, role, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations) WHERE next IS NOT NULL GROUP BY 1")
def mermaid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flowchart text of each conversation."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.lead("turn").over(W.partitionBy("conv_id").orderBy("turn")).alias("next")).where("next is not null")
    line = F.concat(F.lit("t"), "turn", F.lit("["), "role", F.lit("] --> t"), "next")
    return t.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x["line"]), "\n").alias("chart"))
