"""Windows, ranking, intervals and sequences. Every order ends in a unique key, so results do not depend on partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkspring.operators import graph as G
from inkspring.operators import sequences as Q
from inkspring.registry import query, table


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


@query("W1_choose_top", oracle="""WITH v AS (SELECT user_id, event_type, count(*) AS n, min(ts) AS first FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first, event_type) AS k FROM v) SELECT user_id, event_type, n FROM r WHERE k = 1""")
def choose_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most voted type of each user; ties to the earliest, then by name."""
    votes = events(spark, sf_dir).groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("ts").alias("first"))
    return votes.groupBy("user_id").agg(F.min_by(F.struct("event_type", "n"), F.struct(-F.col("n"), "first", "event_type")).alias("b")).select("user_id", "b.event_type", "b.n")


@query("W2_main_member", oracle="SELECT c_nationkey, arg_min(c_custkey, (-n, c_custkey)) AS main FROM (SELECT c_custkey, c_nationkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2) GROUP BY c_nationkey")
def main_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each nation the customer with the most orders; ties to the lowest key."""
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(n, "c_custkey", "left").fillna(0, ["n"])
    return rows.groupBy("c_nationkey").agg(F.min_by("c_custkey", F.struct(-F.col("n"), "c_custkey")).alias("main"))


@query("W3_margin", oracle="""WITH r AS (SELECT user_id, event_id, value, lead(value) OVER w AS second, row_number() OVER w AS k FROM events WINDOW w AS (PARTITION BY user_id ORDER BY value, event_id)) SELECT user_id, event_id, value AS best, second, (second IS NULL OR second - value >= 0.5) AS clear FROM r WHERE k = 1""")
def margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best distance of each user, the runner-up, and whether the margin between them is wide enough."""
    # at most two rows a user leave each task
    place = F.row_number().over(W.partitionBy("user_id").orderBy("value", "event_id"))
    nearest = events(spark, sf_dir).select("user_id", "value", "event_id").withColumn("place", place).where("place <= 2")
    two = nearest.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("value", "event_id"))).alias("b"))
    first, second = F.get("b", F.lit(0)), F.get("b", F.lit(1))
    return two.select("user_id", first["event_id"].alias("event_id"), first["value"].alias("best"), second["value"].alias("second"), F.coalesce(second["value"] - first["value"] >= 0.5, F.lit(True)).alias("clear"))


@query("W4_evidence_window", oracle="""WITH w AS (SELECT conv_id, turn, role, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)::BIGINT AS context, count(*) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS n FROM conversations) SELECT conv_id, turn, context, n FROM w WHERE role = 'user'""")
def evidence_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One turn either side of every user turn."""
    w = W.partitionBy("conv_id").orderBy("turn").rowsBetween(-1, 1)
    t = table(spark, sf_dir, "conversations")
    return t.select("conv_id", "turn", "role", F.sum(F.char_length("text")).over(w).alias("context"), F.count("*").over(w).alias("n")).where("role = 'user'").drop("role")


@query("W5_context_union", oracle="""WITH f AS (SELECT *, max(CASE WHEN length(text) < 200 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near FROM conversations) SELECT conv_id, turn FROM f WHERE near = 1""")
def context_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns within two of a target, each once: the union of all targets' windows."""
    return Q.near_targets(table(spark, sf_dir, "conversations"), F.char_length("text") < 200, "conv_id", "turn", 2).select("conv_id", "turn")


@query("W6_evidence_rows", oracle="""WITH w AS (SELECT conv_id, turn, role, string_agg(role, ',') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS roles FROM conversations) SELECT conv_id, turn, roles FROM w WHERE role = 'assistant'""")
def evidence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("conv_id").orderBy("turn").rowsBetween(-2, 2)
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.array_join(F.collect_list("role").over(w), ",").alias("roles"))
    return t.where("role = 'assistant'").drop("role")


_SCENES = """s AS (SELECT user_id, event_id, ts, value, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS scene,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events)"""


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user in order, cut into scenes at every error."""
    return Q.intervals(events(spark, sf_dir), "user_id", ["ts", "event_id"], F.col("event_type") == "error", "scene")


@query("W7_scene_intervals", oracle=f"WITH {_SCENES} SELECT user_id, scene, min(pos) AS start, max(pos) + 1 AS stop, count(*) AS n FROM s GROUP BY 1, 2")
def scene_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-open intervals between start markers."""
    return scenes(spark, sf_dir).groupBy("user_id", "scene").agg(F.min("pos").cast("long").alias("start"), (F.max("pos") + 1).cast("long").alias("stop"), F.count("*").alias("n"))


@query("W8_chunks", oracle=f"""WITH {_SCENES}, c AS (SELECT *, (row_number() OVER (PARTITION BY user_id, scene ORDER BY ts, event_id) - 1) // 8 AS chunk FROM s)
SELECT user_id, scene, chunk, count(*) AS n, CASE WHEN chunk > 0 THEN 'scene:' || scene || ':event:' || chunk END AS continuation_of FROM c GROUP BY 1, 2, 3""")
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a scene in runs of at most eight, each naming the one it continues."""
    rows = Q.chunked(scenes(spark, sf_dir), ["user_id", "scene"], ["ts", "event_id"], 8)
    out = rows.groupBy("user_id", "scene", "chunk").agg(F.count("*").alias("n"))
    return out.withColumn("continuation_of", F.when(F.col("chunk") > 0, F.concat_ws(":", F.lit("scene"), "scene", F.lit("event"), "chunk")))


@query("W9_anchor_segments", oracle="""WITH o AS (SELECT user_id, event_id, ts, CASE WHEN value < 20 THEN event_type END AS owner FROM events),
f AS (SELECT *, last_value(owner IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM o)
SELECT user_id, event_id, sum(CASE WHEN owner IS NOT NULL AND before IS NOT NULL AND owner <> before THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS segment FROM f""")
def anchor_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new segment where the owner changes; rows without an owner stay in the current one."""
    rows = events(spark, sf_dir).withColumn("owner", F.when(F.col("value") < 20, F.col("event_type")))
    return Q.owner_segments(rows, "user_id", ["ts", "event_id"], "owner").select("user_id", "event_id", "segment")


@query("W10_next_edges", oracle=f"WITH {_SCENES}, n AS (SELECT user_id, event_id AS a, lead(event_id) OVER (PARTITION BY user_id, scene ORDER BY ts, event_id) AS b FROM s) SELECT user_id, a, b FROM n WHERE b IS NOT NULL")
def next_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("user_id", "scene").orderBy("ts", "event_id")
    return scenes(spark, sf_dir).select("user_id", F.col("event_id").alias("a"), F.lead("event_id").over(w).alias("b")).where("b is not null")


@query("W11_scene_memory", oracle=f"""WITH {_SCENES}, m AS (SELECT user_id, scene, event_id, ts, value, value >= 10 AS ok FROM s)
SELECT user_id, event_id, round(coalesce(sum(CASE WHEN ok THEN value END) OVER w, 0), 6) AS memory, last_value(CASE WHEN ok THEN event_id END IGNORE NULLS) OVER w AS previous, count(CASE WHEN NOT ok THEN 1 END) OVER w AS missing
FROM m WINDOW w AS (PARTITION BY user_id, scene ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def scene_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an event knows of the ones before it in its scene: failed ones add nothing but are counted."""
    w = W.partitionBy("user_id", "scene").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, -1)
    ok = F.col("value") >= 10
    return scenes(spark, sf_dir).select("user_id", "event_id", F.round(F.coalesce(F.sum(F.when(ok, F.col("value"))).over(w), F.lit(0.0)), 6).alias("memory"), F.last(F.when(ok, F.col("event_id")), ignorenulls=True).over(w).alias("previous"), F.count(F.when(~ok, 1)).over(w).alias("missing"))


@query("W12_halves", oracle=f"""WITH {_SCENES}, n AS (SELECT user_id, scene, count(*) AS n FROM s GROUP BY 1, 2), c AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY scene) AS cum, sum(n) OVER (PARTITION BY user_id) AS total FROM n)
SELECT user_id, arg_min(scene, (abs(total - 2 * cum), scene)) AS cut FROM c GROUP BY 1""")
def halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cut that divides a user's scenes most evenly; ties to the first."""
    sizes = scenes(spark, sf_dir).groupBy("user_id", "scene").agg(F.count("*").alias("n"))
    return Q.even_cut(sizes, "user_id", "scene", "n").select("user_id", "cut")


@query("W16_spread", oracle="""WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, count(*) OVER (PARTITION BY user_id) AS n FROM events),
k AS (SELECT DISTINCT user_id, CASE WHEN n <= 5 THEN pos ELSE round_even(i * (n - 1) / 4.0, 0)::BIGINT END AS pos FROM r, range(5) t(i)) SELECT user_id, event_id, pos FROM r JOIN k USING (user_id, pos)""")
def spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five evenly spaced events of every user, positions rounded half to even."""
    return Q.spread(events(spark, sf_dir), "user_id", ["ts", "event_id"], 5).select("user_id", "event_id", "pos")


@query("W18_reading_pages", oracle="""WITH u AS (SELECT conv_id, turn, 0 AS kind, length(text) AS n FROM conversations UNION ALL SELECT event_id % 100, user_id % 8, 1, length(props) FROM events)
SELECT conv_id, turn, kind, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn, kind, n) AS place FROM u""")
def reading_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utterances and effects of a page merged in reading order."""
    a = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lit(0).alias("kind"), F.char_length("text").cast("long").alias("n"))
    b = table(spark, sf_dir, "events").select((F.col("event_id") % 100).alias("conv_id"), (F.col("user_id") % 8).alias("turn"), F.lit(1).alias("kind"), F.char_length("props").cast("long").alias("n"))
    return a.unionByName(b).withColumn("place", F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "kind", "n")).cast("long"))


_CENTRES = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), x AS (SELECT label, i, avg(v[i]) AS m FROM e, range(1, 65) t(i) GROUP BY 1, 2),
c AS (SELECT label, list(m ORDER BY i) AS m FROM x GROUP BY 1)"""


@query("W19_nearest_crops", oracle=f"""WITH {_CENTRES}, d AS (SELECT label, vec_id, round(list_distance(v, m), 5) AS d FROM e JOIN c USING (label)), r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY d, vec_id) AS k FROM d) SELECT label, vec_id, d AS distance, k AS place FROM r WHERE k <= 4""")
def nearest_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four crops of each identity nearest to its mean."""
    return Q.nearest_to_mean(table(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", 4)


@query("W20_visible_duplicates", oracle="""WITH k AS (SELECT user_id, event_type, min(ts) AS ts, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM k) SELECT user_id, event_id, event_type FROM r WHERE k <= 3""")
def visible_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of every content, then the first three."""
    once = events(spark, sf_dir).groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("b"))
    three = once.groupBy("user_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("b.ts", "b.event_id", "event_type"))), 1, 3).alias("b"))
    return three.select("user_id", F.inline("b")).select("user_id", "event_id", "event_type")


@query("W21_latest_version", oracle="SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2")
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = events(spark, sf_dir).groupBy("user_id", "event_type").agg(F.max_by(F.struct("event_id", "value"), F.struct("ts", "event_id")).alias("b"))
    return last.select("user_id", "event_type", "b.event_id", "b.value")


@query("W25_numbering", oracle="SELECT conv_id, turn, 'u' || (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) AS number, dense_rank() OVER (PARTITION BY conv_id ORDER BY role) - 1 AS role_number FROM conversations")
def numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("conv_id")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(F.lit("u"), F.row_number().over(w.orderBy("turn")) - 1).alias("number"), (F.dense_rank().over(w.orderBy("role")) - 1).cast("long").alias("role_number"))


@query("W26_natural_sort", oracle=r"""WITH n AS (SELECT p_partkey, p_name || ' ' || (p_partkey % 37) || '.png' AS name, p_name AS a, p_partkey % 37 AS d FROM part) SELECT p_partkey, name, row_number() OVER (PARTITION BY p_partkey % 5 ORDER BY a, d, p_partkey) AS place FROM n""")
def natural_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names with numbers compared as numbers."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(" "), F.col("p_partkey") % 37, F.lit(".png")).alias("name"))
    keyed = p.withColumn("folder", F.col("p_partkey") % 5).withColumn("key", Q.natural_key("name"))
    return G.numbered(keyed, "folder", [F.asc("key"), F.asc("p_partkey")], "place").select("p_partkey", "name", "place")


@query("W27_pending_window", oracle="""WITH s AS (SELECT user_id, event_type, ts::DATE - DATE '2024-01-01' AS page FROM events GROUP BY ALL), n AS (SELECT *, lead(page) OVER (PARTITION BY user_id, event_type ORDER BY page) AS next FROM s)
SELECT user_id, event_type, page, CASE WHEN next IS NOT NULL AND next - page <= 1 THEN 'promoted' WHEN page < (SELECT max(page) FROM s) - 1 THEN 'closed' ELSE 'pending' END AS state FROM n""")
def pending_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sighting is promoted by another at most one page later; else it closes once that page has gone by."""
    s = events(spark, sf_dir).select("user_id", "event_type", F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("long").alias("page")).distinct()
    return Q.pending(s, ["user_id", "event_type"], "page", 1)


@query("O1_total_order", oracle="SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey) AS place FROM orders")
def total_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return G.numbered(orders, "o_orderstatus", [F.desc("o_orderpriority"), F.asc("o_totalprice"), F.asc("o_orderkey")], "place").select("o_orderkey", "place")


@query("O2_top_five", oracle="SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k <= 5")
def top_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", F.row_number().over(w).alias("k")).where("k <= 5").drop("k")


@query("O3_first_k", oracle="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 12")
def first_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").orderBy("o_orderdate", "o_orderkey").limit(12).select("o_orderkey", "o_totalprice")


@query("O4_last_twelve", oracle="SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events WHERE event_type <> 'error') WHERE k <= 12")
def last_twelve(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return events(spark, sf_dir).where("event_type <> 'error'").select("user_id", "event_id", F.row_number().over(w).alias("k")).where("k <= 12").drop("k")


@query("O5_arg_extremes", oracle="SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS dearest, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS cheapest FROM orders GROUP BY 1")
def arg_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("dearest"), F.min_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("cheapest"))


@query("O6_numeric_ids", oracle="WITH i AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE (c_custkey % 100)::VARCHAR END AS id, c_nationkey FROM customer) SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY try_cast(id AS INT) NULLS LAST, id, c_custkey) AS place FROM i")
def numeric_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers before other ids, compared as numbers."""
    i = table(spark, sf_dir, "customer").withColumn("id", F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise((F.col("c_custkey") % 100).cast("string")))
    w = W.partitionBy("c_nationkey").orderBy(F.expr("try_cast(id AS INT)").asc_nulls_last(), "id", "c_custkey")
    return i.select("c_custkey", F.row_number().over(w).cast("long").alias("place"))


@query("O7_sorted_merge", oracle="SELECT a, b, category, row_number() OVER (PARTITION BY a ORDER BY b, category) AS place FROM (SELECT DISTINCT o_custkey AS a, l_suppkey AS b, l_returnflag AS category FROM orders JOIN lineitem ON l_orderkey = o_orderkey)")
def sorted_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    e = e.select(F.col("o_custkey").alias("a"), F.col("l_suppkey").alias("b"), F.col("l_returnflag").alias("category")).distinct()
    return e.withColumn("place", F.row_number().over(W.partitionBy("a").orderBy("b", "category")).cast("long"))
