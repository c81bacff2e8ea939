"""Validation: every check is a table of violations or of accepted and rejected rows; nothing raises on data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkspring.functions import text as T
from inkspring.operators import checks as C
from inkspring.registry import query, table


@query("F1_empty_split", oracle=r"SELECT CASE WHEN trim(regexp_replace(line, '[\s\x{00A0}]+', ' ', 'g'), ' ') = '' THEN 'excluded' ELSE 'kept' END AS status, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1")
def empty_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n", -1)).alias("line"))
    return lines.groupBy(F.when(T.squeeze("line") == "", "excluded").otherwise("kept").alias("status")).agg(F.count("*").alias("n"))


@query("F2_anchor_validity", oracle="SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber BETWEEN 1 AND 3)")
def anchor_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    l = table(spark, sf_dir, "lineitem").where("l_linenumber between 1 and 3").select(F.col("l_orderkey").alias("o_orderkey"))  # noqa: E741
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(c, "o_custkey", "left_semi").join(l, "o_orderkey", "left_semi").select("o_orderkey")


@query("F3_source_anchor", oracle="SELECT DISTINCT o_orderkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey WHERE c_acctbal > 0 AND s_nationkey = c_nationkey AND l_returnflag <> 'N'")
def source_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    l = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'N'").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")  # noqa: E741
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    return o.join(c, "o_custkey").join(l, "o_orderkey").join(s, ["l_suppkey", "nation"]).select("o_orderkey").distinct()


@query("F4_eligible", oracle="SELECT user_id FROM events GROUP BY 1 HAVING count(DISTINCT props) >= 8 OR bool_or(event_type = 'purchase' AND value > 40)")
def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.countDistinct("props").alias("n"), F.bool_or((F.col("event_type") == "purchase") & (F.col("value") > 40)).alias("known"))
    return e.where("n >= 8 or known").select("user_id")


@query("F5_confirmed", oracle="SELECT user_id, bool_or(event_type = 'signup' AND value > 10) AS confirmed FROM events GROUP BY 1")
def confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = (F.col("event_type") == "signup") & (F.col("value") > 10)
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.bool_or(form).alias("confirmed"))


@query("F6_disjoint", oracle="SELECT count(*) AS overlap FROM (SELECT user_id FROM events WHERE event_type = 'view' INTERSECT SELECT user_id FROM events WHERE event_type = 'error')")
def disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.where("event_type = 'view'").select("user_id").intersect(e.where("event_type = 'error'").select("user_id")).agg(F.count("*").alias("overlap"))


@query("F7_role_filter", oracle="SELECT conv_id, turn, role FROM conversations WHERE role IN ('user', 'assistant') OR length(text) < 20")
def role_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").where(F.col("role").isin("user", "assistant") | (F.char_length("text") < 20)).select("conv_id", "turn", "role")


@query("F8_export_router", oracle="SELECT event_id, CASE WHEN event_type IN ('click') THEN 'effects' WHEN event_type IN ('signup', 'error') THEN 'excluded' ELSE 'retained' END AS route FROM events")
def export_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_type")
    return table(spark, sf_dir, "events").select("event_id", F.when(e == "click", "effects").when(e.isin("signup", "error"), "excluded").otherwise("retained").alias("route"))


_VIOLATIONS = """concat_ws(',', CASE WHEN l_quantity < 5 THEN 'low_quantity' END, CASE WHEN l_discount > 0.09 THEN 'discount' END, CASE WHEN l_tax * 1000 > 70 THEN 'tax' END,
CASE WHEN l_returnflag NOT IN ('A', 'N', 'R') THEN 'flag' END, CASE WHEN l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40) THEN 'part' END)"""


@query("F9_validate_row", oracle=f"SELECT l_orderkey, l_linenumber, l_partkey, {_VIOLATIONS} AS violations FROM lineitem")
def validate_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered checks as a list of codes; an accepted row has none."""
    rows = table(spark, sf_dir, "lineitem")
    known = table(spark, sf_dir, "part").where("p_size < 40").select(F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("known"))
    return rows.join(known, "l_partkey", "left").select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(C.violations({"low_quantity": F.col("l_quantity") < 5, "discount": F.col("l_discount") > 0.09, "tax": F.col("l_tax") * 1000 > 70, "flag": ~F.col("l_returnflag").isin("A", "N", "R"), "part": F.col("known").isNull()}), ",").alias("violations"))


@query("F10_failed_row", oracle="SELECT d.doc_id, coalesce(l.quality, -1) AS quality, l.doc_id IS NULL AS failed FROM documents d LEFT JOIN labels l USING (doc_id)")
def failed_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A default decision where there is no result."""
    l = table(spark, sf_dir, "labels").select("doc_id", "quality", F.lit(True).alias("has"))  # noqa: E741
    return table(spark, sf_dir, "documents").select("doc_id").join(l, "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.col("has").isNull().alias("failed"))


@query("F11_profile_checks", oracle="SELECT user_id, concat_ws(',', CASE WHEN count(*) < 5 THEN 'evidence' END, CASE WHEN NOT bool_or(event_type = 'view') THEN 'basis' END, CASE WHEN max(value) > 60 THEN 'range' END) AS violations FROM events GROUP BY 1")
def profile_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.bool_or(F.col("event_type") == "view").alias("basis"), F.max("value").alias("top"))
    return e.select("user_id", F.array_join(C.violations({"evidence": F.col("n") < 5, "basis": ~F.col("basis"), "range": F.col("top") > 60}), ",").alias("violations"))


@query("F12_relationship_checks", oracle="WITH p AS (SELECT least(role, next) AS a, greatest(role, next) AS b, count(DISTINCT role) AS directions FROM (SELECT role, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations) WHERE next IS NOT NULL GROUP BY 1, 2) SELECT a, b, directions, CASE WHEN a = b THEN 'self' WHEN directions <> 2 THEN 'one_way' ELSE 'ok' END AS status FROM p")
def relationship_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "conversations").select("role", F.lead("role").over(W.partitionBy("conv_id").orderBy("turn")).alias("next")).where("next is not null")
    p = t.groupBy(F.least("role", "next").alias("a"), F.greatest("role", "next").alias("b")).agg(F.countDistinct("role").alias("directions"))
    return p.withColumn("status", F.when(F.col("a") == F.col("b"), "self").when(F.col("directions") != 2, "one_way").otherwise("ok"))


@query("F13_adapters", oracle="SELECT k.user_id, t.event_type, coalesce(e.value, 'unknown') AS value FROM (SELECT DISTINCT user_id FROM events) k CROSS JOIN (VALUES ('click'), ('error'), ('purchase')) t(event_type) LEFT JOIN (SELECT user_id, event_type, max(props) AS value FROM events GROUP BY 1, 2) e ON e.user_id = k.user_id AND e.event_type = t.event_type")
def adapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every expected attribute of a profile; a missing one is repaired to 'unknown'."""
    e = table(spark, sf_dir, "events")
    have = e.groupBy("user_id", "event_type").agg(F.max("props").alias("value"))
    want = e.select("user_id").distinct().withColumn("event_type", F.explode(F.array(*map(F.lit, ("click", "error", "purchase")))))
    return want.join(have, ["user_id", "event_type"], "left").select("user_id", "event_type", F.coalesce("value", F.lit("unknown")).alias("value"))


@query("F15_chapter_invariants", oracle="""SELECT 'order' AS rule, count(*) AS n FROM (SELECT turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k FROM conversations) WHERE turn <> k UNION ALL SELECT 'duplicate', count(*) - count(DISTINCT (conv_id, turn)) FROM conversations
UNION ALL SELECT 'coverage', count(*) FROM (SELECT conv_id FROM conversations GROUP BY 1 HAVING count(*) <> max(turn) - min(turn) + 1) UNION ALL SELECT 'size', count(*) FROM (SELECT conv_id FROM conversations GROUP BY 1 HAVING count(*) > 8)""")
def chapter_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.sequence_invariants(table(spark, sf_dir, "conversations"), "conv_id", "turn", 8)


@query("F16_pack_coverage", oracle="SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 'unknown' ELSE 'missing' END AS problem FROM (SELECT doc_id FROM documents WHERE doc_id % 2 = 0) a FULL JOIN (SELECT doc_id FROM labels) b USING (doc_id) WHERE a.doc_id IS NULL OR b.doc_id IS NULL")
def pack_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that one side lacks: full outer on the id, problems only."""
    a = table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select("doc_id", F.lit(1).alias("x"))
    b = table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("y"))
    return a.join(b, "doc_id", "full").where("x is null or y is null").select("doc_id", F.when(F.col("x").isNull(), "unknown").otherwise("missing").alias("problem"))


@query("F17_evidence_subset", oracle="WITH r AS (SELECT user_id, list(DISTINCT event_type) AS refs FROM events WHERE value > 25 GROUP BY 1), s AS (SELECT user_id, list(DISTINCT event_type) AS supplied FROM events WHERE value <= 25 GROUP BY 1) SELECT user_id, (len(list_intersect(refs, supplied)) = len(refs)) AS ok FROM r LEFT JOIN s USING (user_id)")
def evidence_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = lambda cond, name: table(spark, sf_dir, "events").where(cond).groupBy("user_id").agg(F.collect_set("event_type").alias(name))
    j = side("value > 25", "refs").join(side("value <= 25", "supplied"), "user_id", "left")
    return j.select("user_id", F.when(F.col("supplied").isNull(), F.lit(None).cast("boolean")).otherwise(F.size(F.array_except("refs", "supplied")) == 0).alias("ok"))


@query("F18_artifact_hashes", oracle="SELECT event_id, sha256(props) = sha256(CASE WHEN event_id % 13 = 0 THEN props || ' ' ELSE props END) AS intact FROM events")
def artifact_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts against the hash in their receipts; both stand in one row, so no join is needed."""
    now = F.when(F.col("event_id") % 13 == 0, F.concat("props", F.lit(" "))).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", (F.sha2("props", 256) == F.sha2(now, 256)).alias("intact"))


@query("S6_validate_raw", oracle="SELECT conv_id, count(*) AS n, count(*) - count(DISTINCT turn) AS repeats, count(*) FILTER (WHERE text IS NULL) AS missing, count(*) FILTER (WHERE turn <> k) AS disordered FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k FROM conversations) GROUP BY 1")
def validate_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "conversations").withColumn("k", F.row_number().over(W.partitionBy("conv_id").orderBy("turn")) - 1)
    return t.groupBy("conv_id").agg(F.count("*").alias("n"), (F.count("*") - F.countDistinct("turn")).alias("repeats"), F.count_if(F.col("text").isNull()).alias("missing"), F.count_if(F.col("turn") != F.col("k")).alias("disordered"))


@query("X1_field_diff", oracle="""WITH a AS (SELECT doc_id, 'source' AS field, source AS v FROM documents UNION ALL SELECT doc_id, 'lang', lang FROM documents), b AS (SELECT d.doc_id, 'source' AS field, CASE WHEN quality = 0 THEN 'junk' ELSE source END AS v FROM documents d JOIN labels USING (doc_id) UNION ALL SELECT d.doc_id, 'lang', CASE WHEN toxic = 1 THEN 'xx' ELSE lang END FROM documents d JOIN labels USING (doc_id))
SELECT doc_id, field, a.v AS before, b.v AS after FROM a JOIN b USING (doc_id, field) WHERE a.v IS DISTINCT FROM b.v""")
def field_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed fields of patched rows, before and after."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    patched = d.join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", F.when(F.col("quality") == 0, "junk").otherwise(F.col("source")).alias("source"), F.when(F.col("toxic") == 1, "xx").otherwise(F.col("lang")).alias("lang"))
    return C.field_diff(d, patched, "doc_id", ["source", "lang"])


@query("X2_attention", oracle="SELECT conv_id, bool_or(length(text) < 60 OR role = 'system') AS attention FROM conversations GROUP BY 1")
def attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.bool_or((F.char_length("text") < 60) | (F.col("role") == "system")).alias("attention"))


@query("X3_hierarchy_audit", oracle="SELECT conv_id, concat_ws(',', CASE WHEN count(*) NOT BETWEEN 2 AND 6 THEN 'size' END, CASE WHEN count(DISTINCT role) < 2 THEN 'roles' END, CASE WHEN max(length(text)) > 1500 THEN 'long' END) AS warnings, count(*) AS n FROM conversations GROUP BY 1")
def hierarchy_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.countDistinct("role").alias("roles"), F.max(F.char_length("text")).alias("top"))
    return g.select("conv_id", F.array_join(C.violations({"size": ~F.col("n").between(2, 6), "roles": F.col("roles") < 2, "long": F.col("top") > 1500}), ",").alias("warnings"), "n")


@query("X5_threshold_sweep", oracle="SELECT t AS threshold, count(*) FILTER (WHERE value >= t) AS accepted, count(*) FILTER (WHERE value < t) AS rejected, count(*) FILTER (WHERE (value >= t) <> (value >= 10)) AS changed FROM events, (VALUES (5), (10), (20), (40)) v(t) GROUP BY 1")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and changed rows at several thresholds in one pass."""
    v = F.col("value")
    return C.sweep(table(spark, sf_dir, "events"), v, [5, 10, 20, 40], 10)


@query("X6_change_counters", oracle=r"SELECT role, count(*) AS n, count(*) FILTER (WHERE text <> squeezed) AS changed, count(*) FILTER (WHERE lower(text) <> lower(squeezed)) AS content FROM (SELECT *, trim(regexp_replace(text, '[\s\x{00A0}]+', ' ', 'g'), ' ') AS squeezed FROM conversations) GROUP BY 1")
def change_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "conversations").withColumn("s", T.squeeze("text"))
    return t.groupBy("role").agg(F.count("*").alias("n"), F.count_if(F.col("text") != F.col("s")).alias("changed"), F.count_if(F.lower("text") != F.lower("s")).alias("content"))


@query("X7_status_counters", oracle="SELECT source, count(*) FILTER (WHERE n_chars > 200) AS succeeded, count(*) FILTER (WHERE n_chars BETWEEN 1 AND 200) AS short, count(*) FILTER (WHERE n_chars > 20000) AS truncated FROM documents GROUP BY 1")
def status_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars")
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count_if(n > 200).alias("succeeded"), F.count_if(n.between(1, 200)).alias("short"), F.count_if(n > 20000).alias("truncated"))


@query("X8_plan_compare", oracle="WITH a AS (SELECT l_orderkey, l_partkey, max(l_quantity) AS q FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2), b AS (SELECT l_orderkey, l_partkey, max(l_quantity) + 1 AS q FROM lineitem WHERE l_discount > 0.02 GROUP BY 1, 2) SELECT l_orderkey, l_partkey, a.q AS before, b.q AS after FROM a JOIN b USING (l_orderkey, l_partkey)")
def plan_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans of two runs side by side."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    a = l.where("l_linestatus = 'F'").groupBy("l_orderkey", "l_partkey").agg(F.max("l_quantity").alias("before"))
    return a.join(l.where("l_discount > 0.02").groupBy("l_orderkey", "l_partkey").agg((F.max("l_quantity") + 1).alias("after")), ["l_orderkey", "l_partkey"])


@query("X9_errors", oracle="SELECT user_id, 'not_completed' AS error FROM events GROUP BY 1 HAVING NOT bool_or(event_type = 'purchase') UNION ALL SELECT user_id, 'failure:' || event_id FROM events WHERE event_type = 'error' AND value > 50")
def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    open_steps = e.groupBy("user_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("done")).where("not done").select("user_id", F.lit("not_completed").alias("error"))
    return open_steps.unionByName(e.where("event_type = 'error' and value > 50").select("user_id", F.concat(F.lit("failure:"), "event_id").alias("error")))


@query("X10_latest_run", oracle="SELECT user_id, arg_max(event_id, (ts, event_id)) AS run FROM events WHERE event_type <> 'error' GROUP BY 1")
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type <> 'error'").groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("run"))


@query("X11_page_tables", oracle="SELECT lpad(conv_id::VARCHAR, 5, '0') AS page, count(*) AS n, string_agg(role, ',' ORDER BY turn) AS roles FROM conversations GROUP BY 1")
def page_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "conversations").groupBy(F.lpad(F.col("conv_id").cast("string"), 5, "0").alias("page")).agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("t"))
    return g.select("page", F.size("t").cast("long").alias("n"), F.array_join(F.transform("t", lambda x: x["role"]), ",").alias("roles"))


@query("X17_cross_coverage", oracle="SELECT k.lang, s.style, count(d.doc_id) AS n FROM (SELECT DISTINCT lang FROM documents) k CROSS JOIN (VALUES ('src0'), ('src1'), ('none')) s(style) LEFT JOIN documents d ON d.lang = k.lang AND d.source = s.style GROUP BY 1, 2 HAVING count(d.doc_id) <> 1")
def cross_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected combinations that do not occur exactly once."""
    d = table(spark, sf_dir, "documents")
    want = d.select("lang").distinct().withColumn("style", F.explode(F.array(*map(F.lit, ("src0", "src1", "none")))))
    have = d.groupBy("lang", F.col("source").alias("style")).agg(F.count("*").alias("n"))
    return want.join(have, ["lang", "style"], "left").select("lang", "style", F.coalesce("n", F.lit(0)).alias("n")).where("n <> 1")


@query("X18_receipt_predicate", oracle="SELECT user_id, (count(*) >= 5 AND bool_and(value >= 0) AND max(value) < 80 AND count(DISTINCT event_type) >= 3) AS ok FROM events GROUP BY 1")
def receipt_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    r = e.groupBy("user_id").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.countDistinct("event_type").alias("kinds"))
    return r.select("user_id", F.expr("n >= 5 and lo >= 0 and hi < 80 and kinds >= 3").alias("ok"))


@query("X19_wildcard_context", oracle="SELECT user_id, event_id, count(*) FILTER (WHERE event_type = 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS failed_before FROM events")
def wildcard_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, -1)
    return table(spark, sf_dir, "events").select("user_id", "event_id", F.count(F.when(F.col("event_type") == "error", 1)).over(w).alias("failed_before"))
