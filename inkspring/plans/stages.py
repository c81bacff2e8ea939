"""Whole stages of a chapter as queries: normalise, parse names, export, pack; and queries of single helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspring.operators import chapter as C
from inkspring.operators import graph as G
from inkspring.operators import names as N
from inkspring.plans.scalars import SQUEEZE
from inkspring.registry import query, table


@query(
    "stage4_normalize",
    oracle=rf"""WITH b AS (SELECT conv_id AS document, turn, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM conversations),
    r AS (SELECT document, 't' || turn || '-' || pos AS id, CASE WHEN turn % 3 > 0 THEN 'g' || turn END AS group_id, turn * 100000 + pos AS ord, line AS text, CASE WHEN length(line) % 3 > 0 THEN length(line) % 3 END AS person, pos % 2 = 0 AS essential, turn, {SQUEEZE.format('nfc_normalize(line)')} AS squeezed FROM b),
    k AS (SELECT *, coalesce(group_id, id) AS key, turn % 5 = 4 AND group_id IS NOT NULL AS caption FROM r WHERE squeezed <> ''),
    p AS (SELECT *, last_value(person IGNORE NULLS) OVER (PARTITION BY document, key ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM k),
    s AS (SELECT *, CASE WHEN before <> person AND NOT caption THEN 1 ELSE 0 END AS new FROM p),
    g AS (SELECT *, sum(new) OVER (PARTITION BY document, key ORDER BY ord) AS segment, max(new) OVER (PARTITION BY document, key) > 0 AS cut FROM s),
    u AS (SELECT document, key, cut, segment, string_agg(squeezed, ' ' ORDER BY ord) AS text, string_agg(id, ',' ORDER BY ord) AS sources, bool_or(essential) AS is_essential_text, any_value(group_id) AS group_id, min(ord) AS ord FROM g GROUP BY ALL)
    SELECT document, key || CASE WHEN cut THEN ':anchor-segment-' || (segment + 1)::BIGINT ELSE '' END || ':u' AS id, group_id, text, sources, is_essential_text, row_number() OVER (PARTITION BY document ORDER BY ord) - 1 AS reading_order,
      CASE WHEN group_id IS NULL THEN 'standalone_text' ELSE 'physical_group' END || CASE WHEN cut THEN ',split_conflicting_anchors' ELSE '' END AS reasons FROM u""",
)
def normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every conversation as text boxes, grouped by turn, split where their anchors disagree."""
    t = table(spark, sf_dir, "conversations")
    b = t.select(F.col("conv_id").alias("document"), "turn", F.posexplode(F.split("text", "\n", -1)).alias("pos", "text"))
    person = F.char_length("text") % 3
    boxes = b.select(
        "document", F.concat_ws("", F.lit("t"), "turn", F.lit("-"), "pos").alias("id"), F.when(F.col("turn") % 3 > 0, F.concat(F.lit("g"), "turn")).alias("group_id"),
        (F.col("turn") * 100_000 + F.col("pos")).alias("ord"), "text", F.when(person > 0, person).alias("person"), (F.col("pos") % 2 == 0).alias("essential"),
    )
    captions = t.where("turn % 5 = 4 and turn % 3 > 0").select(F.col("conv_id").alias("document"), F.concat(F.lit("g"), "turn").alias("group_id"))
    out, _ = C.normalized(boxes, captions)
    return out.select("document", "id", "group_id", "text", F.array_join("source_text_ids", ",").alias("sources"), "is_essential_text", "reading_order", F.array_join("normalization_reasons", ",").alias("reasons"))


@query(
    "stage10_export",
    oracle="""WITH r AS (SELECT event_id AS id, CASE event_id % 7 WHEN 0 THEN 'sfx' WHEN 1 THEN 'action_state' WHEN 2 THEN 'ui' WHEN 3 THEN 'watermark' ELSE 'dialogue' END AS content_type, CASE WHEN event_id % 11 = 0 THEN 'unknown' ELSE 'plain' END AS style, CASE WHEN event_id % 13 = 0 THEN 'narrator' END AS kind, CASE WHEN value >= 5 AND event_id % 13 > 0 THEN user_id END AS p, CASE WHEN event_id % 3 = 0 THEN user_id END AS a, event_id % 17 = 0 AS unresolved FROM events),
    u AS (SELECT DISTINCT user_id FROM events), c AS (SELECT user_id, CASE WHEN user_id % 10 = 7 THEN user_id - 1 ELSE user_id END AS root FROM u), n AS (SELECT user_id, CASE WHEN user_id % 2 = 0 THEN 'P' || user_id END AS name FROM u),
    j AS (SELECT r.*, coalesce(r.kind, CASE WHEN p IS NULL THEN 'others' ELSE 'person' END) AS k, c.root, n.name, d.root AS ar FROM r LEFT JOIN c ON c.user_id = p LEFT JOIN n ON n.user_id = c.root LEFT JOIN c d ON d.user_id = a)
    SELECT id, content_type, k AS speaker_kind, p AS speaker_person_id, root AS speaker_identity_id, name AS speaker_name, coalesce(p::VARCHAR, k) AS speaker_id, coalesce(name, root::VARCHAR, k) AS speaker_display_label, coalesce(ar::VARCHAR, '') AS addressee_identity_ids,
      CASE WHEN style = 'unknown' OR unresolved THEN 'needs_review' ELSE 'provisional' END AS speech_style_status, CASE WHEN k = 'narrator' THEN 'narrator' WHEN p IS NOT NULL THEN 'character' ELSE 'unknown' END AS voice_type,
      CASE WHEN content_type IN ('sfx', 'action_state') THEN 'effects' WHEN content_type IN ('ui', 'watermark') THEN 'excluded' ELSE 'utterances' END AS route FROM j""",
)
def export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as decided utterances of their users, with identities, labels and routes."""
    e = table(spark, sf_dir, "events")
    k, user = F.col("event_id"), F.col("user_id")
    rows = e.select(
        k.alias("id"), F.when(k % 7 == 0, "sfx").when(k % 7 == 1, "action_state").when(k % 7 == 2, "ui").when(k % 7 == 3, "watermark").otherwise("dialogue").alias("content_type"),
        F.when(k % 11 == 0, "unknown").otherwise("plain").alias("speech_style"), F.when(k % 13 == 0, "narrator").alias("speaker_kind"),
        F.when((F.col("value") >= 5) & (k % 13 > 0), user).alias("speaker_person_id"), F.when(k % 3 == 0, F.array(user)).otherwise(F.array().cast("array<bigint>")).alias("addressee_person_ids"), (k % 17 == 0).alias("unresolved"),
    )
    persons = e.select(user.alias("person_id")).distinct().withColumn("primary_name", F.when(F.col("person_id") % 2 == 0, F.concat(F.lit("P"), "person_id")))
    redirects = persons.where("person_id % 10 = 7").select(F.col("person_id").alias("id"), (F.col("person_id") - 1).alias("to"))
    return C.exported(rows, persons, redirects).withColumn("addressee_identity_ids", F.array_join("addressee_identity_ids", ","))


def _proposals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Utterances, name proposals and groups made of the conversations: the first word of a turn, spelled or extended."""
    t = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("chapter"), F.col("turn").alias("uid"), "text")
    old, second = F.split_part("text", F.lit(" "), F.lit(1)), F.split_part("text", F.lit(" "), F.lit(2))
    k = F.col("uid") % 5
    new = F.when(k == 0, F.upper(old)).when(k == 1, F.concat(old, F.lit(" "), second)).when(k == 2, F.concat(old, F.lit("h"))).when(k == 3, F.lit(" ")).otherwise(old)
    group = F.when(F.col("uid") % 2 == 0, F.concat(F.lit("g"), (F.col("chapter") + F.col("uid")) % 3)).otherwise("none")
    proposals = t.select("chapter", F.col("uid").alias("idx"), "uid", old.alias("old_name"), new.alias("new_name"), group.alias("group_id"))
    groups = t.where("uid % 2 = 0").select("chapter", F.col("uid").alias("idx"), F.concat(F.lit("g"), (F.col("chapter") + F.col("uid")) % 3).alias("group_id"), F.concat(old, F.lit(" "), second).alias("canonical_name"))
    return t, proposals, groups


@query("T5_parse")
def parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name candidates of all chapters after their proposals were applied: where each stands before and after."""
    return N.parsed(*_proposals(spark, sf_dir))[1]


@query("T5_parse_warnings")
def parse_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.parsed(*_proposals(spark, sf_dir))[2]


@query(
    "R5_packed",
    oracle="""WITH v AS (SELECT conv_id, turn, role, length(text) > 300 AS long, split_part(text, '.', 1) AS q FROM conversations),
    a AS (SELECT *, min(turn) OVER (PARTITION BY conv_id, role) AS fr, min(turn) OVER (PARTITION BY conv_id, role, long) AS fd, min(turn) OVER (PARTITION BY conv_id, q) AS fq FROM v)
    SELECT conv_id, turn, 'r' || (dense_rank() OVER (PARTITION BY conv_id ORDER BY fr) - 1) AS role, 'd' || (dense_rank() OVER (PARTITION BY conv_id ORDER BY fd) - 1) AS profile, 'q' || (dense_rank() OVER (PARTITION BY conv_id ORDER BY fq) - 1) AS opening FROM a""",
)
def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles, profiles and prose of every conversation as tokens of its codebooks, numbered by first occurrence."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("said"), (F.char_length("text") > 300).alias("is_long"), F.split_part("text", F.lit("."), F.lit(1)).alias("first"))
    rows, _ = C.packed(t, "conv_id", ["turn"], {"role": ("r", F.col("said")), "profile": ("d", F.struct("said", "is_long")), "opening": ("q", F.col("first"))})
    return rows.select("conv_id", "turn", "role", "profile", "opening")


@query("R5_round_trip", oracle="SELECT conv_id, turn, role, length(text) > 300 AS long, split_part(text, '.', 1) AS opening FROM conversations")
def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed conversations and back."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("said"), (F.char_length("text") > 300).alias("is_long"), F.split_part("text", F.lit("."), F.lit(1)).alias("first"))
    rows, books = C.packed(t, "conv_id", ["turn"], {"profile": ("d", F.struct("said", "is_long")), "opening": ("q", F.col("first"))})
    back = C.unpacked(rows.select("conv_id", "turn", "profile", "opening"), books, "conv_id", {"profile": "struct<said:string,is_long:boolean>", "opening": "string"})
    return back.select("conv_id", "turn", F.col("profile.said").alias("role"), F.col("profile.is_long").alias("long"), "opening")


@query("P26_disk", oracle="SELECT r_regionkey AS radius, dy::INT AS dy, dx::INT AS dx FROM region, range(-r_regionkey, r_regionkey + 1) a(dy), range(-r_regionkey, r_regionkey + 1) b(dx) WHERE dx * dx + dy * dy <= r_regionkey * r_regionkey")
def disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of a disk of every radius in the table, as the mask operators take it."""
    from inkspring.operators import masks as M

    cells = F.udtf(type("Cells", (), {"eval": lambda self, radius: (((int(y) - radius), (int(x) - radius)) for y, x in zip(*M.disk(radius).nonzero(), strict=True))}), returnType="dy int, dx int")
    spark.udtf.register("cells_of_disk", cells)
    table(spark, sf_dir, "region").createOrReplaceTempView("_radii")
    return spark.sql("SELECT r_regionkey AS radius, dy, dx FROM _radii, LATERAL cells_of_disk(r_regionkey)")


@query("G4_redirects", oracle="SELECT c_custkey AS id, CASE c_custkey % 10 WHEN 7 THEN c_custkey - 2 WHEN 6 THEN c_custkey - 1 ELSE c_custkey END AS root FROM customer")
def redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons that were merged into others, twice in a row for some, under their last id."""
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return G.resolved(ids, ids.where("id % 10 in (6, 7)").select("id", (F.col("id") - 1).alias("to")))


@query("S7_read_mask", oracle="SELECT conv_id, turn, length(text) > 200 AS wrong_size, turn % 7 = 3 AS changed FROM conversations")
def read_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored bytes checked against their recorded digest and size before they are read."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.encode("text", "UTF-8").alias("content"), F.char_length("text").alias("cells"))
    digest = F.sha2(F.when(F.col("turn") % 7 == 3, F.concat("content", F.lit(b"x"))).otherwise(F.col("content")), 256)
    return t.select("conv_id", "turn", (F.col("cells") > 200).alias("wrong_size"), (F.sha2("content", 256) != digest).alias("changed"))


@query("stage12_partition", oracle="""WITH t AS (SELECT DISTINCT conv_id, turn FROM conversations), r AS (SELECT * FROM t WHERE turn % 7 <> 3), b AS (SELECT conv_id, turn, turn // 4 AS batch, -turn AS pos FROM t WHERE turn % 5 <> 4),
j AS (SELECT conv_id, batch, string_agg(turn::VARCHAR, ',' ORDER BY pos) AS targets FROM b JOIN r USING (conv_id, turn) GROUP BY 1, 2),
x AS (SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 3 AS k FROM r WHERE turn % 5 = 4)
SELECT conv_id AS document, 'natural:' || batch AS job, targets, 'scene ' || batch % 2 AS scene, 'about ' || batch AS summary FROM j
UNION ALL SELECT conv_id, 'natural:additional:' || (k + 1), string_agg(turn::VARCHAR, ',' ORDER BY turn), NULL, '' FROM x GROUP BY conv_id, k""")
def stage12_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translation jobs of every conversation: analysed batches of four turns with their scene, then the turns of no batch."""
    t = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("document"), F.col("turn").alias("id")).distinct()
    batch = F.expr("id div 4")
    batches = t.where("id % 5 <> 4").select("document", batch.alias("batch"), (-F.col("id")).alias("pos"), "id", F.concat(F.lit("scene "), (batch % 2).cast("string")).alias("scene"), F.concat(F.lit("about "), batch.cast("string")).alias("summary"))
    jobs, _ = C.translation_jobs(t.where("id % 7 <> 3").withColumn("ord", F.col("id")), batches, 3)
    return jobs.select("document", "job", F.array_join(F.transform("targets", lambda i: i.cast("string")), ",").alias("targets"), "scene", "summary")
