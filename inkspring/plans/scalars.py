"""Scalar expressions and string operators on conversation turns, documents and line items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspring.functions import text as T
from inkspring.functions import vectors as V
from inkspring.operators import checks
from inkspring.operators import names as N
from inkspring.registry import query, table

#: SQL for white-space normalisation, as functions.text.squeeze.
SQUEEZE = r"trim(regexp_replace({0}, '[\s\x{{00A0}}]+', ' ', 'g'), ' ')"


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


@query("P8_score", oracle="SELECT l_orderkey, l_linenumber, l_quantity / 5 - 1 AS score, (l_quantity / 5 - 1 BETWEEN 0 AND 10) AS ok FROM lineitem")
def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 5 - 1).alias("score"))
    return rows.withColumn("ok", T.valid_score("score"))


@query("P9_short_title", oracle=rf"SELECT conv_id, turn, role, array_to_string(list_slice(string_split({SQUEEZE.format('text')}, ' '), 1, 4), ' ') AS title FROM conversations")
def short_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).select("conv_id", "turn", "role", T.short_title("text").alias("title"))


#: SQL for folding, as functions.text.folded (ß is the only letter of the data that folds to two).
FOLD = "replace(lower(nfc_normalize({0})), 'ß', 'ss')"


@query(
    "P10_name_form",
    oracle=rf"""WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN 'Other' ELSE ' ' || p_name || CASE p_partkey % 4 WHEN 0 THEN '-San' WHEN 1 THEN ' – kun' WHEN 2 THEN '—TAN' ELSE '' END END AS v FROM part),
    f AS (SELECT p_partkey, {FOLD.format(SQUEEZE.format("v"))} AS form FROM s), r AS (SELECT *, nullif(regexp_extract(form, '^(.+?)\s*[-–—]\s*({T.HONORIFICS})$', 2), '') AS h, regexp_extract(form, '^(.+?)\s*[-–—]\s*({T.HONORIFICS})$', 1) AS b FROM f),
    g AS (SELECT p_partkey, h, CASE WHEN h IS NULL THEN form ELSE trim(b) END AS base FROM r)
    SELECT p_partkey, CASE WHEN ok THEN concat_ws('-', base, h) END AS surface, CASE WHEN ok THEN base END AS base, CASE WHEN ok THEN h END AS honorific, CASE WHEN ok THEN CASE WHEN h IS NULL THEN 'name' ELSE 'address_form' END END AS kind
    FROM (SELECT *, base <> '' AND base NOT IN ('other', 'others', 'unknown', 'san', 'kun', 'chan') AS ok FROM g)""",
)
def name_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms of names with honorifics of several spellings; every fiftieth is a sentinel."""
    k = F.col("p_partkey")
    title = F.when(k % 4 == 0, "-San").when(k % 4 == 1, " – kun").when(k % 4 == 2, "—TAN").otherwise("")
    v = F.when(k % 50 == 0, "Other").otherwise(F.concat(F.lit(" "), "p_name", title))
    return table(spark, sf_dir, "part").select("p_partkey", T.folded(T.squeeze(v)).alias("form")).select("p_partkey", *T.name_form("form"))


@query("P11_story_key", oracle=r"SELECT doc_id, trim(regexp_replace(replace(lower(nfc_normalize(text)), 'ß', 'ss'), '[^\p{L}\p{N}_]+', '-', 'g'), '-') AS key FROM documents")
def story_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", _story_key(F.col("text")).alias("key"))


def _story_key(c: Column) -> Column:
    return F.btrim(F.regexp_replace(T.folded(c), r"[^\p{L}\p{N}_]+", "-"), F.lit("-"))


@query("P12_squeeze", oracle=rf"SELECT conv_id, turn, role, {SQUEEZE.format('text')} AS text FROM conversations")
def squeeze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).select("conv_id", "turn", "role", T.squeeze("text").alias("text"))


_LINES = r"lines AS (SELECT doc_id, pos, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents))"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).withColumn("pos", F.col("pos").cast("long"))


@query("P13_noise_key", oracle=rf"WITH {_LINES} SELECT doc_id, pos, trim({FOLD.format(SQUEEZE.format('line'))}, ' .!?…') AS key FROM lines")
def noise_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select("doc_id", "pos", T.noise_key("line").alias("key"))


_REPEATED = "|".join(f"{c}{{6,}}" for c in "abcdefghijklmnopqrstuvwxyz")
_SUPPLIED = {"keep": ["The."], "sfx": ["of", "es", "ER"], "ui": ["en", "er"]}


def _rules_sql(rules: dict[str, list[str]]) -> str:
    rows = ", ".join(f"('{kind}', '{value}', {k})" for k, (kind, values) in enumerate(rules.items()) for value in values)
    return f"(SELECT category, min(ord) AS ord, key FROM (SELECT category, ord, trim({FOLD.format('v')}, ' .!?…') AS key FROM (VALUES {rows}) x(category, v, ord)) GROUP BY category, key)"


@query(
    "P14_decide_noise",
    oracle=rf"""WITH {_LINES}, k AS (SELECT {SQUEEZE.format('line')} AS t, trim({FOLD.format(SQUEEZE.format('line'))}, ' .!?…') AS key FROM lines), rules AS {_rules_sql({c: [*v, *_SUPPLIED.get(c, [])] for c, v in T.NOISE_RULES.items()})},
    j AS (SELECT k.*, key IN (SELECT key FROM rules WHERE category = 'keep') AS keep, d.category AS drop_kind FROM k LEFT JOIN (SELECT key, arg_min(category, ord) AS category FROM rules WHERE category <> 'keep' GROUP BY key) d USING (key)),
    d AS (SELECT CASE WHEN keep THEN 'keep::noise_keep_exception' WHEN t = '' THEN 'exclude:unknown:empty_ocr' WHEN key = '' THEN 'review::possible_noise_requires_review' WHEN drop_kind IS NOT NULL THEN 'exclude:' || drop_kind || ':whole_box_' || drop_kind
      WHEN regexp_matches(key, '^ha+h{{2,}}$') THEN 'exclude:sfx:whole_box_breath_sound' WHEN regexp_matches(key, '^(?:scanlated by|scanlation credits)\s+.+$') THEN 'exclude:watermark:whole_box_credit'
      WHEN regexp_matches(key, '^read more at\s+(?:(?:https?://|www\.)\S+|[a-z0-9][a-z0-9.-]+\.[a-z]{{2,}}(?:/\S*)?)$') THEN 'exclude:watermark:whole_box_credit_url' WHEN regexp_matches(key, '^read more at\s+.+$') THEN 'review::possible_credit_requires_review'
      WHEN regexp_matches(t, '^[^\p{{L}}\p{{N}}]+$') OR regexp_matches(key, '{_REPEATED}') OR regexp_matches(key, '^\S*(?:https?://|www\.)\S+$') THEN 'review::possible_noise_requires_review' ELSE 'keep::' END AS r FROM j)
    SELECT split_part(r, ':', 1) AS action, nullif(split_part(r, ':', 2), '') AS kind, nullif(split_part(r, ':', 3), '') AS reason, count(*) AS n FROM d GROUP BY ALL""",
)
def decide_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The noise rules, defaults and a chapter's own, as one cascade over all lines, counted by action, kind and reason."""
    rows = lines(spark, sf_dir).select(T.squeeze("line").alias("t"), T.noise_key("line").alias("key"))
    return checks.noise(rows, checks.noise_rules(spark, _SUPPLIED)).groupBy("action", "kind", "reason").agg(F.count("*").alias("n"))


def _inserted(short: str, long: str) -> str:
    """SQL: whether leaving out one run of the parts ``long`` gives the parts ``short``, joined."""
    return f"(array_to_string({short}, '') <> '' AND array_to_string({short}, '') <> array_to_string({long}, '') AND list_contains(flatten(list_transform(range(0, len({long})), lambda i: list_transform(range(i + 1, len({long}) + 1), lambda j: array_to_string(list_concat({long}[1:i], {long}[j + 1:len({long})]), '')))), array_to_string({short}, '')))"


@query(
    "P17_scope_change",
    oracle=rf"""WITH w AS (SELECT p_partkey, p_name AS old, CASE p_partkey % 6 WHEN 0 THEN split_part(p_name, ' ', 2) WHEN 1 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) WHEN 2 THEN upper(p_name) || '-san' WHEN 3 THEN replace(p_name, ' ', '-') WHEN 4 THEN replace(p_name, ' ', ' x y ') ELSE p_name || 'x' END AS new FROM part),
    v AS (SELECT *, string_split_regex(lower(old), '[ -]+') AS a, string_split_regex(lower(new), '[ -]+') AS b FROM w)
    SELECT p_partkey, old, new, CASE WHEN {_inserted('a', 'b')} THEN 'name_expansion' WHEN {_inserted('b', 'a')} THEN 'name_shortening' WHEN a <> b AND list_sort(a) = list_sort(b) THEN 'name_reordering' END AS change FROM v""",
)
def scope_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the parts of a name change between two forms: put in, left out, in another order, or only spelled anew (null)."""
    k, first, second = F.col("p_partkey") % 6, F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    space = F.lit(" ")
    new = (
        F.when(k == 0, second).when(k == 1, F.concat(second, space, first)).when(k == 2, F.concat(F.upper("p_name"), F.lit("-san")))
        .when(k == 3, F.replace("p_name", space, F.lit("-"))).when(k == 4, F.replace("p_name", space, F.lit(" x y "))).otherwise(F.concat("p_name", F.lit("x")))
    )
    w = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("old"), new.alias("new"))
    return w.withColumn("change", N.scope("old", "new"))


@query("P20_fingerprint", oracle="""SELECT conv_id, turn, role, sha256('{"conv_id":' || conv_id || ',"role":"' || role || '","turn":' || turn || '}') AS fingerprint FROM conversations""")
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).select("conv_id", "turn", "role", T.fingerprint("turn", "role", "conv_id").alias("fingerprint"))


@query("P21_pair_key", oracle="SELECT o_orderkey, sha256(least(o_custkey, o_orderkey % 1000) || ':' || greatest(o_custkey, o_orderkey % 1000)) AS pair FROM orders")
def pair_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", T.pair_key("o_custkey", F.col("o_orderkey") % 1000).alias("pair"))


@query(
    "P22_valid_address",
    oracle=rf"""WITH t AS (SELECT p_partkey, p_name, p_brand, CASE p_partkey % 6 WHEN 0 THEN 'Anh ' || p_name || '-san' WHEN 1 THEN 'Chúng Tôi' WHEN 2 THEN upper(p_name) WHEN 3 THEN 'bà nội ' || p_brand WHEN 4 THEN 'thầy ' || p_type ELSE 'em unknown' END AS term FROM part),
    f AS (SELECT *, {FOLD.format(SQUEEZE.format("regexp_replace(trim(term), '" + T.PRONOUN_FIRST + "', '', 'i')"))} AS form FROM t),
    b AS (SELECT *, regexp_replace(form, '^(.+?)\s*[-–—]\s*(?:{T.HONORIFICS})$', '\1') AS base FROM f)
    SELECT p_partkey, term, lower(term) IN ({", ".join(f"'{p}'" for p in T.PRONOUNS)}) OR (base NOT IN ('', 'other', 'others', 'unknown', 'san', 'kun', 'chan') AND base IN (lower(p_name), lower(p_brand))) AS valid FROM b""",
)
def valid_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of address of several kinds, against a name and an alias."""
    k, lit = F.col("p_partkey") % 6, F.lit
    term = (
        F.when(k == 0, F.concat(lit("Anh "), "p_name", lit("-san"))).when(k == 1, "Chúng Tôi").when(k == 2, F.upper("p_name"))
        .when(k == 3, F.concat(lit("bà nội "), "p_brand")).when(k == 4, F.concat(lit("thầy "), "p_type")).otherwise("em unknown")
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", term.alias("term"), F.array("p_name", "p_brand").alias("names"))
    return T.valid_address(rows, "term", "names").select("p_partkey", "term", "valid")


@query("P23_protected_terms", oracle=r"""SELECT conv_id, turn, role, coalesce(array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '\d+') || regexp_extract_all(text, '[Tt]h[a-z]+ing'), lambda x: lower(x)))), ','), '') AS terms FROM conversations""")
def protected_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and glossary hits of a turn, distinct and sorted."""
    found = F.concat(F.regexp_extract_all("text", F.lit(r"\d+"), F.lit(0)), F.regexp_extract_all("text", F.lit("[Tt]h[a-z]+ing"), F.lit(0)))
    return turns(spark, sf_dir).select("conv_id", "turn", "role", F.array_join(F.array_sort(F.array_distinct(F.transform(found, F.lower))), ",").alias("terms"))


_GLOSSARY = [("the", "ze"), ("nicht", "nix")]


@query(
    "P24_translation_issues",
    oracle=r"""WITH t AS (SELECT conv_id, turn, role, text || CASE WHEN turn % 3 = 0 THEN ' Toru-San, Yuki-chan!' ELSE '' END AS target, CASE WHEN turn % 5 = 4 THEN '  ' ELSE CASE WHEN turn % 2 = 0 THEN 'Ze ' ELSE '' END || 'Toru-san' || role END AS said, turn % 4 = 1 AS review, CASE WHEN turn % 8 = 1 THEN 'unclear' ELSE ' ' END AS why, (turn % 6)::INT AS n FROM conversations)
    SELECT conv_id, turn, role, CASE WHEN trim(said) = '' THEN 'empty_or_invalid_translation' ELSE coalesce(array_to_string(
      list_concat([CASE WHEN review AND trim(why) = '' THEN 'missing_review_reason' END, CASE WHEN n > 3 THEN 'invalid_glossary_proposals' END],
      list_transform(list_filter(regexp_extract_all(target, '(?i)-(?:san|kun|chan)\b'), lambda x: NOT contains(lower(said), lower(x))), lambda x: 'missing_honorific:' || x),
      [CASE WHEN regexp_matches(lower(target), '(^|[^\p{L}\p{N}_])the([^\p{L}\p{N}_]|$)') AND NOT contains(lower(said), 'ze') THEN 'missing_glossary_term:the' END, CASE WHEN regexp_matches(lower(target), '(^|[^\p{L}\p{N}_])nicht([^\p{L}\p{N}_]|$)') AND NOT contains(lower(said), 'nix') THEN 'missing_glossary_term:nicht' END]), ','), '') END AS issues FROM t""",
)
def translation_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of stand-in translations: lost honorifics and glossary terms, reviews without reason, too many proposals."""
    k = F.col("turn")
    t = turns(spark, sf_dir).select(
        "conv_id", "turn", "role",
        F.concat("text", F.when(k % 3 == 0, " Toru-San, Yuki-chan!").otherwise("")).alias("target"),
        F.when(k % 5 == 4, "  ").otherwise(F.concat(F.when(k % 2 == 0, "Ze ").otherwise(""), F.lit("Toru-san"), "role")).alias("said"),
        (k % 4 == 1).alias("review"), F.when(k % 8 == 1, "unclear").otherwise(" ").alias("why"),
        F.array_repeat(F.struct(F.lit("a").alias("source"), F.lit("b").alias("vi")), (k % 6).cast("int")).alias("proposals"),
    )
    issues = T.translation_issues(*map(F.col, ("target", "said", "review", "why", "proposals")), _GLOSSARY)
    return t.select("conv_id", "turn", "role", F.array_join(issues, ",").alias("issues"))


@query("P25_shortening", oracle=r"""WITH s AS (SELECT conv_id, turn, role, text, substring(text, 1, 80) AS short FROM conversations)
SELECT conv_id, turn, role, (length(short) < length(text) AND len(list_filter(regexp_extract_all(text, '\d+'), lambda x: NOT contains(short, x))) = 0 AND (regexp_matches(text, '\b(not|nicht|pas|no)\b') = regexp_matches(short, '\b(not|nicht|pas|no)\b'))) AS ok FROM s""")
def shortening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shorter text is acceptable if it keeps every number and the negation."""
    s = turns(spark, sf_dir).withColumn("short", F.substring("text", 1, 80))
    no = lambda c: F.rlike(c, F.lit(r"(?<![A-Za-z0-9_])(not|nicht|pas|no)(?![A-Za-z0-9_])"))
    kept = F.forall(F.regexp_extract_all("text", F.lit(r"\d+"), F.lit(0)), lambda x: F.contains(F.col("short"), x))
    return s.select("conv_id", "turn", "role", ((F.char_length("short") < F.char_length("text")) & kept & (no("text") == no("short"))).alias("ok"))


@query("P27_input_estimate", oracle="SELECT conv_id, (sum(CAST(ceil(strlen(text) / 2.0) AS BIGINT)) + 512)::BIGINT AS tokens FROM conversations GROUP BY conv_id")
def input_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bytes a token, rounded up per part, plus a reserve."""
    return turns(spark, sf_dir).groupBy("conv_id").agg((F.sum(F.ceil(F.octet_length("text") / 2)) + 512).alias("tokens"))


@query("P28_request_policy", oracle="SELECT event_id, CASE WHEN starts_with(event_type, 'e') THEN 8192 WHEN starts_with(event_type, 'p') THEN 4096 ELSE 2048 END AS context, CASE WHEN event_type = 'error' THEN 600 ELSE 120 END AS timeout FROM events")
def request_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_type")
    return table(spark, sf_dir, "events").select("event_id", F.when(F.startswith(e, F.lit("e")), 8192).when(F.startswith(e, F.lit("p")), 4096).otherwise(2048).alias("context"), F.when(e == "error", 600).otherwise(120).alias("timeout"))


@query("P29_projection", oracle="SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("P31_oom_and_scrub", oracle="SELECT doc_id, regexp_matches(text, 'out of memory|oom|heean') AS oom, regexp_replace(text, '[<>|{}\"]', '', 'g') AS safe FROM documents")
def oom_and_scrub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.rlike("text", F.lit("out of memory|oom|heean")).alias("oom"), F.regexp_replace("text", '[<>|{}"]', "").alias("safe"))


@query(
    "P32_classify_shape",
    oracle="""SELECT l_orderkey, l_linenumber, CASE WHEN l_tax * 10 >= 0.7 THEN 'rectangular' WHEN l_quantity >= 40 AND l_discount < 0.03 THEN 'spiky' WHEN l_discount >= 0.08 THEN 'rounded' WHEN l_quantity < 10 THEN 'cloud' ELSE 'irregular' END AS shape,
    CASE WHEN l_returnflag = 'R' THEN 'dashed' ELSE 'solid' END AS border FROM lineitem""",
)
def classify_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule layer of shape classification over measured features."""
    tax, qty, disc = F.col("l_tax"), F.col("l_quantity"), F.col("l_discount")
    shape = F.when(tax * 10 >= 0.7, "rectangular").when((qty >= 40) & (disc < 0.03), "spiky").when(disc >= 0.08, "rounded").when(qty < 10, "cloud").otherwise("irregular")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", shape.alias("shape"), F.when(F.col("l_returnflag") == "R", "dashed").otherwise("solid").alias("border"))


@query("P33_conclude", oracle="SELECT conv_id, turn, role, CASE WHEN role IN ('user', 'assistant') AND length(text) <= 120 THEN role ELSE 'unknown' END AS label FROM conversations")
def conclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).select("conv_id", "turn", "role", F.when(F.col("role").isin("user", "assistant") & (F.char_length("text") <= 120), F.col("role")).otherwise("unknown").alias("label"))


@query("T7_folding", oracle="SELECT doc_id, replace(lower(nfc_normalize(text)), 'ß', 'ss') AS folded, lower(text) AS low FROM documents")
def folding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.folded("text").alias("folded"), F.lower("text").alias("low"))


@query("T8_regex_suite", oracle=r"SELECT doc_id, len(regexp_extract_all(text, '[A-Z][a-z]+')) AS found, regexp_full_match(text, '[\s\S]*\.') AS ends, length(regexp_replace(text, '[aeiou]', '', 'g')) AS consonants FROM documents")
def regex_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.size(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0))).cast("long").alias("found"), F.rlike("text", F.lit(r"\A[\s\S]*\.\z")).alias("ends"), F.char_length(F.regexp_replace("text", "[aeiou]", "")).cast("long").alias("consonants"))


@query("T9_negation", oracle=r"SELECT conv_id, turn, role, regexp_matches(lower(text), '(^|[^a-z])(not|nicht|pas|no|ne)([^a-z]|$)') AS negated FROM conversations")
def negation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).select("conv_id", "turn", "role", F.rlike(F.lower("text"), F.lit("(^|[^a-z])(not|nicht|pas|no|ne)([^a-z]|$)")).alias("negated"))


@query("T11_id_prefix", oracle="SELECT c_custkey, string_split(c_name || ':c' || c_nationkey, ':c')[1] AS prefix FROM customer")
def id_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.substring_index(F.concat("c_name", F.lit(":c"), "c_nationkey"), ":c", 1).alias("prefix"))


@query("T12_cell_escape", oracle=r"SELECT doc_id, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '|', '\|'), chr(10), ' ') AS cell FROM documents")
def cell_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", _cell(F.col("text")).alias("cell"))


def _cell(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), ("|", "\\|"), ("\n", " ")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


@query("D1_timestamps", oracle="SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%Y%m%d-%H%M%S') AS run_id FROM events")
def timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), F.date_format("ts", "yyyyMMdd-HHmmss").alias("run_id"))


@query("D2_elapsed", oracle="SELECT user_id, round(sum(value), 6) AS elapsed, count(*) AS attempts FROM events WHERE event_type IN ('click', 'view') GROUP BY user_id")
def elapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds summed over attempts."""
    return table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view")).groupBy("user_id").agg(F.round(F.sum("value"), 6).alias("elapsed"), F.count("*").alias("attempts"))


_HALF = "0.5::FLOAT"


@query("M1_vector_norms", oracle="SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm, (list_position(embedding, list_max(embedding)) - 1)::BIGINT AS argmax FROM embeddings")
def vector_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(V.norm("embedding"), 6).alias("norm"), (F.array_position("embedding", F.array_max("embedding")) - 1).alias("argmax"))


@query("M2_cosine_from_distance", oracle="""WITH a AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) SELECT x.vec_id, round(1 - list_distance(x.e, y.e) * list_distance(x.e, y.e) / 2, 5) AS cosine FROM a x JOIN a y ON y.vec_id = x.vec_id + 1""")
def cosine_from_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    d = V.distance("embedding", "b")
    return e.join(after, "vec_id").select("vec_id", F.round(1 - d * d / 2, 5).alias("cosine"))


@query("M3_rounding", oracle="SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS half_even, round(sqrt(l_quantity * l_quantity + l_linenumber * l_linenumber), 6) AS hyp, greatest(8, least(40, floor(l_extendedprice / 1000)::INT)) AS clamped FROM lineitem")
def rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.bround(F.col("l_quantity") / 2, 0).alias("half_even"), F.round(F.hypot("l_quantity", "l_linenumber"), 6).alias("hyp"), F.greatest(F.lit(8), F.least(F.lit(40), F.floor(F.col("l_extendedprice") / 1000).cast("int"))).alias("clamped"))


@query("A9_normalized", oracle="""WITH n AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n FROM embeddings)
SELECT vec_id, unnest(range(len(embedding)))::INT AS pos, round(unnest(embedding)::DOUBLE / n, 6) AS v FROM n WHERE n > 0""")
def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", V.normalized("embedding").alias("e")).where("e is not null")
    return e.select("vec_id", F.posexplode("e").alias("pos", "v")).withColumn("v", F.round("v", 6))


@query("X12_runtime_text", oracle="""SELECT event_id, CASE WHEN value < 0 OR value IS NULL THEN '-' WHEN value * 100 < 60 THEN printf('%.3fs', value * 100) WHEN value * 100 < 3600 THEN printf('%dm %ds', floor(value * 100 / 60)::INT, floor(value * 100)::INT % 60)
ELSE printf('%dh %dm %ds', floor(value * 100 / 3600)::INT, floor(value * 100 / 60)::INT % 60, floor(value * 100)::INT % 60) END AS runtime FROM events""")
def runtime_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", T.runtime(F.col("value") * 100).alias("runtime"))


@query("X13_reference", oracle="SELECT conv_id, turn, role, printf('P%02d/T%02d', conv_id, turn) AS ref FROM conversations")
def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    ident = F.concat_ws(":", F.concat(F.lit("p"), "conv_id"), F.concat(F.lit("t"), "turn"))
    page, text = F.regexp_extract(ident, r"p(\d+)", 1).cast("int"), F.regexp_extract(ident, r"t(\d+)", 1).cast("int")
    return turns(spark, sf_dir).select("conv_id", "turn", "role", F.format_string("P%02d/T%02d", page, text).alias("ref"))


@query(
    "X14_cell",
    oracle=rf"""WITH v AS (SELECT conv_id, turn, role, CASE turn % 4 WHEN 3 THEN NULL WHEN 2 THEN ' <b>a|b</b>' || chr(9) || '& ' || text ELSE text END AS v FROM conversations)
    SELECT conv_id, turn, role, coalesce(nullif(replace(replace(replace(replace({SQUEEZE.format('v')}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '|', '\|'), ''), '—') AS cell FROM v""",
)
def cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("turn") % 4
    v = F.when(k == 3, F.lit(None)).when(k == 2, F.concat(F.lit(" <b>a|b</b>\t& "), "text")).otherwise(F.col("text"))
    return turns(spark, sf_dir).select("conv_id", "turn", "role", T.cell(v).alias("cell"))


@query("X15_fence", oracle=rf"SELECT conv_id, turn, role, {SQUEEZE.format('text')} AS text FROM conversations")
def fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wholly fenced answer loses its fence."""
    fenced = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("```text\n"), "text", F.lit("\n```"))).otherwise(F.col("text"))
    return turns(spark, sf_dir).select("conv_id", "turn", "role", T.squeeze(T.unfenced(fenced)).alias("text"))


@query("X16_token_length", oracle="SELECT doc_id, CASE WHEN contains(text, '.') THEN strpos(text, '.') - 1 ELSE length(text) END AS n, NOT contains(text, '.') AS truncated, starts_with(text, '.') AS empty FROM documents")
def token_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of a whole text up to its end mark, and whether the mark is missing or first."""
    p = F.instr("text", F.lit("."))
    return table(spark, sf_dir, "documents").select("doc_id", F.when(p > 0, p - 1).otherwise(F.char_length("text")).cast("long").alias("n"), (p == 0).alias("truncated"), (p == 1).alias("empty"))
