"""Text expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze(c: str | Column) -> Column:
    """White space runs (Unicode) become one space, ends trimmed; null stays null."""
    return F.btrim(F.regexp_replace(c, r"(?U)\s+", " "))


@F.pandas_udf(StringType())
def folded(s: pd.Series) -> pd.Series:
    """NFC and full case folding, which no built-in has."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x).casefold())


def valid_score(c: str | Column) -> Column:
    """A finite number from 0 to 10."""
    return F.coalesce(~F.isnan(_c(c)) & _c(c).between(0, 10), F.lit(False))


def short_title(c: str | Column, words: int = 4) -> Column:
    return F.array_join(F.slice(F.split(squeeze(c), " "), 1, words), " ")


# What is stripped from the ends of a noise key.
KEY_ENDS = " .!?…"


def noise_key(c: str | Column) -> Column:
    return F.btrim(folded(squeeze(c)), F.lit(KEY_ENDS))


# Honorifics, and bases that are no names.
HONORIFICS = "san|kun|chan|sama|sensei|senpai|kohai|dono|tan"
SENTINELS = ["other", "others", "unknown", "san", "kun", "chan"]


def name_form(form: str) -> list[Column]:
    """surface, base, honorific and kind of a squeezed and folded name form; all null for a sentinel or an empty base."""
    pattern = rf"^(.+?)\s*[-–—]\s*({HONORIFICS})$"
    c = F.col(form)
    title = F.nullif(F.regexp_extract(c, pattern, 2), F.lit(""))
    base = F.when(title.isNotNull(), F.btrim(F.regexp_extract(c, pattern, 1))).otherwise(c)
    good = (base != "") & ~base.isin(*SENTINELS)
    return [
        F.when(good, F.concat_ws("-", base, title)).alias("surface"), F.when(good, base).alias("base"), F.when(good, title).alias("honorific"),
        F.when(good, F.when(title.isNotNull(), "address_form").otherwise("name")).alias("kind"),
    ]


# The noise rules every chapter starts with.
NOISE_RULES = {
    "keep": [],
    "sfx": ["clench", "grit", "gritting teeth", "whoosh", "swish", "swoosh", "klink"],
    "watermark": ["allmanga"],
    "ui": [
        "load more comments", "sign in to comment", "log in to comment", "report this comment", "next chapter", "previous chapter",
        "sort by newest", "sort by oldest", "sort by top",
    ],
}


def decide(t: Column, key: Column, keep: Column, drop: Column) -> Column:
    """Noise decision of a squeezed box as struct(action, kind, reason); the first rule that fits wins.

    ``keep``: whether the key is in the keep list; ``drop``: the first category whose list holds the key, or null.
    """
    said = lambda a, k, r: F.struct(F.lit(a).alias("action"), F.lit(k).cast("string").alias("kind"), F.lit(r).cast("string").alias("reason"))
    doubt = said("review", None, "possible_noise_requires_review")
    return (
        F.when(keep, said("keep", None, "noise_keep_exception"))
        .when(t == "", said("exclude", "unknown", "empty_ocr"))
        .when(key == "", doubt)
        .when(drop.isNotNull(), F.struct(F.lit("exclude").alias("action"), drop.alias("kind"), F.concat(F.lit("whole_box_"), drop).alias("reason")))
        .when(key.rlike("^ha+h{2,}$"), said("exclude", "sfx", "whole_box_breath_sound"))
        .when(key.rlike(r"^(?:scanlated by|scanlation credits)\s+.+$"), said("exclude", "watermark", "whole_box_credit"))
        .when(key.rlike(r"^read more at\s+(?:(?:https?://|www\.)\S+|[a-z0-9][a-z0-9.-]+\.[a-z]{2,}(?:/\S*)?)$"), said("exclude", "watermark", "whole_box_credit_url"))
        .when(key.rlike(r"^read more at\s+.+$"), said("review", None, "possible_credit_requires_review"))
        .when(t.rlike(r"^[^\p{L}\p{N}]+$") | key.rlike(r"([a-z])\1{5,}") | key.rlike(r"^\S*(?:https?://|www\.)\S+$"), doubt)
        .otherwise(said("keep", None, None))
    )


def fingerprint(*cols: str) -> Column:
    """sha256 of canonical JSON: keys sorted, no spaces."""
    return F.sha2(F.to_json(F.struct(*sorted(cols))), 256)


def pair_key(a: str | Column, b: str | Column) -> Column:
    """Hash of an unordered pair."""
    return F.sha2(F.concat_ws(":", F.least(_c(a), _c(b)), F.greatest(_c(a), _c(b))), 256)


# Terms of address that need no name.
PRONOUNS = [
    "tôi", "tớ", "mình", "tao", "ta", "con", "cháu", "em", "anh", "chị", "cô", "chú", "bác", "ông", "bà", "thầy", "cậu", "bạn", "mày", "ngài", "quý vị", "mọi người",
    "chúng tôi", "chúng ta", "chúng mình", "tụi mình", "các bạn", "các cậu", "unknown", "mẹ", "bố", "ba", "má", "cha", "tía", "u", "bu", "cụ", "dì", "dượng", "mợ", "thím",
    "sếp", "thầy giáo", "cô giáo", "ông nội", "bà nội", "ông ngoại", "bà ngoại", "anh trai", "chị gái", "em trai", "em gái", "các em", "các anh", "các chị", "các cô",
    "các chú", "các con", "mấy đứa", "chúng con", "chúng cháu", "tụi em", "bọn em", "bọn tôi", "chúng tớ", "bọn tớ", "tụi tớ", "bọn tao", "tụi tao", "chúng mày",
    "các người", "nhà ngươi", "ngươi", "quý ngài", "các vị", "các ông", "các bà", "đàn anh", "đàn chị", "tiền bối", "hậu bối",
]
#: A term of address in front of a name, the longest first.
PRONOUN_FIRST = "^(?:" + "|".join(sorted(PRONOUNS, key=lambda p: (-len(p), p))) + ") "


def valid_address(df: DataFrame, term: str, names: str) -> DataFrame:
    """``df`` with valid: the term is a pronoun, or a name of ``names`` (an array) behind at most one pronoun.

    Names are compared by the base of their form, so honorifics do not matter; a sentinel is no name.
    """
    form = lambda c: folded(squeeze(c))
    rows = df.withColumn("_form", form(F.regexp_replace(F.btrim(term), "(?iu)" + PRONOUN_FIRST, "")))
    rows = rows.withColumn("_base", name_form("_form")[1]).withColumn("_names", _folded_all(names))
    bases = F.transform("_names", lambda n: F.regexp_replace(n, rf"^(.+?)\s*[-–—]\s*(?:{HONORIFICS})$", "$1"))
    known = F.exists(bases, lambda b: (b == F.col("_base")) & (b != "") & ~b.isin(*SENTINELS))
    return rows.withColumn("valid", F.coalesce(folded(F.col(term)).isin(*PRONOUNS) | known, F.lit(False))).drop("_form", "_base", "_names")


@F.pandas_udf(ArrayType(StringType()))
def _folded_all(s: pd.Series) -> pd.Series:
    return s.map(lambda ns: [] if ns is None else [" ".join(unicodedata.normalize("NFC", n).casefold().split()) for n in ns if n])


def translation_issues(text: Column, translation: Column, needs_review: Column, reason: Column, proposals: Column, glossary: list[tuple[str, str]]) -> Column:
    """Codes of what is wrong with a translation, in a fixed order.

    ``proposals`` is an array of struct(source, vi), null if it could not be read. A null flag or reason is invalid.
    """
    low = F.lower(translation)
    titles = F.filter(F.regexp_extract_all(text, F.lit(r"(?i)-(?:san|kun|chan)(?![\p{L}\p{N}_])"), F.lit(0)), lambda x: ~F.contains(low, F.lower(x)))
    terms = [
        F.when(text.rlike(rf"(?iu)(?<![\p{{L}}\p{{N}}_])\Q{a}\E(?![\p{{L}}\p{{N}}_])") & ~F.contains(low, F.lit(b.lower())), F.lit(f"missing_glossary_term:{a}")) for a, b in glossary
    ]
    bad = proposals.isNull() | (F.size(proposals) > 3) | F.exists(proposals, lambda p: p["source"].isNull() | p["vi"].isNull())
    one = F.array(
        F.when(needs_review.isNull() | reason.isNull(), "invalid_review_fields").when(needs_review & (F.btrim(reason) == ""), "missing_review_reason"),
        F.when(F.coalesce(bad, F.lit(True)), "invalid_glossary_proposals"),
    )
    every = F.concat(one, F.transform(titles, lambda x: F.concat(F.lit("missing_honorific:"), x)), F.array(*terms).cast("array<string>"))
    return F.when(F.coalesce(F.btrim(translation) == "", F.lit(True)), F.array(F.lit("empty_or_invalid_translation"))).otherwise(F.array_compact(every))


def cell(c: Column) -> Column:
    """A value as a cell of a Markdown table; a dash for none."""
    text = F.regexp_replace(squeeze(c), r"\p{C}", "")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("|", "\\|")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("—"))


def runtime(seconds: Column) -> Column:
    """Seconds as '1.234s', '2m 3s' or '1h 2m 3s'; a dash for none."""
    whole = F.floor(seconds).cast("int")
    minutes = F.floor(seconds / 60).cast("int")
    hours = F.floor(seconds / 3600).cast("int")
    return (
        F.when(seconds.isNull() | (seconds < 0), "-")
        .when(seconds < 60, F.format_string("%.3fs", seconds))
        .when(seconds < 3600, F.format_string("%dm %ds", minutes, whole % 60))
        .otherwise(F.format_string("%dh %dm %ds", hours, minutes % 60, whole % 60))
    )


def unfenced(c: Column) -> Column:
    """The inside of a text that is one fenced block; other texts stay."""
    inside = F.regexp_extract(c, r"(?s)\A\s*```[^\n]*\n(.*?)\n?```\s*\z", 1)
    return F.when(c.rlike(r"(?s)\A\s*```[^\n]*\n.*```\s*\z"), inside).otherwise(c)
