"""Whole stages of a chapter as dataflow: normalisation of raw text boxes, export of decided rows, packing for transport."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from inkspring.functions.text import squeeze
from inkspring.operators.graph import resolved
from inkspring.operators.sequences import chunked

# Content types that leave the dialogue, and where to.
EFFECTS, EXCLUDED = ["sfx", "action_state"], ["ui", "watermark"]


@F.pandas_udf(StringType())
def composed(s: pd.Series) -> pd.Series:
    """NFC, which no built-in has."""
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def normalized(boxes: DataFrame, captions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(utterances, excluded) of ``boxes(document, id, group_id, ord, text, person, essential)``.

    Texts are composed and squeezed; empty ones are excluded. Boxes of a group are one utterance in reading order, a box
    without group is one by itself. A group in which boxes are anchored to different persons is cut where the person
    changes (boxes without an anchor stay with what stands before them), but for captions: ``captions(document,
    group_id)``. Utterances are numbered by the reading order of their first box. Windows hold one group or document.
    """
    rows = boxes.withColumn("squeezed", F.coalesce(squeeze(composed("text")), F.lit("")))
    empty = rows.where("squeezed = ''").select("document", F.col("id").alias("source_text_id"), F.lit("empty_ocr").alias("reason"))
    kept = rows.where("squeezed <> ''").withColumn("key", F.coalesce("group_id", "id"))
    marked = captions.select("document", F.col("group_id").alias("key"), F.lit(True).alias("caption")).distinct()
    kept = kept.join(marked, ["document", "key"], "left")
    order = W.partitionBy("document", "key").orderBy("ord", "id")
    before = F.last("person", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1))
    kept = kept.withColumn("turn", F.coalesce((before != F.col("person")) & F.col("caption").isNull(), F.lit(False)).cast("int"))
    kept = kept.withColumn("segment", F.sum("turn").over(order)).withColumn("cut", F.max("turn").over(W.partitionBy("document", "key")) > 0)
    box = F.struct("ord", "id", "squeezed", "text", "person")
    per = kept.groupBy("document", "key", "cut", "segment").agg(F.array_sort(F.collect_list(box)).alias("b"), F.max("essential").alias("is_essential_text"), F.first("group_id", ignorenulls=True).alias("group_id"))
    each = lambda c: F.transform("b", lambda x: x[c])
    name = F.concat("key", F.when(F.col("cut"), F.concat(F.lit(":anchor-segment-"), F.col("segment") + 1)).otherwise(""), F.lit(":u"))
    place = F.row_number().over(W.partitionBy("document").orderBy(F.col("b")[0]["ord"], F.col("b")[0]["id"])) - 1
    reason = F.array_compact(F.array(F.when(F.col("group_id").isNotNull(), "physical_group").otherwise("standalone_text"), F.when(F.col("cut"), "split_conflicting_anchors")))
    out = per.select(
        "document", name.alias("id"), "group_id", F.array_join(each("squeezed"), " ").alias("text"), each("text").alias("text_original"), each("id").alias("source_text_ids"),
        "is_essential_text", place.cast("long").alias("reading_order"), reason.alias("normalization_reasons"),
    )
    return out, empty


def exported(rows: DataFrame, persons: DataFrame, redirects: DataFrame) -> DataFrame:
    """Decided rows with identities and the part of the document they go to.

    ``rows(id, content_type, speech_style, speaker_kind, speaker_person_id, addressee_person_ids, unresolved)``,
    ``persons(person_id, primary_name)``, ``redirects(id, to)``. The decided speaker stays; the identity beside it
    follows the redirects. route: effects, excluded or utterances.
    """
    ids = persons.select(F.col("person_id").alias("id"))
    root = resolved(ids, redirects)
    named = root.join(persons.select(F.col("person_id").alias("root"), "primary_name"), "root", "left")
    speaker = named.select(F.col("id").alias("speaker_person_id"), F.col("root").alias("speaker_identity_id"), F.col("primary_name").alias("speaker_name"))
    others = rows.select("id", F.posexplode("addressee_person_ids").alias("k", "p")).join(root.select(F.col("id").alias("p"), "root"), "p", "left")
    others = others.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "root"))), lambda x: x["root"]).alias("addressee_identity_ids"))
    kind = F.coalesce("speaker_kind", F.when(F.col("speaker_person_id").isNotNull(), "person").otherwise("others"))
    out = rows.withColumn("speaker_kind", kind).join(speaker, "speaker_person_id", "left").join(others, "id", "left")
    text = lambda c: F.col(c).cast("string")
    return out.select(
        "id", "content_type", "speaker_kind", "speaker_person_id", "speaker_identity_id", "speaker_name",
        F.coalesce(text("speaker_person_id"), "speaker_kind").alias("speaker_id"),
        F.coalesce("speaker_name", text("speaker_identity_id"), "speaker_kind").alias("speaker_display_label"),
        F.coalesce("addressee_identity_ids", F.array().cast(dict(rows.dtypes)["addressee_person_ids"])).alias("addressee_identity_ids"),
        F.when((F.col("speech_style") == "unknown") | F.col("unresolved"), "needs_review").otherwise("provisional").alias("speech_style_status"),
        F.when(F.col("speaker_kind") == "narrator", "narrator").when(F.col("speaker_person_id").isNotNull(), "character").otherwise("unknown").alias("voice_type"),
        F.when(F.col("content_type").isin(*EFFECTS), "effects").when(F.col("content_type").isin(*EXCLUDED), "excluded").otherwise("utterances").alias("route"),
    )


def interned(rows: DataFrame, scope: str, order: list[str], value: Column, name: str, prefix: str) -> tuple[DataFrame, DataFrame]:
    """(rows with ``name``: a token for ``value``, codebook(scope, name, value)).

    Distinct values of a scope are numbered by first occurrence: prefix 0, 1, 2 ... A null value has no token. A window
    holds the distinct values of one scope, which is one request.
    """
    with_value = rows.withColumn("_v", value)
    first = with_value.where("_v is not null").groupBy(scope, "_v").agg(F.min(F.struct(*order)).alias("_at"))
    number = F.row_number().over(W.partitionBy(scope).orderBy("_at", "_v")) - 1
    book = first.select(scope, F.concat(F.lit(prefix), number).alias(name), "_v")
    return with_value.join(book, [scope, "_v"], "left").drop("_v"), book.select(scope, name, F.col("_v").alias("value"))


def packed(rows: DataFrame, scope: str, order: list[str], fields: dict[str, tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(rows with a token for every field, codebooks(scope, field, token, value as JSON)); ``fields``: name -> (prefix, value)."""
    books = None
    for name, (prefix, value) in fields.items():
        rows, book = interned(rows, scope, order, F.to_json(F.struct(value.alias("v"))), name, prefix)
        book = book.select(scope, F.lit(name).alias("field"), F.col(name).alias("token"), "value")
        books = book if books is None else books.unionByName(book)
    return rows, books


def unpacked(rows: DataFrame, books: DataFrame, scope: str, kinds: dict[str, str]) -> DataFrame:
    """The inverse of ``packed``: tokens become values again; ``kinds``: name -> type."""
    for name, kind in kinds.items():
        own = books.where(F.col("field") == name).select(scope, F.col("token").alias(name), F.from_json("value", f"v {kind}").getField("v").alias("_v"))
        rows = rows.join(own, [scope, name], "left").drop(name).withColumnRenamed("_v", name)
    return rows


def translation_jobs(rows: DataFrame, batches: DataFrame, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """(jobs, issues): who is translated with whom; ``rows(document, id, ord)``, ``batches(document, batch, pos, id, scene, summary)``.

    The live rows of an analysed batch are one job, in the batch's order, with its scene; rows of no batch follow in their
    own order, ``most`` to a job. Issues: ids that a document has twice (``duplicate``), and ids in two batches or twice
    in one (``overlap``); a document with an issue has no jobs, as its rows would be translated twice.
    """
    twice = rows.groupBy("document", "id").agg(F.count("*").alias("_n"))
    live = batches.join(twice.select("document", "id"), ["document", "id"], "left_semi")
    doubled = live.groupBy("document", "id").agg(F.count("*").alias("_n"))
    wrong = lambda df, issue: df.where("_n > 1").select("document", "id", F.lit(issue).alias("issue"))
    issues = wrong(twice, "duplicate").unionByName(wrong(doubled, "overlap"))
    good = lambda df: df.join(issues.select("document").distinct(), "document", "left_anti")
    listed = lambda *by: F.transform(F.array_sort(F.collect_list(F.struct(*by, "id"))), lambda x: x["id"]).alias("targets")
    named = good(live).groupBy("document", "batch").agg(listed("pos"), F.min("scene").alias("scene"), F.min("summary").alias("summary"))
    named = named.select("document", F.concat(F.lit("natural:"), F.col("batch").cast("string")).alias("job"), "targets", F.col("batch").cast("string").alias("batch"), "scene", "summary")
    extra = chunked(good(rows).join(live.select("document", "id"), ["document", "id"], "left_anti"), ["document"], ["ord", "id"], most)
    rest = extra.groupBy("document", "chunk").agg(listed("ord"))
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    return named.unionByName(rest.select("document", F.concat(F.lit("natural:additional:"), (F.col("chunk") + 1).cast("string")).alias("job"), "targets", none("batch", "string"), none("scene", named.schema["scene"].dataType), F.lit("").alias("summary"))), issues
