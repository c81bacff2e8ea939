"""File sources and sinks: page folders, JSON documents, transcripts, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkspring.operators.sequences import natural_key

#: Suffixes of page images.
IMAGES = ("avif", "bmp", "gif", "jpeg", "jpg", "png", "tiff", "webp")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """path, name, ordinal, sha256 of the images of a folder in natural order; an empty folder gives no rows.

    Ordinals number the pages of one chapter, so their window holds one folder.
    """
    files = spark.read.format("binaryFile").load(folder).where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*IMAGES))
    rows = files.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder"), F.sha2("content", 256).alias("sha256"))
    return rows.withColumn("ordinal", F.row_number().over(W.partitionBy("folder").orderBy(natural_key("name"), "name")) - 1).drop("folder")


def json_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Whole-file JSON documents with a declared schema; a byte order mark is skipped, bad files are kept aside in _bad."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"\A\x{FEFF}", "").alias("value"))
    parsed = text.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("d"))
    return parsed.select("d.*", F.when(F.col("d").isNull(), F.col("value")).alias("_bad"))


def utterances(documents: DataFrame, key: str) -> DataFrame:
    """key, reading_order, text from documents with ``utterances`` or ``dialogues``; array order is reading order."""
    return documents.select(key, F.posexplode(F.coalesce("utterances", "dialogues")).alias("reading_order", "u")).select(key, "reading_order", "u.text")


def transcript(rows: DataFrame) -> DataFrame:
    """One text a page: a page mark, then '<speaker>: text' for essential lines, from (page, ord, speaker, text, essential)."""
    line = F.format_string("<%s>: %s", F.coalesce("speaker", F.lit("Other")), F.col("text"))
    kept = rows.where("essential").groupBy("page").agg(F.array_sort(F.collect_list(F.struct("ord", line.alias("line")))).alias("l"))
    return kept.select("page", F.concat(F.format_string("--- Page %d ---\n", "page"), F.array_join(F.transform("l", lambda x: x["line"]), "\n")).alias("value"))


def pages_of_transcript(lines: DataFrame) -> DataFrame:
    """page, line of a numbered transcript (pos, line): lines under odd page marks, pages renumbered from 1.

    The running page number is one sequence per transcript, which is one chapter.
    """
    mark = F.regexp_extract("line", r"^--- Page (\d+) ---$", 1)
    w = W.partitionBy("doc").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    numbered = lines.withColumn("page", F.last(F.when(mark != "", mark.cast("int")), ignorenulls=True).over(w))
    return numbered.where((mark == "") & (F.col("page") % 2 == 1)).select("doc", ((F.col("page") + 1) / 2).cast("int").alias("page"), "pos", "line")


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)
