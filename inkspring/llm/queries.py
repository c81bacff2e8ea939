"""Queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from inkspring.llm import decontaminate, filter_audit, fingerprints, hamming, html_text, jaccard, line_dedup, mixing, quality, ranked_search, secrets, sharding, url_filter
from inkspring.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


@_query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op2_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@_query("op3_html_extraction")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@_query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = secrets.train(secrets.labelled_samples(spark))
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents"), model))


@_query("op5_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@_query("op6_jaccard_join", jaccard.ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@_query("op7_hamming_topk", hamming.ORACLE)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.search(table(spark, sf_dir, "embeddings"))


@_query("op8_decontamination", decontaminate.ORACLE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(decontaminate.scan_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@_query("op9_url_filter")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.mine(url_filter.labelled_urls(spark)))


@_query("op10_line_dedup", line_dedup.ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.dedup_lines(table(spark, sf_dir, "documents")))


@_query("op11_filter_audit", filter_audit.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op12_fingerprints")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digest(fingerprints.compare(table(spark, sf_dir, "documents")))


@_query("op13_ranked_search", ranked_search.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
