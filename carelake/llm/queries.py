"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import (credential_links, decontaminate, filter_audit, html_extract, license_scan, line_dedup, mil_classifier, near_dedup, pii_boost,
                          quality_rules, sentencepiece_bpe, treap_search, warc_zip)
from carelake.llm.common import materialize, read_table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    d = line_dedup.dedup(docs)
    return d.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_pii_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = materialize(pii_boost.candidates(read_table(spark, sf_dir, "documents")), "candidates")
    d = pii_boost.find(found, pii_boost.fit(found))
    return d.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                    F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = quality_rules.measure(read_table(spark, sf_dir, "documents"))
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "kept")


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = warc_zip.with_types(read_table(spark, sf_dir, "pages"))
    records = warc_zip.read_archives(warc_zip.write_archives(typed), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = mil_classifier.fit(docs, read_table(spark, sf_dir, "labels"))
    return mil_classifier.score(docs, model)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = sentencepiece_bpe.load_vocabulary(spark)
    return sentencepiece_bpe.encode(read_table(spark, sf_dir, "documents"), vocab)


def op11_credential_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = credential_links.scan(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint")
    return d.select("doc_id", *[count(k).alias(f"n_{k}") for k in credential_links.BASE], F.sha2("base_spans", 256).alias("base_sha256"), "spans",
                    F.size("credentials").cast("bigint").alias("n_credentials"))


def op12_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = treap_search.build(read_table(spark, sf_dir, "documents"))
    return treap_search.search(index, read_table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_license_scan, op2_near_dedup, op3_line_dedup, op4_pii_boost, op5_decontaminate, op6_quality_rules,
                            op7_html_extract, op8_warc_zip, op9_quality_classifier, op10_sentencepiece,
                            op11_credential_links, op12_treap_search, op13_filter_audit)}
