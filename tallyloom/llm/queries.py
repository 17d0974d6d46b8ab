"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm import (
    byte_bpe,
    chat_format,
    fingerprint,
    hard_negatives,
    language_id,
    license_scan,
    mixing,
    near_dedup,
    neighbours,
    spelling,
    substring_dedup,
    url_lists,
    url_rules,
    warc,
)
from tallyloom.llm.tables import table
from tallyloom.sinks.scratch import materialize, new_scratch_path

#: A conversation whose texts are control strings of a chat template.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return chat_format.digests(chat_format.format_conversations(turns.union(control)))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs)


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(
        table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 100 == 0
    )


#: Hosts and path prefixes that a URL is held against first.
SITE_RULES = [
    *url_rules.site_rule("allow", "org", "/"),
    *url_rules.site_rule("block", "example.org", "/es/"),
    *url_rules.site_rule("block", "example.org", "/en/1"),
    *url_rules.site_rule("allow", "com", "/fr/"),
    *url_rules.site_rule("block", "com", "/de/"),
]

def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), SITE_RULES, url_lists.rules())


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.train_network(docs))
    return found.select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sampling_plan(table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    packages = materialize(warc.write_packages(pages, new_scratch_path(spark, "packages")), "packages")
    return warc.read_packages(packages).select(
        warc.key_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.key_of("refers_to").alias("refers_to"),
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(table(spark, sf_dir, "documents"), misspell=31))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_license_scan": op2_license_scan,
    "op3_near_dedup": op3_near_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_fingerprint": op5_fingerprint,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_neighbours": op7_neighbours,
    "op8_url_filter": op8_url_filter,
    "op9_language_id": op9_language_id,
    "op10_mixing": op10_mixing,
    "op11_warc": op11_warc,
    "op12_spelling": op12_spelling,
    "op13_hard_negatives": op13_hard_negatives,
}
