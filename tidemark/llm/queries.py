"""Registered queries of the corpus operators: thin digests of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (bpe, conversation_repair, exact_dedup, language, line_dedup, packing, pii, search, simhash_dedup, substring_dedup,
                          toxicity, treap_search, url_filter)
from tidemark.llm.common import body, read_table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"), over_words=line_dedup.OVER_WORDS)
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(body(), 256).alias("kept_sha256"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op7_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return search.search(docs.where("doc_id % 20 = 0"), docs)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash_dedup.simhash_groups(read_table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(read_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = conversation_repair.repair(conversation_repair.damage(read_table(spark, sf_dir, "conversations")))
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                      F.sha2("repaired", 256).alias("repaired_sha256"))


def op12_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap_search.search(read_table(spark, sf_dir, "benchmark"), read_table(spark, sf_dir, "documents"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filter.judge(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))
    return out.select("page_id", "host", "path", "rule", "verdict")


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_exact_dedup, op3_toxicity, op4_byte_bpe, op5_pii, op6_packing, op7_search, op8_substring_dedup, op9_simhash, op10_language,
                              op11_conversation_repair, op12_treap_search, op13_url_filter)
}
