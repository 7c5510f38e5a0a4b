"""Registered queries of the text operators, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tradeloom.llm.arc_to_warc import pages_through_archives
from tradeloom.llm.common import read_table
from tradeloom.llm.direct_codes import tokens_on_disk
from tradeloom.llm.factor_machine import ACCEPT, is_held_out, score, train
from tradeloom.llm.host_rules import judge
from tradeloom.llm import log_bilinear
from tradeloom.llm.link_trust import Rule, judge_urls
from tradeloom.llm.oracle import archives_sql, host_rules_sql, lexical_search_sql, link_trust_sql
from tradeloom.llm.pivotal import mix
from tradeloom.llm.prefix_counts import prefix_tables
from tradeloom.llm.qgram_filter import find_passages
from tradeloom.llm.simhash_pivots import near_duplicates
from tradeloom.llm.site_templates import extract
from tradeloom.llm.term_tree import search
from tradeloom.llm.turn_repair import damaged, digests, repair, turns_of

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def op1_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(read_table(spark, sf_dir, "pages"))
    n_chars = F.char_length("text").cast("long").alias("n_chars")
    return found.select(F.col("id").alias("page_id"), "url", "text", n_chars)


# Fixed values of the query.
RULES = [
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
]


def op2_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge_urls(read_table(spark, sf_dir, "pages"), RULES)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op3_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages_through_archives(read_table(spark, sf_dir, "pages"))
    columns = ["payload_bytes", "payload_digest", "record_type", "refers_to"]
    return found.select(F.col("id").alias("page_id"), *columns)


def op4_factor_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, read_table(spark, sf_dir, "labels")))
    return scored.select(
        F.col("id").alias("doc_id"),
        is_held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(read_table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(F.col("id").alias("doc_id"), *counts, "base_failed", "kept")


def op6_qgram_lemma(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_passages(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        (F.size("regions") > 0).alias("contaminated"),
        (F.size("regions") == 0).alias("kept"),
        F.sort_array(F.array_distinct("regions.item_id")).alias("item_ids"),
        F.size("regions").alias("n_regions"),
        F.array_min("regions.edits").alias("fewest_edits"),
    )


def op7_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prefix_tables(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def op8_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokens_on_disk(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return found.withColumnRenamed("id", "doc_id")


def op9_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(read_table(spark, sf_dir, "documents"))
    row = F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))
    return found.select(
        F.col("id").alias("doc_id"),
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
        row.alias("row"),
    ).drop("row")


def op10_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op11_term_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op12_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_bilinear.score(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turns_of(read_table(spark, sf_dir, "conversations"))
    found = repair(damaged(turns))
    key = ["none", "conv"]
    rows = turns.select(*key).distinct().join(found.conversations, key, "left").join(digests(found.rows), key, "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return rows.select(
        F.when(~F.col("none"), F.col("conv")).alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_site_templates": op1_site_templates,
    "op2_link_trust": op2_link_trust,
    "op3_arc_to_warc": op3_arc_to_warc,
    "op4_factor_machine": op4_factor_machine,
    "op5_host_rules": op5_host_rules,
    "op6_qgram_lemma": op6_qgram_lemma,
    "op7_prefix_counts": op7_prefix_counts,
    "op8_direct_codes": op8_direct_codes,
    "op9_pivotal_mix": op9_pivotal_mix,
    "op10_simhash_pivots": op10_simhash_pivots,
    "op11_term_tree": op11_term_tree,
    "op12_log_bilinear": op12_log_bilinear,
    "op13_turn_repair": op13_turn_repair,
}

SQL: dict[str, str] = {
    "op2_link_trust": link_trust_sql(RULES),
    "op3_arc_to_warc": archives_sql(),
    "op5_host_rules": host_rules_sql(),
    "op11_term_tree": lexical_search_sql(),
}
