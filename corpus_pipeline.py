"""From raw documents to token files, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame; ``run`` writes
each result as a table in the shared folder and hands it on. All stages but the
last return the columns of ``documents`` and keep whole rows. Empty tables give
empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm.common import read_table, stage
from tradeloom.llm.direct_codes import tokens_on_disk
from tradeloom.llm.factor_machine import keep_good, train
from tradeloom.llm.near_copies import one_per_group
from tradeloom.llm.pivotal import mixed_documents
from tradeloom.llm.qgram_filter import drop_contaminated
from tradeloom.llm.simhash_pivots import near_duplicates

TOKENIZER = "byte_bpe_50k.json"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(docs, train(docs, read_table(spark, sf_dir, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, the one with the smallest id.

    Groups are connected over the links of the pivot search of ``op10`` and over
    near copies, which have a Jaccard similarity of 0.8 or more on five-word
    shingles; a prefix filter finds those beyond the two bits of ``op10``.
    """
    return one_per_group(docs, groups=near_duplicates(docs))


def unseen_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def weighted_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, read back: one row per document."""
    found = tokens_on_disk(docs, public_tokenizers.path(TOKENIZER))
    return found.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("decontamination", unseen_documents),
    ("mix", weighted_documents),
    ("tokens", token_files),
]

# Trained weights, 64-bit hashes, seeded rounding and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
