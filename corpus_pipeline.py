"""From raw documents to packed training sequences: five stages, each over all that the one before kept.

Every stage is written as Parquet and read again as the next one's documents. All but the last return the
columns of documents.
"""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bazaarlens.llm import language_id, packing, quality_rules, simhash, substrings
from bazaarlens.plans.registry import table
from bazaarlens.session import cut

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The same vocabulary as ranks, with the pattern that splits text before them.
RANKS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
CAPACITY = 2048


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the base rules or the learned decision list reject."""
    return quality_rules.keep_quality(docs, table(spark, sf_dir, "labels"))


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose two nearest codewords can't be told apart."""
    return language_id.keep_identified(docs, language_id.fit_languages(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves the document with the smallest id of each group linked by SimHash fingerprints of four-word shingles at most four bits apart."""
    return simhash.drop_near_copies(docs, budget=4, shingle=4)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated runs of 50 words out of all documents but the first."""
    return substrings.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every document's tokens in sequences of CAPACITY tokens."""
    return packing.pack_documents(docs, TOKENIZER, CAPACITY, RANKS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_quality),
    ("language ID", keep_language),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", remove_repeats),
    ("best-fit packing", pack),
]

#: Learned stages and tokenizer ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents in ``sf_dir`` after all stages."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
