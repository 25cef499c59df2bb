"""The corpus pipeline: documents in; filtered, deduplicated, mixed and encoded documents out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import bpe_encode, read_ranks
from tidemark.llm.exact import exact_dedup
from tidemark.llm.mixing import mix
from tidemark.llm.near import near_dedup
from tidemark.llm.quality import keep_good, train
from tidemark.llm.shared import stored_alone, table


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier does not reject; it learns from these documents and ``labels``."""
    return keep_good(docs, train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 80 % of their five-word shingles, the document with the smallest doc_id."""
    return near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, for 150 % of their words with sources weighed 3, 1, 2 in turn."""
    return mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids."""
    return bpe_encode(docs, read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", filter_quality),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]

#: A fitted model, sketches, random order and merges have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next reads them, and what led to them is removed."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored_alone(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
