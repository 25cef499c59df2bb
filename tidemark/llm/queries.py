"""The registered queries of this subpackage: one per operator, over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import shared_folder
from . import sql
from .bpe import bpe_encode, read_ranks
from .clustering import cluster_report
from .exact import exact_groups
from .html import extract_text
from .licences import oracle_sql as licence_sql
from .licences import scan_licences
from .mixing import mix_counts
from .near import near_groups
from .private import find_private, private_digest
from .quality import in_fold, train, with_score
from .resampling import importance_resample
from .shared import table
from .substrings import remove_repeats
from .vectors import vector_groups
from .warc import read_warc, write_warc


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP1_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).select(
        "page_id", "payload_bytes", F.lower(F.hex("digest")).alias("payload_digest"), "record_type", "refers_to"
    )


OP4_SQL = """
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
       CASE WHEN strlen(html) >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(html) >= 1000 AND page_id < last THEN last END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM pages)
"""


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_digest(find_private(table(spark, sf_dir, "documents").select("doc_id", "text"), everywhere=True))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), size=2)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_encode(docs, ranks, public_tokenizers.PATTERN, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_groups(table(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, min(b) AS component_id, vec_id = min(b) AS kept
FROM embeddings JOIN reach ON reach.a = vec_id GROUP BY vec_id
"""


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return with_score(docs, model).select(
        "doc_id",
        (~in_fold(F.col("doc_id"))).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranked = importance_resample(docs, table(spark, sf_dir, "benchmark"), n=1)
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def op12_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_report(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_licences": op2_licences,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_warc": op4_warc,
    "op5_pii": op5_pii,
    "op6_near_dedup": op6_near_dedup,
    "op7_bpe": op7_bpe,
    "op8_mixing": op8_mixing,
    "op9_vectors": op9_vectors,
    "op10_quality": op10_quality,
    "op11_resampling": op11_resampling,
    "op12_html": op12_html,
    "op13_clustering": op13_clustering,
}
ORACLES = {
    "op2_licences": licence_sql(),
    "op9_vectors": OP9_SQL,
    "op4_warc": OP4_SQL,
    "op1_exact_dedup": OP1_SQL,
    "op11_resampling": sql.RESAMPLING,
    "op13_clustering": sql.clustering(),
}
