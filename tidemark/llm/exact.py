"""Exact dedup: a two-pass Bloom filter finds hashes that may repeat; only their rows are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .shared import free, quoted, stored, with_group


def text_hash(text: Column) -> Column:
    """SHA-256 of the text in UTF-8, 32 bytes; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", max_bytes: int = bloom.MAX_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256 (hex).

    Rows are equal when their texts are, nulls counting as empty.  Of equal ones the row with the
    largest id stays; a null id is smaller than any other, and of rows that repeat an id one stays.
    The first pass writes ids and hashes and puts all hashes into the filter; in the second, rows
    whose hash it has not seen twice pass straight through as groups of one.  An empty table gives
    an empty result.  Other columns of ``docs`` are not looked at.
    """
    rows = stored(
        docs.select(
            quoted(id).alias("id"), text_hash(quoted(text)).alias("sha"), F.monotonically_increasing_id().alias("row")
        ).withColumn("key", F.xxhash64("sha")),
        "exact-hashes",
    )
    twice = bloom.build(rows.select("key"), rows.count(), repeated=True, max_bytes=max_bytes)
    marked = stored(rows.withColumn("may_repeat", twice.may_hold(F.col("key"))), "exact-marked").drop("key")
    alone = marked.filter(~F.col("may_repeat")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"
    )
    asked = marked.filter("may_repeat")
    groups = stored(
        asked.groupBy("sha")
        .agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("group_size"))
        .select("sha", F.col("best.id").alias("keep_id"), F.col("best.row").alias("best"), "group_size"),
        "exact-groups",
    )
    grouped = with_group(asked, groups, ["sha"], "group_size").select(
        "id", "keep_id", "group_size", (F.col("row") == F.col("best")).alias("kept"), "sha"
    )
    return alone.unionByName(grouped).select(
        quoted("id").alias(id), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", max_bytes: int = bloom.MAX_BYTES) -> DataFrame:
    """The rows that stay, whole, by the rules of ``exact_groups``.

    Rows with a hash that may repeat are shuffled after each task has kept its best row per hash,
    so a text that a third of all rows share sends one row per task.
    """
    sha, key, best = free(docs, "sha", "key", "best")
    hashed = docs.withColumn(sha, text_hash(quoted(text)))
    keys = stored(hashed.select(F.xxhash64(quoted(sha)).alias("key")), "exact-keys")
    twice = bloom.build(keys, keys.count(), repeated=True, max_bytes=max_bytes)
    marked = hashed.withColumn(key, twice.may_hold(F.xxhash64(quoted(sha))))
    row = F.struct(*[quoted(c) for c in docs.columns])
    stay = (
        marked.filter(quoted(key)).groupBy(sha).agg(F.max_by(row, F.struct(quoted(id))).alias(best)).select(f"{best}.*")
    )
    return marked.filter(~quoted(key)).drop(sha, key).unionByName(stay)
