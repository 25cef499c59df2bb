"""Batch jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_text, decode_json, first_message_schema, infer_schema
from ..operators import extract_images, row_images, state_changes, to_change_feed
from ..operators.images import has_position
from ..sources import StateTable, append_parquet, landed_feed, read_log, require_messages, write_feed


def run_bronze(
    spark: SparkSession,
    log_path: str,
    table: StateTable,
    backup_root: str | None = None,
    day: str | None = None,
    since: str | None = None,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    op_from: str = "op",
) -> int:
    """Bring a state table up to date with the log; returns the table's new version.

    Reads the whole log, or with ``since`` only the ingest dates from then on; the deletes kept in
    the table make both give the same state.  The changes alone are ranked, and folded into the state in one
    job.  The state of before is copied to
    ``backup_root/day`` first.  A failed copy stops the job.
    """
    if table.checkpoint():
        raise ValueError(f"{table.path} is fed by a stream")
    if backup_root is not None:
        table.backup(backup_root, day)
    log = read_log(spark, log_path, schema, fmt, since)
    changes = row_images(log, op_from, position=has_position(log))
    return table.apply(changes)


def extract_after(
    feed: DataFrame, out: str, schema: T.StructType | None = None, from_first: bool = False, land: bool = False
) -> None:
    """Append the ``after`` columns of every message to a Parquet folder.

    Without a ``schema`` one is inferred from the whole feed, or from its first message alone with
    ``from_first``.  A feed in files is read twice for the former: its files were listed once and do not change.  A
    source that may have moved on by the second pass, such as Kafka, needs ``land``: its messages are
    written once and both passes read the copy.
    """
    require_messages(feed)
    if schema is not None:
        append_parquet(extract_images(feed, schema), out)
    elif from_first:
        parsed = decode_json(as_text(), first_message_schema(feed))
        append_parquet(feed.select(parsed.alias("value")).select("value.after.*"), out)
    elif land:
        with landed_feed(feed) as landed:
            append_parquet(extract_images(landed, infer_schema(landed)), out)
    else:
        append_parquet(extract_images(feed, infer_schema(feed)), out)


def publish_table(
    rows: DataFrame,
    keys: str | list[str],
    op: str,
    ts_ms: str | Column | None = None,
    path: str | None = None,
    fmt: str = "parquet",
    source: Column | None = None,
    **options,
) -> None:
    """Publish every row of a table as a change message; ``ts_ms`` is a column, or the time of the job."""
    if ts_ms is None:
        ts_ms = F.unix_millis(F.current_timestamp()).cast("double")
    write_feed(to_change_feed(rows, keys, op, ts_ms, source=source), path, fmt, **options)


def publish_changes(
    old: DataFrame,
    new: DataFrame,
    keys: str | list[str],
    path: str | None = None,
    fmt: str = "parquet",
    source: Column | None = None,
    at: str | Column | None = None,
    **options,
) -> None:
    """Publish the creates, updates and deletes that turn the state ``old`` into ``new``, each with both its images.

    The states are two versions of a state table, or any two that ``state_changes`` takes.
    """
    changes = state_changes(old, new, keys, at)
    write_feed(to_change_feed(changes, keys, F.col("op"), "ts_ms", "before", "after", source), path, fmt, **options)
