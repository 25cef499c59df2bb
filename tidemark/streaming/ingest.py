"""Stream a change feed into the log."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import decode, decode_with_status, distinct_events
from ..sources import check_append, check_stream
from ..sources.files import exists, folders
from .trigger import triggered


def run_ingest(
    feed: DataFrame,
    log_path: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    clock: str | Column | None = None,
    available_now: bool = False,
    every: str | None = None,
    raw: str | None = None,
    distinct_within: str | None = None,
    arrival: str = "timestamp",
    **options,
) -> StreamingQuery:
    """Decode the feed and append it to the log, partitioned by ingest date.

    Stateless and without a shuffle.  A restart goes on from the checkpoint.  ``available_now``
    takes what is there and stops; ``every`` (such as "1 minute") spaces the micro-batches and so
    makes fewer, larger files.  Columns added to the schema appear in the log from then on.  ``raw`` names a VARIANT
    column that keeps whole messages, for fields that the schema lacks.

    ``distinct_within`` leaves out events delivered again within that time of their first ``arrival``, as
    ``distinct_events`` says.  That takes a shuffle and a state store, in RocksDB, of the events of that time; a checkpoint
    is made with or without it.
    """
    if distinct_within:
        if raw:
            raise ValueError("whole messages are not kept of distinct events")
        events = distinct_events(feed, distinct_within, schema, clock, arrival)
    else:
        events = decode(feed, schema, clock, raw)
    if fmt == "parquet":
        check_stream(feed.sparkSession, log_path, checkpoint)
        check_append(feed.sparkSession, log_path, events.schema)
    elif fmt == "delta":
        options = {"mergeSchema": "true", **options}
    writer = (
        events.writeStream.format(fmt)
        .partitionBy("date")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )
    with state_in_rocksdb(feed.sparkSession):
        return triggered(writer, available_now, every).start(log_path)


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started within the block keep their state in RocksDB, if the session has not chosen a store; others are left alone."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    if before.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_split_ingest(
    feed: DataFrame,
    log_path: str,
    rejects_path: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    clock: str | Column | None = None,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Decode the feed once, events into the log and the rest (``key``, ``value``, ``status``) beside it.

    Tombstones and messages that are not JSON objects of the schema are rejects, all others events.  Each micro-batch is a
    folder by its number in both places, ``batch=N/date=...``, which counts once it is whole: a micro-batch that broke
    between the two writes, or after them, is run again by Spark and writes only what is missing.  It is parsed once and
    held by the executors meanwhile, without the texts of events.  A log of this kind belongs to one checkpoint; ``read_log`` reads it.
    """
    spark = feed.sparkSession
    messages = decode_with_status(feed, schema, clock)
    check_split(spark, log_path, checkpoint)
    check_append(spark, log_path, messages.select("event.*").schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        rejected = F.col("status").isin("tombstone", "malformed")
        held = batch.withColumns({text: F.when(rejected, F.col(text)) for text in ("key", "value")}).persist()
        try:
            for path, rows in ((log_path, held.filter(~rejected).select("event.*", "date")), (rejects_path, held.filter(rejected).drop("event"))):
                target = f"{path.rstrip('/')}/batch={batch_id}"
                if not exists(spark, f"{target}/_SUCCESS"):
                    rows.write.mode("overwrite").partitionBy("date").parquet(target)
        finally:
            held.unpersist()

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return triggered(writer, available_now, every).start()


def check_split(spark: SparkSession, path: str, checkpoint: str) -> None:
    """ValueError if micro-batches of another checkpoint are in the folder."""
    held = any(name.startswith("batch=") for name in folders(spark, path))
    if held and not exists(spark, f"{checkpoint.rstrip('/')}/offsets"):
        raise ValueError(f"{path} was written under another checkpoint than {checkpoint}")
