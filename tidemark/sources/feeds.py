"""Change feeds: messages with a ``key`` and a ``value``, from Kafka or from files."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions import as_text
from ..schemas import feed_schema
from .files import remove, shared_folder

#: Bytes of a row group in a feed's Parquet files.  No two tasks share one, and message texts shrink many times over.
GROUP_BYTES = 4 << 20


def _kafka(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic}


def read_feed(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    servers: str = "",
    topic: str = "",
    schema: T.StructType | None = None,
    **options,
) -> DataFrame:
    """The whole feed as a bounded DataFrame."""
    return _loaded(spark.read, path, fmt, schema, _kafka(servers, topic) if fmt == "kafka" else {}, options)


def stream_feed(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    servers: str = "",
    topic: str = "",
    schema: T.StructType | None = None,
    fail_on_data_loss: bool = False,
    **options,
) -> DataFrame:
    """The feed as a stream.

    From Kafka, a stream without a checkpoint replays the whole topic.  Messages that expired before they were
    read are passed over without a word unless ``fail_on_data_loss`` is set.  Limits such as ``maxOffsetsPerTrigger`` and ``minPartitions`` (which
    splits a hot Kafka partition over several tasks) or ``maxFilesPerTrigger`` go in ``options``."""
    defaults = {}
    if fmt == "kafka":
        lost = "true" if fail_on_data_loss else "false"
        defaults = {**_kafka(servers, topic), "startingOffsets": "earliest", "failOnDataLoss": lost}
    return _loaded(spark.readStream, path, fmt, schema, defaults, options)


def _loaded(
    reader, path: str | None, fmt: str, schema: T.StructType | None, defaults: dict, options: dict
) -> DataFrame:
    reader = reader.format(fmt).options(**{**defaults, **options})
    if fmt not in ("kafka", "text", "delta"):
        reader = reader.schema(schema or feed_schema())
    return reader.load(path) if path else reader.load()


def write_feed(feed: DataFrame, path: str | None = None, fmt: str = "parquet", mode: str = "append", **options) -> None:
    """Publish messages; ``fmt="kafka"`` needs the ``kafka.bootstrap.servers`` and ``topic`` options.

    Parquet files get small row groups, so that all cores can share the few files of a micro-batch.
    """
    if fmt == "parquet":
        options = {"parquet.block.size": GROUP_BYTES, **options}
    writer = feed.write.format(fmt).mode(mode).options(**options)
    writer.save(path) if path else writer.save()


def require_messages(feed: DataFrame) -> DataFrame:
    """``feed`` itself, or ValueError if it has no message; reads no more than one."""
    if feed.isEmpty():
        raise ValueError("no data in the feed")
    return feed


@contextmanager
def landed_feed(feed: DataFrame) -> Iterator[DataFrame]:
    """The message texts written once and read back, so that several passes see one and the same feed.

    The copy is removed at the end of the block.
    """
    spark = feed.sparkSession
    path = shared_folder(spark, "feed")
    try:
        feed.select(as_text().alias("value")).write.parquet(path)
        yield spark.read.schema("value string").parquet(path)
    finally:
        remove(spark, path)
