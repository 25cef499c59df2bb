"""From messages to envelope columns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_text, decode_json, free_name, ingest_date
from ..schemas import ORDER_KEY, envelope


def decode(
    feed: DataFrame, schema: T.StructType | None = None, clock: str | Column | None = None, raw: str | None = None
) -> DataFrame:
    """Envelope columns plus the ingest ``date``, one row per message.

    Tombstones and malformed messages stay as rows of nulls; where ``clock`` is null, the date is the
    processing day.  The parsed struct goes through
    ``inline`` so that operators stacked on top read its fields instead of parsing the text again.  ``raw`` names a
    VARIANT column for the whole message, from which ``late_field`` reads what the schema lacks.
    """
    parsed = decode_json(as_text(), schema or envelope())
    whole = [F.try_parse_json(as_text()).alias(raw)] if raw else []
    return feed.select(F.inline(F.array(parsed)), *whole, ingest_date(clock).alias("date"))


def late_field(path: str, kind: str, raw: str = "raw") -> Column:
    """A field of the whole messages that ``decode(raw=...)`` kept, as ``after.discount``; null where it is missing or does not fit."""
    steps = "".join(f".{part}" if part.isidentifier() else f"['{part}']" for part in path.split("."))
    return F.try_variant_get(F.col(f"`{raw}`"), f"${steps}", kind)


def decode_key(feed: DataFrame, schema: T.StructType = ORDER_KEY) -> DataFrame:
    """Columns of the message key; null where a message has none."""
    return feed.select(F.inline(F.array(decode_json(as_text("key"), schema))))


def extract_images(feed: DataFrame, schema: T.StructType, image: str = "after") -> DataFrame:
    """Columns of one image of every message; rows of nulls where a message has none."""
    kind = next((f.dataType for f in schema if f.name == image), None)
    if not isinstance(kind, T.StructType) or not kind.fields:
        raise ValueError(f"no message has a row in {image!r}")
    # The other envelope fields are left out of the parse.
    wanted = T.StructType([T.StructField(image, kind)])
    return feed.select(F.inline(F.array(decode_json(as_text(), wanted)[image])))


def message_status(feed: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """``feed`` with a ``status``: ok (has a row image), no image (another event), tombstone (no value) or malformed.

    A ``status`` column of the feed is replaced.
    """
    schema, name = schema or envelope(), free_name(feed, "_parsed")
    messages = feed.select("*", F.inline(F.array(F.struct(decode_json(as_text(), schema).alias(name)))))
    kept = [F.col(f"`{c}`") for c in feed.columns if c.lower() != "status"]
    return messages.select(*kept, _status(F.col(name), schema).alias("status"))


def decode_with_status(feed: DataFrame, schema: T.StructType | None = None, clock: str | Column | None = None) -> DataFrame:
    """``key`` and ``value`` as text, ``status`` as ``message_status`` has it, the ``event`` as one struct and its ``date``; parsed once."""
    schema = schema or envelope()
    parsed = F.inline(F.array(F.struct(decode_json(as_text(), schema).alias("event"))))
    messages = feed.select(as_text("key").alias("key"), as_text().alias("value"), ingest_date(clock).alias("date"), parsed)
    return messages.withColumn("status", _status(F.col("event"), schema))


def _status(parsed: Column, schema: T.StructType) -> Column:
    has_image = parsed["after"].isNotNull() | parsed["before"].isNotNull()
    says_something = reduce(or_, [parsed[field].isNotNull() for field in schema.names])
    status = F.when(parsed.isNull(), "tombstone").when(has_image, "ok").when(says_something, "no image")
    return status.otherwise("malformed")


def only_table(log: DataFrame, table: str) -> DataFrame:
    """Events of one source table, for a feed that carries several."""
    return log.filter(F.col("source.table") == table)
