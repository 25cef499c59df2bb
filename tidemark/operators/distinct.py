"""Events that were delivered more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_text, decode_json, ingest_date
from ..schemas import envelope

#: What of the source metadata tells events apart.
PLACE = ("server_id", "name", "file", "pos", "row")


def distinct_events(
    feed: DataFrame, within: str, schema: T.StructType | None = None, clock: str | Column | None = None, arrival: str = "timestamp"
) -> DataFrame:
    """``decode``, of each event only the first delivery.

    An event is known by its place in the source's log (server, file, pos, row) together with its op and images, so
    that one delivered again with another ``ts_ms`` or message is the same; rows without a source position, such as tombstones and
    broken messages, are known by key and text.  Deliveries at most ``within`` (an interval) apart by their ``arrival`` are found;
    a stream forgets an event when its watermark, the latest arrival less ``within``, has passed it, which bounds its state
    by the events of that time.  A message that arrives later than the watermark is left out.  Without an arrival
    time a message counts as arriving now.
    """
    schema = schema or envelope()
    arrived = F.coalesce(F.col(arrival).cast("timestamp"), F.current_timestamp()).alias("_arrived")
    text = F.sha2(F.to_json(F.struct(as_text("key").alias("key"), as_text().alias("value")), {"ignoreNullFields": "false"}), 256)
    parsed = feed.select(F.inline(F.array(decode_json(as_text(), schema))), ingest_date(clock).alias("date"), arrived, text.alias("_text"))
    place = [F.col(f"source.{name}") for name in PLACE if name in schema["source"].dataType.names]
    content = F.struct(*place, "op", "before", "after")
    event = F.sha2(F.to_json(content, {"ignoreNullFields": "false"}), 256)
    known = F.when(F.col("source.file").isNotNull() & F.col("source.pos").isNotNull(), event).otherwise(F.col("_text"))
    marked = parsed.withColumn("_event", known).drop("_text")
    if marked.isStreaming:
        first = marked.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_event"])
    else:
        first = marked.dropDuplicates(["_event"])
    return first.drop("_arrived", "_event")
