"""Shapes of the messages and tables.  All fields are nullable."""

from __future__ import annotations

from pyspark.sql import types as T

_INT, _TEXT, _REAL = T.IntegerType(), T.StringType(), T.DoubleType()

# Field names, order and types of the change envelope.
ORDER_IMAGE = T.StructType(
    [
        T.StructField("customer_id", _INT),
        T.StructField("order_id", _INT),
        T.StructField("price", _INT),
        T.StructField("product_id", _INT),
        T.StructField("quantity", _INT),
    ]
)
SOURCE_FIELDS = {
    "connector": _TEXT,
    "db": _TEXT,
    "file": _TEXT,
    "gtid": _TEXT,
    "name": _TEXT,
    "pos": _TEXT,
    "query": _TEXT,
    "row": _TEXT,
    "sequence": _TEXT,
    "server_id": _INT,
    "snapshot": _TEXT,
    "table": _TEXT,
    "thread": _TEXT,
    "ts_ms": _REAL,
    "version": _TEXT,
}

SOURCE = T.StructType([T.StructField(name, kind) for name, kind in SOURCE_FIELDS.items()])

ORDER_KEY = T.StructType([T.StructField("order_id", _INT), T.StructField("customer_id", _INT)])


def envelope(image: T.StructType = ORDER_IMAGE, source: T.StructType = SOURCE) -> T.StructType:
    """Envelope of a table whose rows look like ``image``."""
    return T.StructType(
        [
            T.StructField("after", image),
            T.StructField("before", image),
            T.StructField("op", _TEXT),
            T.StructField("source", source),
            T.StructField("transaction", _TEXT),
            T.StructField("ts_ms", _REAL),
        ]
    )


def state_envelope(image: T.StructType = ORDER_IMAGE) -> T.StructType:
    """What the current state needs of an envelope, for feeds that are not landed in a log.

    Parsing skips the fields left out, which are most of the text.
    """
    position = T.StructType([f for f in SOURCE if f.name in ("file", "pos", "row", "ts_ms")])
    return T.StructType([f for f in envelope(image, position) if f.name != "transaction"])


def log_schema(image: T.StructType = ORDER_IMAGE) -> T.StructType:
    """Envelope plus the ingest date the log is partitioned by (a string, not a DATE)."""
    return T.StructType([*envelope(image).fields, T.StructField("date", _TEXT)])


def feed_schema() -> T.StructType:
    """A message as a file feed holds it; Kafka has the same names with binary key and value."""
    return T.StructType(
        [T.StructField("key", _TEXT), T.StructField("value", _TEXT), T.StructField("timestamp", T.TimestampNTZType())]
    )
