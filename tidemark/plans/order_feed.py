"""A deterministic change feed made from the ``orders`` table.

Every order is created.  Finished orders (status F) are updated a second later, low-priority ones
are deleted another second on and leave a tombstone, the create of urgent ones is delivered
twice, and orders under 2000 also bring a message that is not JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import source_struct, to_change_feed
from ..schemas import ORDER_IMAGE

KEYS = ["order_id", "customer_id"]

# What the source metadata of the order events says.
ORDER_SOURCE = {
    "version": "1.8.1.Final",
    "connector": "mysql",
    "name": "fake-db-server1",
    "snapshot": "false",
    "db": "inventory",
    "table": "orders",
    "server_id": 223344,
    "file": "mysql-bin.000003",
    "row": 0,
}


def _image(added: int = 0) -> Column:
    values = {
        "customer_id": F.col("o_custkey"),
        "order_id": F.col("o_orderkey"),
        "price": F.floor("o_totalprice"),
        "product_id": F.col("o_orderkey") % 2000,
        "quantity": F.col("o_orderkey") % 10 + 1 + added,
    }
    return F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in ORDER_IMAGE])


def _event(op: str | None, delay: int, before: Column | None, after: Column | None, text: str | None = None) -> Column:
    nothing = F.lit(None).cast(ORDER_IMAGE)
    return F.struct(
        F.lit(op).cast("string").alias("op"),
        F.lit(float(delay)).alias("delay"),
        (nothing if before is None else before).alias("before"),
        (nothing if after is None else after).alias("after"),
        F.lit(text).cast("string").alias("text"),
    )


def order_events(orders: DataFrame) -> DataFrame:
    """One row per message: ``op``, ``before``, ``after``, ``ts_ms``, ``pos``, ``text`` and ``timestamp``."""
    updated = F.col("o_orderstatus") == "F"
    deleted = F.col("o_orderpriority") == "5-LOW"
    last = F.when(updated, _image(100)).otherwise(_image())
    created = _event("c", 0, None, _image())
    events = F.array_compact(
        F.array(
            created,
            F.when(updated, _event("u", 1000, _image(), _image(100))),
            F.when(deleted, _event("d", 2000, last, None)),
            F.when(deleted, _event(None, 2000, last, None)),
            F.when(F.col("o_orderpriority") == "1-URGENT", created),
            F.when(F.col("o_totalprice") < 2000, _event(None, 0, None, None, "{bad")),
        )
    )
    placed = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', o_orderdate)").cast("double")
    return orders.select(
        F.inline(events),
        placed.alias("placed"),
        (F.col("o_orderkey") % 1901 + 100).alias("pos"),
        F.col("o_orderdate").alias("timestamp"),
    ).select("*", (F.col("placed") + F.col("delay")).alias("ts_ms"))


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages: ``key``, ``value`` and ``timestamp``."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    events = order_events(orders.repartition(spark.sparkContext.defaultParallelism))
    feed = to_change_feed(
        events,
        KEYS,
        F.col("op"),
        "ts_ms",
        "before",
        "after",
        source_struct(**ORDER_SOURCE, ts_ms=F.col("placed"), pos=F.col("pos")),
        keep=("text", "timestamp"),
    )
    broken = F.col("text").isNotNull()
    return feed.select(
        F.when(~broken, F.col("key")).alias("key"), F.coalesce("text", "value").alias("value"), "timestamp"
    )
