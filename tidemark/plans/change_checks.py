"""Queries over tables and streams as they change: merges, differences, deliveries, and schemas that grow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import decode, late_field, latest_per_key, merge_state, row_images, source_struct
from ..schemas import envelope, log_schema
from ..sources import (
    PartitionedState,
    append_log,
    append_segment,
    expire_segments,
    noted_schema,
    read_feed,
    read_history,
    read_log,
    stream_feed,
    stream_segments,
    write_feed,
    write_history,
)
from ..streaming import read_inferred, run_inferring_ingest, run_ingest, run_split_ingest, run_state_stream
from .checks import (
    DECODED,
    EVENTS,
    FILES_PER_BATCH,
    IMAGE,
    ORACLES,
    ORDERS,
    QUERIES,
    SPLIT,
    STATE,
    _order_messages,
    _text,
    both_images,
    check,
    feed,
    feed_stream,
    images,
    new_table,
    staged,
    work_folder,
)
from .jobs import publish_changes
from .order_feed import KEYS

__all__ = ["ORACLES", "QUERIES"]


def _split(spark, sf_dir, rows: DataFrame) -> DataFrame:
    """``rows`` with ``early``: whether the order they are about was placed before SPLIT."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    early = F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    return rows.join(orders.select(F.col("o_orderkey").cast("int").alias("order_id"), early.alias("early")), "order_id")


# Merges that touch what changed, and the differences between versions


@check(STATE)
def q_merge_touched(spark, sf_dir):
    """Deletes first, then the rest of the early orders, then the late ones, into a state in partitions."""
    events = _split(spark, sf_dir, images(spark, sf_dir))
    table = PartitionedState(spark, work_folder(spark, "parts"), KEYS, parts=32)
    for batch in (F.col("op") == "d", F.col("early"), ~F.col("early")):
        table.merge(events.filter(batch).drop("early"))
    return table.read().select(*IMAGE, "op", "ts_ms")


_DIFF_BEFORE, _DIFF_AFTER = (
    ", ".join(f"CASE WHEN {there} THEN {quantity if c == 'quantity' else c} END::INT {side}_{c}" for c in IMAGE)
    for side, there, quantity in (
        ("before", "early", "quantity"),
        ("after", "NOT deleted", "quantity + (CASE WHEN updated THEN 100 ELSE 0 END)"),
    )
)


@check(
    f"""{ORDERS}, s AS (SELECT *, placed < TIMESTAMP '{SPLIT}' early FROM b)
    SELECT CASE WHEN deleted THEN 'd' WHEN early THEN 'u' ELSE 'c' END op, {_DIFF_BEFORE}, {_DIFF_AFTER}, NULL::VARCHAR AS transaction,
      (t + (CASE WHEN deleted THEN 2000 WHEN updated THEN 1000 ELSE 0 END))::DOUBLE ts_ms
    FROM s WHERE CASE WHEN early THEN updated OR deleted ELSE NOT deleted END"""
)
def q_publish_diff(spark, sf_dir):
    """Two versions of a bucketed table, the early creates and everything, published as what changed between them."""
    events = _split(spark, sf_dir, images(spark, sf_dir))
    table = new_table(spark, "state", buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    first = table.apply(events.filter("early AND op = 'c'").drop("early"))
    second = table.apply(events.drop("early"))
    path = work_folder(spark, "changes")
    publish_changes(table.read_version(first), table.read_version(second), KEYS, path, source=source_struct(table="orders"))
    return both_images(decode(read_feed(spark, path, schema=T.StructType.fromDDL("key string, value string"))))


@check(STATE)
def q_publish_diff_applied(spark, sf_dir):
    """What changed between the early creates and everything, merged into the former, gives the latter."""
    events = _split(spark, sf_dir, images(spark, sf_dir)).drop("_position")
    old = latest_per_key(events.filter("early AND op = 'c'").drop("early"), KEYS)
    new = latest_per_key(events.drop("early"), KEYS)
    path = work_folder(spark, "changes")
    publish_changes(old, new, KEYS, path)
    changes = row_images(decode(read_feed(spark, path, schema=T.StructType.fromDDL("key string, value string"))))
    merged = merge_state(old, changes, KEYS)
    # a late order that was updated since is a create between the two states
    last = new.select("order_id", F.col("op").alias("last"))
    return merged.join(last, "order_id").select(*IMAGE, F.col("last").alias("op"), "ts_ms")


# Deliveries


@check(
    f"""{DECODED} WHERE year(placed) < (SELECT min(year(o_orderdate)) + 2 FROM orders)
      OR year(placed) > (SELECT max(year(o_orderdate)) - 3 FROM orders)"""
)
def q_stream_lost_offsets(spark, sf_dir):
    """A segment a year.  The stream reads two; all but the last three expire while it is down, and it goes on behind them."""
    path, target, checkpoint, progress = (work_folder(spark, name) for name in ("segments", "log", "checkpoint", "progress"))
    messages = feed(spark, sf_dir)
    first, last = messages.agg(F.min(F.year("timestamp")), F.max(F.year("timestamp"))).first()
    for year in range(first, last + 1):
        append_segment(messages.filter(F.year("timestamp") == year), path)

    def run(limit=None):
        source = stream_segments(spark, path, max_segments=limit, progress=progress if limit else None)
        return run_ingest(source, target, checkpoint, available_now=True)

    run(limit=2).awaitTermination()
    expire_segments(spark, path, keep=3)
    run().awaitTermination()
    return both_images(read_log(spark, target))


# broken messages without a position are known by their text, which all of them share
_ONCE = DECODED.replace("UNION ALL SELECT *, 'ok', 'c', NULL, quantity, t FROM b WHERE repeated", "").replace(
    "UNION ALL SELECT *, 'malformed', NULL, NULL, NULL, NULL FROM b WHERE bad",
    "UNION ALL (SELECT *, 'malformed', NULL, NULL, NULL, NULL FROM b WHERE bad LIMIT 1)",
)


@check(_ONCE)
def q_stream_distinct(spark, sf_dir):
    """A feed that is delivered twice, and in which urgent orders are created twice."""
    path, target, checkpoint = (work_folder(spark, name) for name in ("twice", "log", "checkpoint"))
    for _ in range(2):
        write_feed(feed(spark, sf_dir), path)
    messages = stream_feed(spark, path, maxFilesPerTrigger=2 * FILES_PER_BATCH)
    run_ingest(messages, target, checkpoint, available_now=True, distinct_within="5000 days").awaitTermination()
    return both_images(read_log(spark, target))


@check(
    f"""{EVENTS} SELECT CASE WHEN kind = 'ok' THEN 'logged' ELSE kind END status,
      CASE WHEN kind = 'tombstone' THEN '{{"order_id":' || order_id || ',"customer_id":' || customer_id || '}}' END AS key,
      CASE kind WHEN 'ok' THEN op WHEN 'malformed' THEN '{{bad' END AS value, ts::DOUBLE ts_ms FROM ev"""
)
def q_stream_rejects(spark, sf_dir):
    """Events and rejects of one stream, each in its place; run again from the checkpoint."""
    target, rejects, checkpoint = (work_folder(spark, name) for name in ("log", "rejects", "checkpoint"))
    for _ in range(2):
        run_split_ingest(feed_stream(spark, sf_dir), target, rejects, checkpoint, available_now=True).awaitTermination()
    log = read_log(spark, target).select(F.lit("logged").alias("status"), F.lit(None).cast("string").alias("key"), F.col("op").alias("value"), "ts_ms")
    rest = spark.read.schema("key string, value string, status string").parquet(rejects)
    return log.unionByName(rest.select("status", "key", "value", F.lit(None).cast("double").alias("ts_ms")))


# Deletes that are forgotten


@check(
    f"""{STATE} UNION ALL SELECT customer_id, order_id, price, product_id, ({"quantity + (CASE WHEN updated THEN 100 ELSE 0 END)"})::INT, 'd',
      (t + 2000)::DOUBLE FROM b WHERE deleted AND t + 2000 >= epoch_ms(TIMESTAMP '{SPLIT}')"""
)
def q_tombstones_expired(spark, sf_dir):
    """Deletes before SPLIT are forgotten while a stream feeds the table; creates delivered once more bring nothing back."""
    table = new_table(spark, "state")
    split = float(spark.sql(f"SELECT unix_millis(TIMESTAMP'{SPLIT} 00:00:00 UTC')").first()[0])
    run_state_stream(decode(feed_stream(spark, sf_dir)), table, available_now=True).awaitTermination()
    table.fold(forget_before=split)
    created = images(spark, sf_dir).filter("op = 'c'")
    table.add_changes(latest_per_key(created, KEYS), table.next_batch())
    table.fold()
    return table.rows().drop("_position")


# Schemas that grow


@check(
    """SELECT o_orderkey::INT order_id, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE (o_orderkey % 50)::INT END discount,
      o_orderstatus AS status FROM orders"""
)
def q_late_field(spark, sf_dir):
    """Fields that no schema had at ingest, read from the messages kept beside the columns."""

    def value():
        discount = F.when(F.col("o_orderkey") % 3 == 0, '"none"').otherwise((F.col("o_orderkey") % 50).cast("string"))
        image = _text('{"order_id":', F.col("o_orderkey"), ',"discount":', discount, "}")
        return _text('{"after":', image, ',"op":"c","more":{"order status":"', F.col("o_orderstatus"), '"}}')

    source, target, checkpoint = (work_folder(spark, name) for name in ("feed", "log", "checkpoint"))
    write_feed(_order_messages(spark, sf_dir, value), source)
    run_ingest(stream_feed(spark, source), target, checkpoint, available_now=True, raw="raw").awaitTermination()
    log = read_log(spark, target, T.StructType([*log_schema(), T.StructField("raw", T.VariantType())]))
    return log.select("after.order_id", late_field("after.discount", "int").alias("discount"), late_field("more.order status", "string").alias("status"))


@check(
    """SELECT o_orderkey::VARCHAR order_id, (CASE o_orderkey % 3 WHEN 0 THEN o_orderkey WHEN 1 THEN o_orderkey + 3000000000
      ELSE o_orderkey + 18446744073709500000::DECIMAL(20,0) END)::DECIMAL(20,0)::VARCHAR price FROM orders"""
)
def q_schema_widened(spark, sf_dir):
    """A price that was INT, then BIGINT, then DECIMAL, in one column of one log."""
    path = work_folder(spark, "log")
    kinds = [(T.IntegerType(), "0"), (T.LongType(), "3000000000"), (T.DecimalType(20, 0), "18446744073709500000")]
    for turn, (kind, more) in enumerate(kinds):
        image = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("price", kind)])

        def value(more=more):
            price = F.col("o_orderkey").cast("decimal(20,0)") + F.lit(more).cast("decimal(20,0)")
            return _text('{"after":{"order_id":', F.col("o_orderkey"), ',"price":', price, '},"op":"c"}')

        messages = _order_messages(spark, sf_dir, value).withColumn("order", F.get_json_object("value", "$.after.order_id").cast("long"))
        append_log(decode(messages.filter(F.col("order") % 3 == turn), envelope(image)), path)
    log = read_log(spark, path, noted_schema(spark, path))
    return log.select(F.col("after.order_id").cast("string").alias("order_id"), F.col("after.price").cast("string").alias("price"))


@check(
    f"""{EVENTS} SELECT order_id, customer_id, coalesce(new_q, old_q)::INT quantity, op, ts::DOUBLE ts_ms FROM ev
    WHERE kind = 'ok' AND order_id IN (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20)"""
)
def q_key_history(spark, sf_dir):
    """All events of the twenty dearest orders."""
    path = staged(
        spark, sf_dir, "history",
        lambda p: write_history(decode(feed(spark, sf_dir), clock=F.date_trunc("year", "timestamp")), p, KEYS, group_bytes=1 << 16),
    )
    dearest = spark.read.parquet(f"{sf_dir}/orders.parquet").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).collect()
    found = read_history(spark, path, [{"order_id": r.o_orderkey, "customer_id": r.o_custkey} for r in dearest])
    quantity = F.coalesce("after.quantity", "before.quantity").alias("quantity")
    return found.select("order_id", "customer_id", quantity, "op", "ts_ms")


@check(
    f"""SELECT event_id id, json_extract(props, '$.k')::DOUBLE + CASE WHEN event_id % 2 = 1 THEN 0.5 ELSE 0 END k,
      CASE WHEN event_id % 2 = 1 THEN event_type END AS type FROM events"""
)
def q_stream_inferred(spark, sf_dir):
    """Messages that gain a field, and a fraction, from the second file on."""
    source, target, checkpoint = (work_folder(spark, name) for name in ("feed", "rows", "checkpoint"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("long")
    shapes = [
        F.struct(F.col("event_id").alias("id"), k.alias("k")),
        F.struct(F.col("event_id").alias("id"), (k + F.lit(0.5)).alias("k"), F.col("event_type").alias("type")),
    ]
    for turn, shape in enumerate(shapes):
        rows = events.filter(F.col("event_id") % 2 == turn)
        write_feed(rows.select(F.lit(None).cast("string").alias("key"), F.to_json(shape).alias("value"), F.col("ts").alias("timestamp")).coalesce(1), source)
        run_inferring_ingest(stream_feed(spark, source), target, checkpoint, available_now=True).awaitTermination()
    return read_inferred(spark, target).drop("date")
