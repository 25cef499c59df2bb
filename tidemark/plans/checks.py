"""One query per operator over the given tables, each next to the SQL that computes the same rows.

The SQL works on the tables directly and never sees an event, so the two share no code path.
Queries that need a feed or a log derive it from ``orders`` once per session and folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import decode_json, infer_schema
from ..operators import (
    current_state,
    decode,
    decode_key,
    fold_changes,
    latest_per_key,
    live_rows,
    merge_state,
    message_status,
    only_table,
    row_images,
    source_struct,
    to_change_feed,
)
from ..schemas import ORDER_IMAGE, envelope, log_schema, state_envelope
from ..sources import (
    StateTable,
    append_log,
    read_feed,
    read_log,
    require_messages,
    shared_folder,
    stream_feed,
    stream_log,
    write_feed,
)
from ..sources.files import exists, remove
from ..streaming import run_ingest, run_state_stream
from .jobs import extract_after, publish_table, run_bronze
from .order_feed import KEYS, order_feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

IMAGE = ORDER_IMAGE.names
#: Files of the feed in each micro-batch of a stream.
FILES_PER_BATCH = 2
_STAGED: dict[tuple[str, str, str], str] = {}
_MADE: list[str] = []


def check(sql: str) -> Callable[[Query], Query]:
    """Register the query under its own name with its SQL."""

    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        ORACLES[query.__name__] = sql
        return query

    return register


# Inputs derived from the tables


def work_folder(spark: SparkSession, name: str) -> str:
    """A new shared folder, which ``clean_up`` removes."""
    _MADE.append(shared_folder(spark, name))
    return _MADE[-1]


def clean_up(spark: SparkSession) -> None:
    """Remove every folder the queries of this session made; their results cannot be read afterwards."""
    while _MADE:
        remove(spark, _MADE.pop())
    _STAGED.clear()


def staged(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Folder that ``write`` filled, once per session."""
    at = (spark.sparkContext.applicationId, sf_dir, name)
    if at not in _STAGED or not exists(spark, f"{_STAGED[at]}/_SUCCESS"):
        path = work_folder(spark, name)
        write(path)
        _STAGED[at] = path
    return _STAGED[at]


def feed_path(spark: SparkSession, sf_dir: str) -> str:
    return staged(spark, sf_dir, "feed", lambda path: write_feed(order_feed(spark, sf_dir), path))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_feed(spark, feed_path(spark, sf_dir))


def log_path(spark: SparkSession, sf_dir: str) -> str:
    return staged(spark, sf_dir, "log", lambda path: append_log(decode(feed(spark, sf_dir)), path))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_log(spark, log_path(spark, sf_dir))


def feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a stream of several micro-batches."""
    return stream_feed(spark, feed_path(spark, sf_dir), maxFilesPerTrigger=FILES_PER_BATCH)


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_images(log(spark, sf_dir), position=True)


def new_table(spark: SparkSession, name: str, **options) -> StateTable:
    return StateTable(spark, work_folder(spark, name), KEYS, **options)


def both_images(events: DataFrame) -> DataFrame:
    """Decoded events with both images flat."""
    before = [F.col(f"before.{c}").alias(f"before_{c}") for c in IMAGE]
    after = [F.col(f"after.{c}").alias(f"after_{c}") for c in IMAGE]
    return events.select(*before, *after, "op", "transaction", "ts_ms")


# SQL for the same inputs

ORDERS = """
WITH b AS (
  SELECT o_custkey::INT customer_id, o_orderkey::INT order_id, floor(o_totalprice)::INT price,
         (o_orderkey % 2000)::INT product_id, (o_orderkey % 10 + 1)::INT quantity,
         epoch_ms(o_orderdate)::DOUBLE t, o_orderkey % 1901 + 100 pos, o_orderdate placed,
         o_orderstatus = 'F' updated, o_orderpriority = '5-LOW' deleted,
         o_orderpriority = '1-URGENT' repeated, o_totalprice < 2000 bad
  FROM orders
)"""

EVENTS = (
    ORDERS
    + """, ev AS (
  SELECT *, 'ok' kind, 'c' op, NULL::INT old_q, quantity new_q, t ts FROM b
  UNION ALL SELECT *, 'ok', 'u', quantity, quantity + 100, t + 1000 FROM b WHERE updated
  UNION ALL SELECT *, 'ok', 'd', quantity + (CASE WHEN updated THEN 100 ELSE 0 END), NULL, t + 2000 FROM b WHERE deleted
  UNION ALL SELECT *, 'tombstone', NULL, NULL, NULL, NULL FROM b WHERE deleted
  UNION ALL SELECT *, 'ok', 'c', NULL, quantity, t FROM b WHERE repeated
  UNION ALL SELECT *, 'malformed', NULL, NULL, NULL, NULL FROM b WHERE bad
)"""
)

_FLAT = ", ".join(
    f"CASE WHEN {q} IS NOT NULL THEN {q if c == 'quantity' else c} END::INT {side}_{c}"
    for side, q in (("before", "old_q"), ("after", "new_q"))
    for c in IMAGE
)
DECODED = f"{EVENTS} SELECT {_FLAT}, op, NULL::VARCHAR AS transaction, ts::DOUBLE ts_ms FROM ev"

_LAST = "quantity + (CASE WHEN updated THEN 100 ELSE 0 END)"
_LAST_OP = "CASE WHEN deleted THEN 'd' WHEN updated THEN 'u' ELSE 'c' END"
_LAST_TS = "t + (CASE WHEN deleted THEN 2000 WHEN updated THEN 1000 ELSE 0 END)"
LATEST = f"""{ORDERS} SELECT customer_id, order_id, price, product_id, ({_LAST})::INT quantity,
  {_LAST_OP} op, ({_LAST_TS})::DOUBLE ts_ms FROM b"""
STATE = f"{LATEST} WHERE NOT deleted"

SPLIT = "1998-01-01"


# Publishing


def _json_image(quantity: str) -> str:
    fields = " || ',' || ".join(f"""'"{c}":' || {quantity if c == "quantity" else c}""" for c in IMAGE)
    return f"CASE WHEN {quantity} IS NOT NULL THEN '{{' || {fields} || '}}' END"


@check(
    f"""{EVENTS} SELECT CASE WHEN kind <> 'malformed'
      THEN '{{"order_id":' || order_id || ',"customer_id":' || customer_id || '}}' END AS key,
      {_json_image("old_q")} AS "before", {_json_image("new_q")} AS "after", op, ts::DOUBLE ts_ms,
      CASE WHEN kind = 'ok' THEN pos::VARCHAR END pos, kind = 'ok' AS nulls_written
    FROM ev"""
)
def q_publish_envelope(spark, sf_dir):
    def field(name):
        return F.get_json_object("value", f"$.{name}")

    return feed(spark, sf_dir).select(
        "key",
        field("before").alias("before"),
        field("after").alias("after"),
        field("op").alias("op"),
        field("ts_ms").cast("double").alias("ts_ms"),
        field("source.pos").alias("pos"),
        F.coalesce(F.col("value").endswith('"transaction":null}'), F.lit(False)).alias("nulls_written"),
    )


def customers(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet")


def customer_feed(spark, sf_dir) -> DataFrame:
    rows = customers(spark, sf_dir)
    path = staged(
        spark,
        sf_dir,
        "customers",
        lambda path: publish_table(rows, "c_custkey", "c", F.lit(1.0), path, source=source_struct(table="customer")),
    )
    return read_feed(spark, path, schema=T.StructType.fromDDL("key string, value string"))


CUSTOMERS = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'c' op, 1.0::DOUBLE ts_ms FROM customer"


@check(CUSTOMERS)
def q_publish_table(spark, sf_dir):
    log = decode(customer_feed(spark, sf_dir), envelope(customers(spark, sf_dir).schema))
    return current_state(log, "c_custkey")


@check(CUSTOMERS)
def q_source_table(spark, sf_dir):
    """One of two tables that share a feed."""
    both = feed(spark, sf_dir).select("key", "value").unionByName(customer_feed(spark, sf_dir))
    log = only_table(decode(both, envelope(customers(spark, sf_dir).schema)), "customer")
    return current_state(log, "c_custkey")


# Decoding


@check(DECODED)
def q_decode_explicit(spark, sf_dir):
    return both_images(decode(feed(spark, sf_dir)))


@check(
    f"""{EVENTS} SELECT CASE WHEN kind <> 'malformed' THEN order_id END order_id,
      CASE WHEN kind <> 'malformed' THEN customer_id END customer_id FROM ev"""
)
def q_decode_key(spark, sf_dir):
    return decode_key(feed(spark, sf_dir))


@check(
    EVENTS
    + """, s AS (SELECT kind = 'ok' ok, * FROM ev)
    SELECT CASE WHEN ok THEN 'mysql' END connector, CASE WHEN ok THEN 'inventory' END db,
      CASE WHEN ok THEN 'mysql-bin.000003' END file, NULL::VARCHAR gtid, CASE WHEN ok THEN 'fake-db-server1' END AS name,
      CASE WHEN ok THEN pos::VARCHAR END pos, NULL::VARCHAR query, CASE WHEN ok THEN '0' END AS row,
      NULL::VARCHAR AS sequence, CASE WHEN ok THEN 223344 END::INT server_id, CASE WHEN ok THEN 'false' END AS snapshot,
      CASE WHEN ok THEN 'orders' END AS "table", NULL::VARCHAR thread, CASE WHEN ok THEN t END::DOUBLE ts_ms,
      CASE WHEN ok THEN '1.8.1.Final' END AS version FROM s"""
)
def q_source_metadata(spark, sf_dir):
    return decode(feed(spark, sf_dir)).select("source.*")


@check(f"{EVENTS} SELECT strftime(placed, '%Y-%m-%d') AS date, count(*)::BIGINT n FROM ev GROUP BY 1")
def q_ingest_date(spark, sf_dir):
    return decode(feed(spark, sf_dir), clock="timestamp").groupBy("date").agg(F.count("*").alias("n"))


@check(f"{EVENTS} SELECT kind AS status, count(*)::BIGINT n FROM ev GROUP BY 1")
def q_rejects(spark, sf_dir):
    return message_status(feed(spark, sf_dir)).groupBy("status").agg(F.count("*").alias("n"))


@check(f"{EVENTS} SELECT count(*)::BIGINT n FROM ev")
def q_row_count(spark, sf_dir):
    return require_messages(feed(spark, sf_dir)).agg(F.count("*").alias("n"))


_AFTER_BIGINT = ", ".join(
    f"CASE WHEN new_q IS NOT NULL THEN {'new_q' if c == 'quantity' else c} END::BIGINT {c}" for c in IMAGE
)


@check(f"{EVENTS} SELECT {_AFTER_BIGINT} FROM ev")
def q_extract_after_inferred(spark, sf_dir):
    out = work_folder(spark, "extract")
    extract_after(feed(spark, sf_dir), out)
    return spark.read.parquet(out)


@check(f"{EVENTS} SELECT {_AFTER_BIGINT} FROM ev UNION ALL SELECT {_AFTER_BIGINT} FROM ev")
def q_append_extract(spark, sf_dir):
    """The job run twice."""
    out = work_folder(spark, "extract")
    for _ in range(2):
        extract_after(feed(spark, sf_dir), out)
    return spark.read.parquet(out)


@check("SELECT c_custkey, c_name, c_nationkey::BIGINT c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_extract_first_message(spark, sf_dir):
    """All messages have the shape of the first."""
    out = work_folder(spark, "extract")
    extract_after(customer_feed(spark, sf_dir), out, from_first=True)
    return spark.read.parquet(out)


@check("SELECT event_id, json_extract(props, '$.k')::BIGINT k FROM events")
def q_event_props_inferred(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    schema = infer_schema(events.select(F.col("props").alias("value")))
    return events.select("event_id", F.inline(F.array(decode_json("props", schema))))


# Current state


@check(
    f"""{EVENTS} SELECT customer_id, order_id, price, product_id, coalesce(new_q, old_q)::INT quantity, op,
      ts::DOUBLE ts_ms FROM ev WHERE kind = 'ok'"""
)
def q_row_images(spark, sf_dir):
    return row_images(log(spark, sf_dir))


@check(LATEST)
def q_latest_per_key(spark, sf_dir):
    return latest_per_key(images(spark, sf_dir), KEYS).drop("_position")


@check(STATE)
def q_current_state(spark, sf_dir):
    return current_state(log(spark, sf_dir), KEYS)


@check(STATE)
def q_current_state_from_feed(spark, sf_dir):
    return current_state(decode(feed(spark, sf_dir), state_envelope()), KEYS)


@check(LATEST.replace(_LAST_OP, "CASE WHEN updated AND NOT deleted THEN 'u' ELSE 'c' END"))
def q_current_state_literal_op(spark, sf_dir):
    mislabelled = log(spark, sf_dir).withColumn("op", F.when(F.col("op") == "d", "c").otherwise(F.col("op")))
    return current_state(mislabelled, KEYS)


@check(STATE)
def q_op_from_images(spark, sf_dir):
    return current_state(log(spark, sf_dir).withColumn("op", F.lit("c")), KEYS, op_from="images")


@check(f"{STATE} AND placed >= TIMESTAMP '{SPLIT}'")
def q_log_since(spark, sf_dir):
    # Ingested once a year.
    year = F.date_trunc("year", "timestamp")
    path = staged(spark, sf_dir, "years", lambda p: append_log(decode(feed(spark, sf_dir), clock=year), p))
    return current_state(read_log(spark, path, since=SPLIT), KEYS)


# Merging.  The deletes come first, everything older than them after.


@check(STATE)
def q_merge_incremental(spark, sf_dir):
    deletes, others = _deletes_and_others(spark, sf_dir)
    held = latest_per_key(deletes, KEYS)
    return live_rows(merge_state(held, others, KEYS, keep_deletes=True)).drop("_position")


@check(
    LATEST.replace(_LAST_OP, "CASE WHEN updated THEN 'u' ELSE 'c' END").replace(
        _LAST_TS, "t + (CASE WHEN updated THEN 1000 ELSE 0 END)"
    )
)
def q_stale_create_compat(spark, sf_dir):
    deletes, others = _deletes_and_others(spark, sf_dir)
    held = live_rows(latest_per_key(deletes, KEYS))
    return merge_state(held, others, KEYS).drop("_position")


@check(STATE)
def q_fold_broadcast(spark, sf_dir):
    """A small batch into a larger state; whether anything is broadcast is left to adaptive execution."""
    deletes, others = _deletes_and_others(spark, sf_dir)
    small = latest_per_key(deletes, KEYS)
    folded = fold_changes(latest_per_key(others, KEYS), small, KEYS)
    return live_rows(folded).drop("_position")


@check(STATE)
def q_fold_shuffle(spark, sf_dir):
    deletes, others = _deletes_and_others(spark, sf_dir)
    folded = fold_changes(latest_per_key(deletes, KEYS), latest_per_key(others, KEYS), KEYS)
    return live_rows(folded).drop("_position")


def _deletes_and_others(spark, sf_dir):
    events = images(spark, sf_dir)
    return events.filter(F.col("op") == "d"), events.filter(F.col("op") != "d")


# Other tables, other keys


def _latest_sql(table: str, keys: str, order: str, columns: str) -> str:
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS _n
      FROM {table}) WHERE _n = 1"""


_LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,"
    " l_linestatus, l_shipdate"
)


def _line_order(*keys: str) -> str:
    rest = sorted(c.strip() for c in _LINE_COLUMNS.split(","))
    rest = [c for c in rest if c != "l_shipdate" and c not in keys]
    return ", ".join(f"{c} DESC NULLS LAST" for c in ["l_shipdate", *rest])


@check(
    _latest_sql(
        "events",
        "user_id",
        "ts DESC NULLS LAST, event_id DESC NULLS LAST, event_type DESC NULLS LAST, props DESC, value DESC NULLS LAST",
        "event_id, ts, user_id, event_type, value, props",
    )
)
def q_events_latest_user(spark, sf_dir):
    return latest_per_key(spark.read.parquet(f"{sf_dir}/events.parquet"), "user_id", "ts")


@check(_latest_sql("lineitem", "l_orderkey, l_linenumber", _line_order("l_orderkey", "l_linenumber"), _LINE_COLUMNS))
def q_lineitem_latest(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return latest_per_key(lines, "l_orderkey,l_linenumber", "l_shipdate")


@check(_latest_sql("lineitem", "l_linestatus", _line_order("l_linestatus"), _LINE_COLUMNS))
def q_lineitem_latest_hot(spark, sf_dir):
    """Two keys own all rows."""
    return latest_per_key(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_linestatus", "l_shipdate")


# Tables and jobs


def _run_in_two_parts(spark, sf_dir, table: StateTable, backup_root: str | None = None, incremental: bool = False):
    """Bring the table up to date with the orders before SPLIT, then with all of them."""
    path = work_folder(spark, "log")
    early = F.col("timestamp") < F.lit(SPLIT).cast("timestamp_ntz")
    messages = feed(spark, sf_dir)
    append_log(decode(messages.filter(early), clock=F.lit("2024-01-01").cast("date")), path)
    run_bronze(spark, path, table, backup_root, "2024-01-01")
    append_log(decode(messages.filter(~early), clock=F.lit("2024-01-02").cast("date")), path)
    run_bronze(spark, path, table, backup_root, "2024-01-02", since="2024-01-02" if incremental else None)


@check(STATE)
def q_bronze_full(spark, sf_dir):
    table = new_table(spark, "state")
    _run_in_two_parts(spark, sf_dir, table)
    return table.read()


@check(STATE)
def q_bronze_since(spark, sf_dir):
    table = new_table(spark, "state")
    _run_in_two_parts(spark, sf_dir, table, incremental=True)
    return table.read()


@check(STATE)
def q_bronze_bucketed(spark, sf_dir):
    table = new_table(spark, "state", buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    _run_in_two_parts(spark, sf_dir, table, incremental=True)
    return table.read()


@check(f"{STATE} AND placed < TIMESTAMP '{SPLIT}'")
def q_backup_snapshot(spark, sf_dir):
    backups = work_folder(spark, "backup")
    _run_in_two_parts(spark, sf_dir, new_table(spark, "state"), backups)
    return live_rows(spark.read.parquet(f"{backups}/2024-01-02")).drop("_position")


WIDE = T.StructType([*ORDER_IMAGE.fields, T.StructField("priority", T.IntegerType())])
WIDENED = f"""{ORDERS.replace("FROM orders", ", left(o_orderpriority, 1)::INT rank FROM orders")}
    SELECT customer_id, order_id, price, product_id, quantity,
      CASE WHEN placed >= TIMESTAMP '{SPLIT}' THEN rank END::INT AS priority FROM b"""


def _widened_log(spark, sf_dir) -> str:
    """Log of a table that gains a column after SPLIT."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    columns = {
        "customer_id": F.col("o_custkey").cast("int"),
        "order_id": F.col("o_orderkey").cast("int"),
        "price": F.floor("o_totalprice").cast("int"),
        "product_id": (F.col("o_orderkey") % 2000).cast("int"),
        "quantity": (F.col("o_orderkey") % 10 + 1).cast("int"),
        "priority": F.left("o_orderpriority", F.lit(1)).cast("int"),
    }
    early = F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    source, target, checkpoint = (work_folder(spark, name) for name in ("feed", "log", "checkpoint"))
    for image, part in ((ORDER_IMAGE, early), (WIDE, ~early)):
        rows = orders.filter(part).select(*[columns[name].alias(name) for name in image.names])
        write_feed(to_change_feed(rows, KEYS, "c", F.lit(0.0)), source)
        messages = stream_feed(spark, source)
        run_ingest(messages, target, checkpoint, envelope(image), available_now=True).awaitTermination()
    return target


@check(WIDENED)
def q_schema_evolution(spark, sf_dir):
    return read_log(spark, _widened_log(spark, sf_dir), log_schema(WIDE)).select("after.*")


@check(WIDENED)
def q_schema_evolution_merged(spark, sf_dir):
    """The columns found in the files."""
    return read_log(spark, _widened_log(spark, sf_dir), merge_schema=True).select("after.*")


# Streams


@check(DECODED)
def q_stream_ingest(spark, sf_dir):
    """Run to the end of the feed, then once more from the checkpoint."""
    target, checkpoint = work_folder(spark, "log"), work_folder(spark, "checkpoint")
    for _ in range(2):
        run_ingest(feed_stream(spark, sf_dir), target, checkpoint, available_now=True).awaitTermination()
    return both_images(read_log(spark, target))


@check(STATE)
def q_stream_state(spark, sf_dir):
    """Folded by the stream itself, after every second micro-batch."""
    table = new_table(spark, "state")
    events = decode(feed_stream(spark, sf_dir), state_envelope())
    run_state_stream(events, table, fold_every=2, available_now=True).awaitTermination()
    return table.read()


@check(STATE)
def q_stream_state_from_log(spark, sf_dir):
    """Feed to log and log to state, each a stream of its own, and nothing folded."""
    target, checkpoint = work_folder(spark, "log"), work_folder(spark, "checkpoint")
    run_ingest(feed_stream(spark, sf_dir), target, checkpoint, available_now=True).awaitTermination()
    table = new_table(spark, "state")
    events = stream_log(spark, target)
    run_state_stream(events, table, available_now=True).awaitTermination()
    return table.read()


# Edges: values, keys, codes and times that are missing or do not fit


def _order_messages(spark, sf_dir, value: Callable[[], object]) -> DataFrame:
    """A message of the given text for every order."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.lit(None).cast("string").alias("key"), value().alias("value"))


def _text(*parts) -> object:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@check(
    """SELECT CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE 7 END::INT price,
      o_orderkey::INT order_id, o_custkey::INT customer_id, NULL::INT quantity, 'c' op FROM orders"""
)
def q_decode_misfits(spark, sf_dir):
    """A price that is a fraction, a text or too large, and an unknown field, leave the rest of the row as it is."""

    def value():
        price = F.element_at(F.array(*map(F.lit, ["10.5", '"7"', "3000000000", "7"])), (F.col("o_orderkey") % 4 + 1).cast("int"))
        image = _text('{"price":', price, ',"order_id":', F.col("o_orderkey"), ',"customer_id":', F.col("o_custkey"), ',"more":1}')
        return _text('{"after":', image, ',"op":"c"}')

    events = decode(_order_messages(spark, sf_dir, value))
    return events.select("after.price", "after.order_id", "after.customer_id", "after.quantity", "op")


@check(DECODED)
def q_decode_binary(spark, sf_dir):
    """Key and value as the bytes that Kafka delivers."""
    messages = feed(spark, sf_dir).select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    return both_images(decode(messages))


_EDGES = """SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END::INT customer_id, o_orderkey::INT order_id,
  CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN 'c' ELSE 'd' END op,
  CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'NaN'::DOUBLE ELSE epoch_ms(o_orderdate)::DOUBLE END ts_ms FROM orders"""


def _edges(spark, sf_dir) -> DataFrame:
    """Rows with null keys, null ops, and times that are null or no number."""
    placed = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', o_orderdate)").cast("double")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).cast("int").alias("customer_id"),
        F.col("o_orderkey").cast("int").alias("order_id"),
        F.when(F.col("o_orderstatus") == "O", "c").when(F.col("o_orderstatus") != "F", "d").alias("op"),
        F.when(F.col("o_orderkey") % 3 == 1, F.lit(float("nan"))).when(F.col("o_orderkey") % 3 == 2, placed).alias("ts_ms"),
    )


def _edge_sql(key: str, where: str = "TRUE") -> str:
    return f"""SELECT customer_id, order_id, op, ts_ms FROM (SELECT *, row_number() OVER (PARTITION BY {key}
      ORDER BY ts_ms DESC NULLS LAST, op IS NOT DISTINCT FROM 'd' DESC, op DESC NULLS LAST, order_id DESC) AS _n
      FROM ({_EDGES})) WHERE _n = 1 AND {where}"""


@check(_edge_sql("customer_id"))
def q_null_key(spark, sf_dir):
    """Rows without a key are a key of their own, through a fold as well."""
    rows = _edges(spark, sf_dir)
    early = F.col("order_id") % 2 == 0
    return fold_changes(latest_per_key(rows.filter(early), "customer_id"), rows.filter(~early), "customer_id")


@check(_edge_sql("customer_id", "op <> 'd'"))
def q_null_op(spark, sf_dir):
    """The newest row counts as live only with an op that is not a delete; a row without one is not live."""
    rows = _edges(spark, sf_dir)
    return merge_state(rows.limit(0), rows, "customer_id")


@check(
    f"""SELECT order_id % 100 AS k, max(ts_ms) AS ts_ms, count(*)::BIGINT n FROM (SELECT order_id % 1000 AS order_id, ts_ms
      FROM (SELECT *, row_number() OVER (PARTITION BY order_id % 1000 ORDER BY ts_ms DESC NULLS LAST) AS _n FROM ({_EDGES}))
      WHERE _n = 1) GROUP BY 1"""
)
def q_ts_null_nan(spark, sf_dir):
    """A time that is no number is the newest of all, one that is missing the oldest."""
    rows = _edges(spark, sf_dir).select((F.col("order_id") % 1000).alias("order_id"), "ts_ms")
    latest = latest_per_key(rows, "order_id")
    return latest.groupBy((F.col("order_id") % 100).alias("k")).agg(F.max("ts_ms").alias("ts_ms"), F.count("*").alias("n"))


@check(
    """SELECT o_custkey::INT customer_id, o_orderkey::INT order_id FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY 999990 + o_orderkey % 20 DESC, o_orderkey % 7 DESC, o_orderkey DESC) AS _n FROM orders) WHERE _n = 1"""
)
def q_ties_by_position(spark, sf_dir):
    """Equal times, told apart by the number of the log file (across a rollover to more digits), pos and row."""

    def value():
        image = _text('{"order_id":', F.col("o_orderkey"), ',"customer_id":', F.col("o_custkey"), "}")
        file = _text('"mysql-bin.', F.col("o_orderkey") % 20 + 999990, '"')
        place = _text('{"ts_ms":5,"file":', file, ',"pos":', F.col("o_orderkey") % 7, ',"row":', F.col("o_orderkey"), "}")
        return _text('{"after":', image, ',"op":"c","ts_ms":5,"source":', place, "}")

    log = decode(_order_messages(spark, sf_dir, value), state_envelope())
    return current_state(log, "customer_id").select("customer_id", "order_id")


@check("SELECT (o_orderkey::DECIMAL(20,0) + 18446744073709500000)::VARCHAR id, o_custkey::BIGINT customer FROM orders")
def q_extract_wide_integers(spark, sf_dir):
    """Integers beyond BIGINT come through inference exactly."""

    def value():
        wide = F.col("o_orderkey").cast("decimal(20,0)") + F.lit("18446744073709500000").cast("decimal(20,0)")
        return _text('{"op":"c","before":null,"after":{"id":', wide, ',"customer":', F.col("o_custkey"), "}}")

    out = work_folder(spark, "extract")
    extract_after(_order_messages(spark, sf_dir, value), out)
    return spark.read.parquet(out).select(F.col("id").cast("string").alias("id"), "customer")


@check(
    f"""{EVENTS} SELECT count(*)::BIGINT n FROM ev WHERE placed >= TIMESTAMP '{SPLIT}'
      OR kind <> 'malformed' AND order_id % 10 = 0"""
)
def q_log_since_without_clock(spark, sf_dir):
    """Messages without a clock are dated by the day they are processed, and are read with every ``since`` before it."""
    messages = feed(spark, sf_dir)
    order_id = F.regexp_extract("key", '"order_id":([0-9]+)', 1).cast("int")
    clock = F.when(F.col("key").isNull() | (order_id % 10 != 0), F.date_trunc("year", "timestamp"))
    path = work_folder(spark, "log")
    append_log(decode(messages, clock=clock), path)
    return read_log(spark, path, since=SPLIT).agg(F.count("*").alias("n"))
