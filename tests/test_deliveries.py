import json
import os
import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.change_events import event, image
from tidemark import StateTable, decode, latest_per_key, read_log, row_images, run_ingest, stream_feed, write_feed
from tidemark.operators import distinct_events, late_field
from tidemark.schemas import envelope, log_schema
from tidemark.sources import append_log, check_append, noted_schema, read_feed, read_history, write_history
from tidemark.streaming import read_inferred, run_inferring_ingest, run_split_ingest
from tidemark.streaming import ingest as ingest_module


@pytest.fixture
def place(tmp_path):
    return {name: str(tmp_path / name) for name in ("feed", "log", "checkpoint", "rejects", "history")}


def placed(op, before, after, ts, pos, **more):
    return event(op, before, after, ts, **{"file": "log.1", "pos": str(pos), "row": "0", **more})


# Events delivered again


def test_what_counts_as_the_same_event(spark, feed_of):
    one, two = image(1, 1, 1, 1, 1), image(2, 2, 2, 2, 2)
    messages = feed_of(
        placed("c", None, one, 1.0, 5), placed("c", None, one, 2.0, 5),  # again, with another time
        placed("c", None, two, 1.0, 5, row="1"), placed("c", None, one, 1.0, 6), placed("u", one, one, 1.0, 5),
        event("c", None, one, 1.0), event("c", None, one, 1.0), event("c", None, one, 2.0), "{bad", "{bad", "{worse", None,
    )
    found = distinct_events(messages, "1 day")
    assert found.columns == decode(messages).columns and found.count() == 4 + 2 + 2 + 1


def test_state_is_bounded_by_the_time_within(spark, place):
    """Ten hours of messages, each hour's delivered again half an hour on; the state holds an hour or two."""
    messages = [json.dumps(placed("c", None, image(n, 1, 1, 1, 1), 1.0, n)) for n in range(1000)]
    kept = []
    for hour in range(10):
        own = messages[100 * hour : 100 * hour + 100]
        for text, minute in [(t, 10) for t in own] + [(t, 40) for t in own]:
            kept.append((None, text, f"2024-01-01 {hour:02d}:{minute}:00", hour))
    rows = spark.createDataFrame(kept, "key string, value string, at string, hour int").withColumn("timestamp", F.col("at").cast("timestamp_ntz"))
    query, seen = None, []
    for hour in range(10):
        write_feed(rows.filter(F.col("hour") == hour).select("key", "value", "timestamp").coalesce(1), place["feed"])
        query = run_ingest(
            stream_feed(spark, place["feed"]), place["log"], place["checkpoint"], available_now=True, distinct_within="1 hour"
        )
        query.awaitTermination()
        seen += [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert read_log(spark, place["log"]).count() == 1000
    assert 100 <= max(seen) <= 300
    assert "HDFSBacked" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    with open(f"{place['checkpoint']}/offsets/0") as offsets:
        assert "RocksDBStateStoreProvider" in offsets.read()


def test_a_replay_within_the_time_adds_nothing(spark, place, feed_of):
    values = [placed("c", None, image(n, 1, 1, 1, 1), 1.0, n) for n in range(20)] + [None, "{bad"]
    for _ in range(3):
        write_feed(feed_of(*values).withColumn("timestamp", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")), place["feed"])
        run_ingest(stream_feed(spark, place["feed"]), place["log"], place["checkpoint"], available_now=True, distinct_within="1 hour").awaitTermination()
    assert read_log(spark, place["log"]).count() == 22
    with pytest.raises(ValueError):
        run_ingest(stream_feed(spark, place["feed"]), place["log"], place["checkpoint"], distinct_within="1 hour", raw="raw")


# Events and rejects


def test_a_micro_batch_that_breaks_between_its_two_writes(spark, place, feed_of, monkeypatch):
    write_feed(feed_of(placed("c", None, image(1, 1, 1, 1, 1), 1.0, 1), None, "{bad", '{"op":"r"}'), place["feed"])

    def run():
        source = stream_feed(spark, place["feed"])
        run_split_ingest(source, place["log"], place["rejects"], place["checkpoint"], available_now=True).awaitTermination()

    def held():
        log = read_log(spark, place["log"]).select("op").collect()
        return sorted(r.op for r in log), [
            (name, os.path.getmtime(f"{place['log']}/{name}")) for name in sorted(os.listdir(place["log"])) if name.startswith("batch=")
        ]

    blocked = place["rejects"]
    with open(blocked, "w") as file:
        file.write("not a folder")
    with pytest.raises(StreamingQueryException):
        run()
    assert held()[0] == ["c", "r"]
    before = held()[1]
    os.remove(blocked)
    run()
    assert held() == (["c", "r"], before)
    rejects = spark.read.schema("key string, value string, status string").parquet(place["rejects"])
    assert sorted((r.status, r.value) for r in rejects.collect()) == [("malformed", "{bad"), ("tombstone", None)]
    run()
    assert held()[0] == ["c", "r"] and rejects.count() == 2
    with pytest.raises(ValueError, match="another checkpoint"):
        run_split_ingest(stream_feed(spark, place["feed"]), place["log"], place["rejects"], place["checkpoint"] + "2")


# Fields and types


def test_events_are_held_without_their_texts(spark, feed_of, place, monkeypatch):
    held, persist = [], DataFrame.persist

    def spy(df, *args):
        held.extend(df.select("status", "key", "value").collect())
        return persist(df, *args)

    monkeypatch.setattr(DataFrame, "persist", spy)
    write_feed(feed_of(event("c", None, image(1, 1, 1, 1, 1), 1.0), None, "{bad"), place["feed"])
    run_split_ingest(stream_feed(spark, place["feed"]), place["log"], place["rejects"], place["checkpoint"], available_now=True).awaitTermination()
    assert sorted((r.status, r.value) for r in held if r.value) == [("malformed", "{bad")]
    assert sorted(r.status for r in held) == ["malformed", "ok", "tombstone"]
    assert read_log(spark, place["log"]).count() == 1
    assert {(r.status, r.value) for r in spark.read.parquet(place["rejects"]).collect()} == {("tombstone", None), ("malformed", "{bad")}


def test_cores_share_the_files_of_a_feed(spark, place):
    """One file of 24 MB: no task gets more than a few row groups of it."""
    texts = spark.range(24).select(F.lit(None).cast("string").alias("key"), F.lit(None).cast("timestamp_ntz").alias("timestamp"), F.col("id"))
    noise = F.concat(*[F.sha2(F.concat_ws("-", "id", F.lit(k), "part"), 512) for k in range(8)])
    write_feed(texts.withColumn("part", F.explode(F.sequence(F.lit(1), F.lit(1000)))).select("key", noise.alias("value"), "timestamp").coalesce(1), place["feed"])
    rows = [n for n in read_feed(spark, place["feed"]).rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()]
    assert sum(rows) == 24_000 and max(rows) < 18_000


def test_late_fields(spark, feed_of):
    log = decode(feed_of({"op": "c", "x": {"y z": 5, "w": "7"}}, {"op": "c", "x": 3}, "{bad", None), raw="raw")
    found = log.select(late_field("x.y z", "int"), late_field("x.w", "int"), late_field("x.w", "string"), late_field("x", "string")).collect()
    assert [tuple(r) for r in found] == [(5, 7, "7", '{"w":"7","y z":5}'), (None, None, None, "3"), (None,) * 4, (None,) * 4]


@pytest.mark.parametrize(
    "kinds", [("int", "bigint"), ("smallint", "int", "decimal(20,0)"), ("float", "double"), ("decimal(5,2)", "decimal(9,4)"), ("bigint", "decimal(20,0)")]
)
def test_a_column_that_widens(spark, place, kinds):
    for k, kind in enumerate(kinds):
        image_type = T.StructType.fromDDL(f"id int, v {kind}")
        row = spark.createDataFrame([(k,)], "id int").select(
            F.struct("id", F.lit(k + 1).cast(kind).alias("v")).alias("after"), F.lit(None).cast(image_type).alias("before"),
            F.lit("2024-01-01").alias("date"),
        )
        append_log(row, place["log"])
    log = read_log(spark, place["log"], noted_schema(spark, place["log"]))
    assert sorted((r.id, float(r.v)) for r in log.select("after.id", "after.v").collect()) == [(k, k + 1.0) for k in range(len(kinds))]
    assert log.schema["after"].dataType["v"].dataType.simpleString() == kinds[-1]
    with pytest.raises(ValueError, match="after.v"):
        append_log(row.withColumn("after", F.struct(F.lit(1).alias("id"), F.lit(1).cast(kinds[0]).alias("v"))), place["log"])


@pytest.mark.parametrize("held,given", [("bigint", "int"), ("int", "string"), ("double", "float"), ("bigint", "decimal(10,0)"), ("string", "int"), ("int", "double")])
def test_types_that_do_not_hold_what_is_there(spark, place, held, given):
    append_log(spark.sql(f"SELECT CAST(1 AS {held}) v, '2024-01-01' date"), place["log"])
    with pytest.raises(ValueError, match="v is"):
        check_append(spark, place["log"], T.StructType.fromDDL(f"v {given}"))
    with pytest.raises(ValueError, match="no notes"):
        noted_schema(spark, place["feed"])


def test_inferred_types_change_on_the_way(spark, place, feed_of):
    """Nothing but null, whole numbers, fractions, text and objects in turn; and a micro-batch without any object."""
    turns = [["{bad", None], [{"a": None}], [{"a": 1, "b": {"c": 1}}], ["[1]"], [{"a": 2.5, "b": {"d": "x"}}], [{"a": "t", "b": None}], [{"a": {"z": 1}}]]
    for values in turns:
        write_feed(feed_of(*values), place["feed"])
        run_inferring_ingest(stream_feed(spark, place["feed"]), place["log"], place["checkpoint"], available_now=True).awaitTermination()
    found = read_inferred(spark, place["log"])
    assert dict(found.dtypes) == {"a": "string", "b": "struct<c:bigint,d:string>", "date": "string"}
    rows = sorted((r.a, r.b and tuple(r.b)) for r in found.collect() if r.a is not None)
    assert rows == [("1", (1, None)), ("2.5", (None, "x")), ("t", None), ('{"z":1}', None)]
    assert found.count() == 6


def test_a_broken_micro_batch_keeps_its_type(spark, place, feed_of):
    write_feed(feed_of({"a": 1}), place["feed"])

    def run(clock=None):
        source = stream_feed(spark, place["feed"])
        run_inferring_ingest(source, place["log"], place["checkpoint"], clock, available_now=True).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run(F.expr("CAST(raise_error('no') AS date)"))
    assert [n for n in os.listdir(f"{place['log']}/_types") if n.endswith(".json") and not n.startswith(".")] == ["0.json"]
    with pytest.raises(FileNotFoundError):
        read_inferred(spark, place["log"])
    run()
    assert read_inferred(spark, place["log"]).select("a").collect()[0].a == 1
    with pytest.raises(FileNotFoundError):
        read_inferred(spark, place["history"])


# History of few keys


def test_row_groups_without_the_key_are_not_read(spark, sf_dir, place):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    row = F.struct(F.col("o_orderkey").cast("int").alias("id"), F.col("o_custkey").cast("int").alias("v"))
    log = orders.select(row.alias("after"), F.lit(None).cast("struct<id:int,v:int>").alias("before"), F.lit(1.0).alias("ts_ms"), F.lit("2024-01-01").alias("date"))
    write_history(log.union(log), place["history"], "id", group_bytes=1 << 14, distinct_keys=1000)
    wanted = [{"id": r.o_orderkey} for r in orders.limit(2).collect()]
    found = read_history(spark, place["history"], wanted)
    plan = found._jdf.queryExecution().executedPlan()
    assert len(found._jdf.queryExecution().executedPlan().executeCollect()) == 4
    (scan,) = re.findall(r"PushedFilters: \[(.*)\]", plan.toString()) or [""]
    read = plan.collectLeaves().head().metrics().apply("numOutputRows").value()
    assert "id" in scan and 4 <= read < orders.count() / 2
    assert read_history(spark, place["history"], []).count() == 0
    assert read_history(spark, place["history"], wanted, since="2024-01-02").count() == 0
    assert read_history(spark, place["history"], [{"id": None}], until="2024-01-01").count() == 0
    with pytest.raises(ValueError):
        write_history(log.withColumn("id", F.lit(1)), place["history"], "id")


# Deletes that are forgotten


@pytest.mark.parametrize("buckets", [None, 3])
def test_watermark_of_a_table(spark, tmp_path, feed_of, buckets):
    def changes(*values):
        return latest_per_key(row_images(decode(feed_of(*values)), position=True), "order_id")

    def left():
        return sorted((r.order_id, r.op) for r in table.rows().collect())

    table = StateTable(spark, str(tmp_path / "t"), "order_id", buckets=buckets)
    one, two, three = (image(n, 1, 1, 1, 1) for n in (1, 2, 3))
    table.add_changes(changes(event("d", one, None, 10.0), event("d", two, None, 20.0), event("c", None, three, 5.0)), 0)
    assert table.fold() == 1 and table.watermark() is None and left() == [(1, "d"), (2, "d"), (3, "c")]
    assert table.fold(forget_before=15.0) == 1 and table.watermark() == 15.0 and left() == [(2, "d"), (3, "c")]
    assert table.fold(forget_before=12.0) == 1 and table.watermark() == 15.0
    stale = [event("c", None, one, 9.0), event("c", None, two, 16.0), event("c", None, image(4, 1, 1, 1, 1), None)]
    table.add_changes(changes(*stale), 1)
    assert left() == [(2, "d"), (3, "c")]  # below the watermark, or older than its delete
    table.add_changes(changes(event("u", three, three, 30.0)), 2)
    assert table.fold(forget_before=25.0) == 3 and left() == [(3, "u")] and table.watermark() == 25.0
    assert table.apply(changes(event("d", three, None, 40.0)), forget_before=50.0) == 4 and left() == [] and table.watermark() == 50.0
