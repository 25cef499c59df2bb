import json
import os
import re

import pytest
from tests.change_events import event, image

from pyspark.errors import StreamingQueryException

from tidemark import (
    StateTable,
    current_state,
    decode,
    read_feed,
    read_log,
    run_bronze,
    run_ingest,
    run_state_stream,
    stream_feed,
    stream_log,
)
from tidemark.__main__ import main
from tidemark.schemas import state_envelope
from tidemark.sources import append_log

KEYS = "order_id,customer_id"
EXPECTED = [(1, 1, 100, 1, 1, "c", 10.0), (2, 2, 100, 2, 200, "u", 1010.3)]


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


@pytest.fixture
def send(feed_of, place):
    """Append messages to the feed, one file each."""

    def write(*values):
        for value in values:
            feed_of(value).coalesce(1).write.mode("append").parquet(place("feed"))

    return write


def ingest(spark, place, **options):
    feed = stream_feed(spark, place("feed"), maxFilesPerTrigger=2)
    query = run_ingest(feed, place("log"), place("checkpoint"), available_now=True, **options)
    query.awaitTermination()
    return query


def rows_of(table):
    return sorted(map(tuple, table.read().collect()))


def test_ingest_and_restart(spark, place, send, scenario):
    send(*scenario[:4])
    ingest(spark, place)
    assert read_log(spark, place("log")).count() == 4
    ingest(spark, place)
    assert read_log(spark, place("log")).count() == 4
    send(*scenario[4:])
    ingest(spark, place)
    log = read_log(spark, place("log"))
    assert log.count() == 7
    assert sorted(map(tuple, current_state(log, KEYS).collect())) == EXPECTED
    assert [name for name in os.listdir(place("log")) if name.startswith("date=")]


def test_text_stream(spark, place, feed_of, scenario):
    feed_of(*[value for value in scenario if value]).select("value").write.text(place("feed"))
    feed = stream_feed(spark, place("feed"), "text")
    run_ingest(feed, place("log"), place("checkpoint"), available_now=True).awaitTermination()
    log = read_log(spark, place("log"))
    assert sorted(map(tuple, current_state(log, KEYS).collect())) == EXPECTED


def test_log_of_another_checkpoint_is_refused(spark, place, send, scenario, feed_of):
    send(*scenario)
    ingest(spark, place)
    with pytest.raises(ValueError, match="another checkpoint"):
        run_ingest(stream_feed(spark, place("feed")), place("log"), place("other"), available_now=True)
    with pytest.raises(ValueError, match="written by a stream"):
        append_log(decode(feed_of("{}")), place("log"))


@pytest.mark.parametrize("fold_every", [1, None])
def test_state_stream(spark, place, send, scenario, fold_every):
    table = StateTable(spark, place("state"), KEYS)
    arrivals = [scenario[4], scenario[3], None, scenario[2], scenario[0], "{bad", scenario[1], scenario[0]]

    def run():
        events = decode(stream_feed(spark, place("feed"), maxFilesPerTrigger=2))
        run_state_stream(events, table, fold_every=fold_every, available_now=True).awaitTermination()

    send(*arrivals[:4])
    run()
    run()
    send(*arrivals[4:])
    run()
    assert rows_of(table) == EXPECTED
    assert (len(table.pending()) > 0) == (fold_every is None)


def test_replayed_micro_batch(spark, place, send, scenario):
    """The state was written but the checkpoint's commit was lost."""
    table = StateTable(spark, place("state"), KEYS)

    def run():
        events = decode(stream_feed(spark, place("feed")))
        run_state_stream(events, table, fold_every=1, available_now=True).awaitTermination()

    send(*scenario[:3])
    run()
    send(*scenario[3:])
    run()
    assert rows_of(table) == EXPECTED
    checkpoint = table.checkpoint()[0].removeprefix("file:")
    last = max(int(name) for name in os.listdir(f"{checkpoint}/commits") if name.isdigit())
    os.remove(f"{checkpoint}/commits/{last}")
    crc = f"{checkpoint}/commits/.{last}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    before = table.version()
    run()
    assert table.version() == before and rows_of(table) == EXPECTED


def test_stream_goes_on_from_a_batch_built_table(spark, place, send, scenario, feed_of):
    table = StateTable(spark, place("state"), KEYS)
    append_log(decode(feed_of(*scenario[:3])), place("old"))
    run_bronze(spark, place("old"), table)
    run_bronze(spark, place("old"), table)
    send(*scenario[3:], event("c", None, image(4, 4, 4, 4, 4), 1.0))
    ingest(spark, place)
    for _ in range(2):
        run_state_stream(stream_log(spark, place("log")), table, available_now=True).awaitTermination()
    assert rows_of(table) == [*EXPECTED, (4, 4, 4, 4, 4, "c", 1.0)]
    assert table.checkpoint()[1] == 2
    with pytest.raises(ValueError, match="fed by a stream"):
        run_bronze(spark, place("old"), table)


class Recorder:
    """Stands in for a session whose Kafka connector is missing here."""

    def __init__(self):
        self.asked = {}

    read = readStream = property(lambda self: self)

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **options):
        self.asked.update(options)
        return self

    def load(self, *path):
        return self.asked


def test_kafka_stream_options():
    asked = stream_feed(Recorder(), fmt="kafka", servers="a:1,b:2", topic="t", minPartitions=64)
    assert asked == {
        "format": "kafka",
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "minPartitions": 64,
    }
    assert stream_feed(Recorder(), fmt="kafka", servers="a:1", topic="t", fail_on_data_loss=True)["failOnDataLoss"] == "true"
    asked = stream_feed(Recorder(), fmt="kafka", servers="a:1", topic="t", startingOffsets="latest")
    assert asked["startingOffsets"] == "latest"


def test_kafka_batch_options():
    assert read_feed(Recorder(), fmt="kafka", servers="a:1", topic="t") == {
        "format": "kafka",
        "kafka.bootstrap.servers": "a:1",
        "subscribe": "t",
    }


def test_command_line(spark, place, send, scenario, monkeypatch):
    send(*scenario)
    monkeypatch.setenv("TABLE_NAME", "orders")
    monkeypatch.setenv("TABLE_KEY", KEYS)
    feed = ["--feed-format", "parquet", "--feed-path", place("feed")]
    root = ["--root", place("out")]
    main(["ingest", *feed, *root, "--available-now"])
    main(["bronze", *root])
    main(["bronze", *root])
    assert rows_of(StateTable(spark, place("out/bronze/orders"), KEYS)) == EXPECTED
    assert os.listdir(place("out/bronze/backup/orders"))
    main(["extract", *feed, "--out", place("output")])
    assert spark.read.parquet(place("output")).count() == 7


def test_command_line_publish(spark, place):
    spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string").write.parquet(place("rows"))
    feed = ["--feed-format", "parquet", "--feed-path", place("feed")]
    main(["publish", "--rows", place("rows"), "--keys", "id", "--source-table", "people", *feed])
    where = ["--root", place("out"), "--table", "people", "--image", "id INT, name STRING"]
    main(["ingest", *feed, *where, "--available-now"])
    main(["bronze", "--keys", "id", *where])
    rows = StateTable(spark, place("out/bronze/people"), "id").read().select("id", "name", "op").collect()
    assert sorted(map(tuple, rows)) == [(1, "x", "c"), (2, "y", "c")]


def test_command_line_state_and_image(spark, place, feed_of):
    def send(name, ts):
        value = json.dumps(event("c", None, {"id": 1, "name": name}, ts))
        feed_of(value).write.mode("append").parquet(place("feed"))
        main(["ingest", "--feed-format", "parquet", "--feed-path", place("feed"), *common])
        main(["state", "--keys", "id", *common])

    where = ["--root", place("out"), "--table", "people"]
    common = [*where, "--image", "id INT, name STRING", "--available-now"]
    table = StateTable(spark, place("out/bronze/people"), "id")
    send("x", 1.0)
    send("y", 2.0)
    assert table.version() is None and rows_of(table) == [(1, "y", "c", 2.0)]
    main(["fold", "--keys", "id", *where])
    assert table.version() == 2 and rows_of(table) == [(1, "y", "c", 2.0)]


def test_fold_while_the_stream_goes_on(spark, place, send, scenario):
    """Another process folds between the stream's batches."""
    table = StateTable(spark, place("state"), KEYS)
    for values in (scenario[4:], scenario[2:4], scenario[:2]):
        send(*values)
        events = decode(stream_feed(spark, place("feed")), state_envelope())
        run_state_stream(events, table, available_now=True).awaitTermination()
        StateTable(spark, place("state"), KEYS).fold()
    assert table.pending() == [] and rows_of(table) == EXPECTED


@pytest.mark.parametrize("fold_every", [1, None])
def test_table_replaced_between_runs_of_its_stream(spark, place, send, scenario, fold_every):
    """The stream's next batch must not pass for one the replacement already holds."""
    table = StateTable(spark, place("state"), KEYS)
    for values in (scenario[4:], scenario[2:4], scenario[:2]):
        send(*values)
        events = decode(stream_feed(spark, place("feed")), state_envelope())
        run_state_stream(events, table, fold_every=fold_every, available_now=True).awaitTermination()
        for _ in range(2):
            table.replace(table.rows().filter("op <> 'd' OR ts_ms > 0"))
    assert table.pending() == [] and rows_of(table) == EXPECTED
    table.replace(table.rows().filter("op <> 'd'"))
    assert table.rows().count() == 2 and rows_of(table) == EXPECTED


def test_state_stream_reads_only_what_it_needs(spark, place, send, scenario):
    send(*scenario)
    ingest(spark, place)
    table = StateTable(spark, place("state"), KEYS)
    query = run_state_stream(stream_log(spark, place("log")), table, available_now=True)
    query.awaitTermination()
    plan = query._jsq.explainInternal(True)
    schema = re.findall(r"ReadSchema: (\S+)", plan)[-1]
    assert "source:struct<file:string,pos:string,row:string,ts_ms:double>" in schema and "transaction" not in schema


@pytest.mark.parametrize("step", ["add_changes", "fold", "_clean_up"])
@pytest.mark.parametrize("before", [True, False])
def test_stream_that_broke_goes_on(spark, place, send, scenario, step, before):
    """Killed before or after each step of a micro-batch."""

    class Breaking(StateTable):
        pass

    def fail(self, *args):
        if not before:
            getattr(StateTable, step)(self, *args)
        raise RuntimeError("lost")

    setattr(Breaking, step, fail)
    send(*scenario[2:])
    events = decode(stream_feed(spark, place("feed")), state_envelope())
    sound = StateTable(spark, place("state"), KEYS)
    run_state_stream(events, sound, fold_every=1, available_now=True).awaitTermination()
    send(*scenario[:2])
    with pytest.raises(StreamingQueryException):
        broken = Breaking(spark, place("state"), KEYS)
        run_state_stream(events, broken, fold_every=1, available_now=True).awaitTermination()
    run_state_stream(events, sound, fold_every=1, available_now=True).awaitTermination()
    assert rows_of(sound) == EXPECTED


def test_running_stream(spark, place, send, scenario):
    """Not a run to the end but a stream that waits for more."""
    send(*scenario[:3])
    feed = stream_feed(spark, place("feed"))
    query = run_ingest(feed, place("log"), place("checkpoint"), every="100 milliseconds")
    try:
        query.processAllAvailable()
        assert read_log(spark, place("log")).count() == 3
        send(*scenario[3:])
        query.processAllAvailable()
    finally:
        query.stop()
    assert read_log(spark, place("log")).count() == 7
