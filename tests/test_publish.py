import json

import pytest
from pyspark.sql import functions as F

from tidemark import current_state, decode, read_feed, to_change_feed, write_feed
from tidemark.operators import source_struct
from tidemark.schemas import ORDER_IMAGE, SOURCE


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(1, 2, 3, 4, 5)], ORDER_IMAGE)


def test_message_as_a_producer_writes_it(rows):
    message = to_change_feed(rows, "order_id,customer_id", "c", F.lit(7.5), source=source_struct(pos=9, ts_ms=7.5)).first()
    assert message.key == '{"order_id":2,"customer_id":1}'
    value = json.loads(message.value)
    assert list(value) == ["before", "after", "source", "op", "ts_ms", "transaction"]
    assert value["before"] is None and value["transaction"] is None
    assert value["after"] == {"customer_id": 1, "order_id": 2, "price": 3, "product_id": 4, "quantity": 5}
    assert value["op"] == "c" and value["ts_ms"] == 7.5
    assert value["source"] == {**dict.fromkeys(SOURCE.names), "pos": 9, "ts_ms": 7.5}


def test_nothing_is_made_up_about_the_source(rows):
    assert json.loads(to_change_feed(rows, "order_id", "c", F.lit(1.0)).first().value)["source"] is None


def test_delete_carries_the_old_image(rows):
    value = json.loads(to_change_feed(rows, "order_id", "d", F.lit(1.0)).first().value)
    assert value["after"] is None and value["before"]["order_id"] == 2


def test_update_carries_both(rows):
    old = F.struct(*[F.col(c) for c in ORDER_IMAGE.names])
    new = F.struct(*[(F.col(c) + 100 if c == "quantity" else F.col(c)).alias(c) for c in ORDER_IMAGE.names])
    value = json.loads(to_change_feed(rows, "order_id", "u", F.lit(1.0), old, new).first().value)
    assert (value["before"]["quantity"], value["after"]["quantity"]) == (5, 105)


def test_null_op_is_a_tombstone(rows):
    message = to_change_feed(rows, "order_id", F.lit(None).cast("string"), F.lit(1.0)).first()
    assert message.key == '{"order_id":2}' and message.value is None


def test_unknown_source_field():
    with pytest.raises(ValueError):
        source_struct(port=1)


def test_files_and_back(spark, rows, tmp_path):
    path = str(tmp_path / "feed")
    write_feed(to_change_feed(rows, "order_id", "c", F.lit(1.0)), path)
    write_feed(to_change_feed(rows, "order_id", "d", F.lit(2.0)), path)
    feed = read_feed(spark, path)
    assert feed.count() == 2
    assert current_state(decode(feed), "order_id").count() == 0


def test_text_feed(spark, rows, tmp_path):
    path = str(tmp_path / "feed")
    write_feed(to_change_feed(rows, "order_id", "c", F.lit(1.0)).select("value"), path, "text")
    assert [tuple(r) for r in current_state(decode(read_feed(spark, path, "text")), "order_id").collect()] == [
        (1, 2, 3, 4, 5, "c", 1.0)
    ]
