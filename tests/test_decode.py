import pytest
from tests.change_events import event, image
from pyspark.sql import functions as F

from tidemark import decode, decode_key, key_columns, message_status, row_images
from tidemark.functions import decode_json
from tidemark.operators import only_table
from tidemark.schemas import envelope

ROW = {"customer_id": 1, "order_id": 2, "price": 3, "product_id": 4, "quantity": 5}


@pytest.mark.parametrize("text", [None, ""])
def test_no_text_is_a_null_struct(feed_of, text):
    parsed = feed_of(text).select(decode_json("value", envelope()).alias("v")).first().v
    assert parsed is None


@pytest.mark.parametrize("text", ["{bad", "null", '[{"op":"c"}]', '{"Op":"c"}'])
def test_text_without_known_fields_is_a_struct_of_nulls(feed_of, text):
    parsed = feed_of(text).select(decode_json("value", envelope()).alias("v")).first().v
    assert parsed is not None and all(x is None for x in parsed)


@pytest.mark.parametrize("price", ["10.5", "3000000000", '"7"'])
def test_value_that_does_not_fit_is_null_and_the_row_stays(feed_of, price):
    text = '{"after":{"customer_id":1,"order_id":2,"price":%s,"product_id":4,"quantity":5},"op":"c"}' % price
    row = decode(feed_of(text)).first()
    assert row.after.asDict() == {**ROW, "price": None}
    assert row.op == "c"


@pytest.mark.parametrize(
    "text, column, expected",
    [
        ('{"source":{"pos":5}}', "source.pos", "5"),
        ('{"ts_ms":2}', "ts_ms", 2.0),
        ('{"transaction":{"id":"x"}}', "transaction", '{"id":"x"}'),
        ('{"op":"c","zz":1}', "op", "c"),
    ],
)
def test_conversions(feed_of, text, column, expected):
    assert decode(feed_of(text)).select(column).first()[0] == expected


def test_empty_image_is_an_image(feed_of):
    log = decode(feed_of('{"after":{},"before":{"order_id":1},"op":"c"}'))
    assert log.first().after.asDict() == dict.fromkeys(ROW)
    assert row_images(log).first().order_id is None


def test_every_message_is_a_row(feed_of, scenario):
    assert decode(feed_of(*scenario)).count() == 7


def test_binary_value(spark):
    feed = spark.createDataFrame([(bytearray(b'{"op":"u"}'),)], "value binary")
    assert decode(feed).first().op == "u"


def test_ingest_date(spark, feed_of):
    today = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd")).first()[0]
    assert decode(feed_of(None)).first().date == today
    log = decode(feed_of(None), clock=F.lit("2024-02-29 23:59:59").cast("timestamp"))
    assert log.first().date == "2024-02-29"
    assert dict(log.dtypes)["date"] == "string"


def test_text_is_parsed_once(feed_of):
    """Also when operators that use several of its fields stand on top of the parse."""
    plan = row_images(decode(feed_of("{}")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    plan = message_status(feed_of("{}")).filter("status = 'ok'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_status(feed_of, scenario):
    counts = message_status(feed_of(*scenario)).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in counts} == {"ok": 5, "tombstone": 1, "malformed": 1}


def test_key(spark):
    feed = spark.createDataFrame([('{"order_id": 1, "customer_id": 2}',), (None,)], "key string")
    assert [tuple(r) for r in decode_key(feed).collect()] == [(1, 2), (None, None)]


def test_key_columns():
    assert key_columns("a,b") == ["a", "b"]
    assert key_columns("a, b") == ["a", " b"]
    assert key_columns(["a"]) == ["a"]
    for nothing in ("", "a,", []):
        with pytest.raises(ValueError):
            key_columns(nothing)


def test_only_table(feed_of):
    row = image(1, 1, 1, 1, 1)
    log = decode(feed_of(event("c", None, row, 1, table="orders"), event("c", None, row, 1, table="customers"), None))
    assert only_table(log, "orders").count() == 1


def test_op_from_images(feed_of):
    row = image(1, 1, 1, 1, 1)
    log = decode(feed_of(event("c", None, row, 1), event("c", row, row, 2), event("c", row, None, 3)))
    assert [r.op for r in row_images(log, "images").orderBy("ts_ms").collect()] == ["c", "u", "d"]
    assert [r.op for r in row_images(log).collect()] == ["c", "c", "c"]
    with pytest.raises(ValueError):
        row_images(log, "guess")
