import hashlib
import os

import pytest
import zstandard
from pyspark.errors import PySparkException

from tests.llm.conftest import bag
from tidemark.llm.warc import Bundle, BundleReader, parse_record, read_index, read_warc, record, revisit_plan, write_warc
from tidemark.sources import shared_folder

BIG = "<p>" + "x" * 1200 + "</p>"
ODD = [
    (1, "http://a/", "small"), (2, "http://b/", "small"), (3, None, None), (4, "http://c/", ""), (5, "u", BIG), (6, "u2", BIG),
    (6, "u2", BIG), (None, "no id", BIG), (None, None, "tiny"), (7, "weird\r\nurl", "é😀\r\n\r\n" + BIG), (8, "h", "y" * 2_000_000), (9, "x", BIG[:-1]),
]


def brute(rows):
    last = {}
    for i, _, html in rows:
        if len((html or "").encode()) >= 1000 and i is not None:
            last[html] = max(last.get(html, i), i)
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        refers_to = last.get(html) if len(body) >= 1000 and i != last.get(html) else None
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "response" if refers_to is None else "revisit", refers_to))
    return out


def seen(found):
    return [(r.page_id, r.payload_bytes, bytes(r.digest).hex(), r.record_type, r.refers_to) for r in found.collect()]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "d", 1) for r in ODD], "page_id long, url string, html string, digest string, key int").repartition(3)


@pytest.mark.parametrize("frame,bundle", [(1 << 20, 32 << 20), (500, 900)])
def test_round_trip(spark, pages, frame, bundle):
    path = shared_folder(spark, "warc")
    write_warc(pages, path, frame_bytes=frame, bundle_bytes=bundle)
    found = read_warc(spark, path)
    assert bag(seen(found)) == bag(brute(ODD))
    texts = {r.page_id: r.payload for r in found.collect() if r.record_type == "response"}
    assert bytes(texts[7]).decode() == ODD[9][2] and bytes(texts[8]) == b"y" * 2_000_000 and bytes(texts[3]) == b""
    places = read_index(spark, path).collect()
    assert len(places) == len(ODD) and len({(p.file, p.frame, p.offset) for p in places}) == len(ODD)
    assert {r.page_id for r in read_warc(spark, path, {5, 9, 77}).collect()} == {5, 9}


def test_files_are_plain_zstandard(spark, pages):
    """Any decoder reads the records one after the other; the seek table is skipped."""
    path = shared_folder(spark, "warc")
    write_warc(pages, path, frame_bytes=500)
    folder, records = path.removeprefix("file:"), 0
    for name in os.listdir(folder):
        if name.startswith("part"):
            with open(f"{folder}/{name}", "rb") as data:
                text = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
            records += text.count(b"WARC/1.1\r\n")
            assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
    assert records == len(ODD)


def test_documents(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = shared_folder(spark, "warc")
    write_warc(pages, path)
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert bag(seen(read_warc(spark, path))) == bag(brute(rows))


def test_a_payload_of_a_third_of_all_pages(spark):
    pages = spark.range(3000).selectExpr("id page_id", "'u' url", f"if(id % 3 = 0, '{BIG}', concat(id, '{BIG}')) html")
    path = shared_folder(spark, "warc")
    write_warc(pages, path)
    found = read_warc(spark, path)
    assert found.filter("refers_to = 2997").count() == 999 and found.filter("record_type = 'response'").count() == 2001


def test_nothing(spark, pages):
    path = shared_folder(spark, "warc")
    write_warc(pages.limit(0), path)
    assert read_warc(spark, path).count() == 0 and read_index(spark, path).count() == 0


def test_only_the_wanted_frame_is_unpacked():
    bundle = Bundle(frame_bytes=100)
    for i in range(20):
        bundle.add(i, record(i, f"http://{i}/", b"z" * 50, b"0" * 20, None))
    reader = BundleReader(bundle.file())
    frames = []
    unpack = reader.frame
    reader.frame = lambda number: frames.append(number) or unpack(number)
    ((page_id, found),) = reader.records({13})
    assert page_id == 13 and found["payload"] == b"z" * 50 and len(frames) == 1 and len(reader.starts) > 10


def test_records_and_damage():
    data = record(5, "http://a/", b"\r\n\r\nbody", hashlib.sha1(b"\r\n\r\nbody").digest(), None)
    assert parse_record(data)["payload"] == b"\r\n\r\nbody"
    revisit = parse_record(record(5, None, b"body", b"0" * 20, 9))
    assert revisit["headers"]["WARC-Refers-To-Page-ID"] == "9" and revisit["payload"] == b""
    with pytest.raises(ValueError):
        BundleReader(b"0" * 100)


def test_a_changed_payload_is_noticed(spark):
    path = shared_folder(spark, "warc").removeprefix("file:")
    os.makedirs(path)
    bundle = Bundle()
    bundle.add(1, record(1, "u", b"body", b"0" * 20, None))
    with open(f"{path}/part-0.txt", "wb") as out:
        out.write(bundle.file())
    with pytest.raises(PySparkException, match="does not have its digest"):
        read_warc(spark, path).collect()


def test_columns_by_the_names_of_the_plan(spark):
    pages = spark.createDataFrame([(1, "u", BIG, "d", 7), (2, "u", BIG, "d", 8)], "page_id long, url string, html string, digest string, refers_to int")
    found = revisit_plan(pages)
    assert found.columns == [*pages.columns, "_digest", "_refers_to"]
    assert sorted((r.page_id, r.digest, r._refers_to) for r in found.collect()) == [(1, "d", 2), (2, "d", None)]
