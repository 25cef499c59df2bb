import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from tests.change_events import event, image
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import StateTable, decode, latest_per_key, read_log, row_images, run_bronze
from tidemark.schemas import ORDER_IMAGE, envelope, log_schema
from tidemark.sources import append_log, check_append, read_if_present, shared_folder

EXPECTED = [(1, 1, 100, 1, 1, "c", 10.0), (2, 2, 100, 2, 200, "u", 1010.3)]


def folder(table):
    return table.path.removeprefix("file:")


def rows_of(table):
    return sorted(map(tuple, table.read().collect()))


def changes(feed_of, *values):
    return latest_per_key(row_images(decode(feed_of(*values)), position=True), "order_id")


@pytest.fixture
def table(spark, tmp_path):
    return StateTable(spark, str(tmp_path / "state"), "order_id")


def test_nothing_yet(table):
    assert table.version() is None and table.pending() == [] and table.rows() is None
    assert table.next_batch() == 0 and table.fold() is None and table.backup("/nowhere") is None
    with pytest.raises(FileNotFoundError):
        table.read()


def test_batches_and_versions(table, feed_of, scenario):
    for batch, value in enumerate(scenario[:5]):
        table.add_changes(changes(feed_of, value), batch)
    assert table.version() is None and table.pending() == [0, 1, 2, 3, 4]
    assert rows_of(table) == EXPECTED
    assert table.fold() == 5 and table.pending() == []
    assert rows_of(table) == EXPECTED
    assert table.rows().count() == 3  # the delete is kept


def test_late_create_does_not_undo_a_delete(spark, tmp_path, feed_of, scenario):
    table = StateTable(spark, str(tmp_path / "state"), "order_id")
    for batch, value in enumerate([scenario[4], scenario[3], scenario[2], scenario[1], scenario[0]]):
        table.add_changes(changes(feed_of, value), batch)
        if batch in (0, 3):
            table.fold()
    assert table.version() == 4 and table.pending() == [4]
    assert rows_of(table) == EXPECTED


def test_changes_applied_at_once(spark, table, feed_of, scenario):
    unranked = row_images(decode(feed_of(*scenario[:4])), position=True)
    assert table.apply(unranked) == 1
    table.add_changes(changes(feed_of, scenario[4]), 1)
    assert table.apply(row_images(decode(feed_of(*scenario[:1])), position=True)) == 2
    assert table.pending() == [] and rows_of(table) == EXPECTED


def test_a_column_named_like_the_position_is_refused(spark, table):
    rows = spark.createDataFrame([(1, 2, "c", 1.0)], "order_id int, _position int, op string, ts_ms double")
    for write in (table.replace, table.apply, lambda rows: table.add_changes(rows, 0)):
        with pytest.raises(ValueError, match="_position"):
            write(rows)


def test_repeated_batch(table, feed_of, scenario):
    table.add_changes(changes(feed_of, *scenario[:3]), 0)
    table.add_changes(changes(feed_of, *scenario[:3]), 0)
    table.fold()
    table.add_changes(changes(feed_of, *scenario), 0)  # folded already
    assert table.pending() == []
    table.add_changes(changes(feed_of, *scenario), 1)
    assert rows_of(table) == EXPECTED


def test_deleted_rows_forgotten(table, feed_of, scenario):
    table.replace(changes(feed_of, *scenario))
    table.replace(table.rows().filter("op <> 'd' OR ts_ms >= 3000"))
    assert table.rows().count() == 2 and rows_of(table) == EXPECTED


def test_folds_at_the_same_time(spark, table, feed_of, scenario):
    table.replace(changes(feed_of, *scenario[:2]))
    table.add_changes(changes(feed_of, *scenario[2:]), 1)
    others = [StateTable(spark, table.path, "order_id", buckets=n) for n in (None, 2, None, 3)]
    with ThreadPoolExecutor(4) as pool:
        assert set(pool.map(StateTable.fold, others)) == {2}
    assert table.versions() == [1, 2] and table.pending() == []
    assert rows_of(table) == EXPECTED
    table.add_changes(changes(feed_of, *scenario[:1]), 2)
    assert table.fold() == 3 and rows_of(table) == EXPECTED


def test_new_column_in_a_batch(spark, table):
    old = "order_id int, quantity int, op string, ts_ms double"
    table.add_changes(spark.createDataFrame([(1, 1, "c", 1.0)], old), 0)
    table.fold()
    table.add_changes(spark.createDataFrame([(2, 1, "c", 1.0)], old), 1)
    table.add_changes(spark.createDataFrame([(1, 5, "u", 2.0, "x")], old + ", note string"), 2)
    found = {r.order_id: (r.quantity, r.note) for r in table.read().collect()}
    assert found == {1: (5, "x"), 2: (1, None)}


def test_column_type_changes_between_batches(spark, table):
    schema = "order_id int, quantity {}, op string, ts_ms double"
    table.add_changes(spark.createDataFrame([(1, 1, "c", 1.0)], schema.format("int")), 0)
    table.add_changes(spark.createDataFrame([(2, 5 << 40, "c", 1.0)], schema.format("bigint")), 1)
    assert {r.order_id: r.quantity for r in table.read().collect()} == {1: 1, 2: 5 << 40}
    table.fold()
    table.add_changes(spark.createDataFrame([(1, 2, "u", 2.0)], schema.format("int")), 2)
    assert {r.order_id: r.quantity for r in table.read().collect()} == {1: 2, 2: 5 << 40}


@pytest.mark.parametrize("buckets", [None, 2])
def test_relative_path(spark, tmp_path, feed_of, scenario, buckets):
    table = StateTable(spark, os.path.relpath(tmp_path / "state"), "order_id", buckets=buckets)
    table.replace(changes(feed_of, *scenario[:3]))
    table.add_changes(changes(feed_of, *scenario[3:]), 1)
    assert rows_of(table) == EXPECTED and os.listdir(tmp_path / "state")


def test_failed_write_leaves_the_table_as_it_was(spark, table, feed_of, scenario):
    table.replace(changes(feed_of, *scenario))
    broken = table.rows().withColumn("price", F.when(F.col("order_id") == 2, F.raise_error(F.lit("lost"))).otherwise(1))
    for _ in range(2):
        with pytest.raises(PySparkException):
            table.replace(broken.withColumn("price", F.col("price").cast("int")))
        assert table.version() == 1 and rows_of(table) == EXPECTED
    with pytest.raises(PySparkException):
        table.add_changes(broken, 1)
    assert table.pending() == [] and rows_of(table) == EXPECTED
    assert table.replace(table.rows()) == 2 and rows_of(table) == EXPECTED


def test_old_versions_go(table, feed_of, scenario):
    for n in range(4):
        table.add_changes(changes(feed_of, *scenario), n)
        table.fold()
    assert table.versions() == [1, 2, 3, 4]
    table.vacuum()
    assert table.versions() == [1, 2, 3, 4]
    table.vacuum(retain_hours=0)
    assert table.versions() == [4]
    assert os.listdir(f"{folder(table)}/changes") == []
    assert rows_of(table) == EXPECTED
    with pytest.raises(ValueError):
        StateTable(table.spark, table.path, "order_id", retain_hours=-1)


def test_a_reader_finishes_while_others_write(table, feed_of, scenario):
    table.replace(changes(feed_of, *scenario))
    reader = table.read()
    for n in range(3):
        table.add_changes(changes(feed_of, event("u", None, image(1, 1, 9, 9, 9), 9e9 + n)), table.next_batch())
        table.fold()
    assert sorted(map(tuple, reader.collect())) == EXPECTED


def test_backup(spark, table, feed_of, scenario, tmp_path):
    table.replace(changes(feed_of, *scenario))
    root = str(tmp_path / "backup")
    assert table.backup(root, "2024-01-01") == f"file:{root}/2024-01-01"
    table.add_changes(changes(feed_of, event("d", image(1, 1, 1, 1, 100), None, 9e9)), table.next_batch())
    assert rows_of(table) == EXPECTED[1:]
    copy = spark.read.parquet(f"{root}/2024-01-01")
    assert copy.filter("op <> 'd'").count() == 2
    table.backup(root, "2024-01-01")
    assert spark.read.parquet(f"{root}/2024-01-01").filter("op <> 'd'").count() == 1
    assert os.path.basename(table.backup(root)).count("-") == 2


def test_failed_backup_leaves_the_one_before(spark, tmp_path):
    """A task of the second copy of the day fails."""
    root = str(tmp_path / "backup")
    table = StateTable(spark, str(tmp_path / "state"), "k")
    table.replace(spark.range(2000).selectExpr("id k", "'c' op", "1D ts_ms"))
    table.backup(root, "2024-01-01")
    table.replace(table.rows())
    base = sorted(path for path in (tmp_path / "state" / "base").iterdir() if path.name.startswith("v=2"))[0]
    part = next(path for path in base.iterdir() if path.name.startswith("part"))
    data = bytearray(part.read_bytes())
    data[4:200] = bytes(196)
    part.write_bytes(bytes(data))
    (base / f".{part.name}.crc").unlink()
    with pytest.raises(Exception):
        table.backup(root, "2024-01-01")
    assert spark.read.parquet(f"{root}/2024-01-01").count() == 2000
    assert os.listdir(root) == ["2024-01-01"]


def test_shared_folder_is_required(spark):
    class Bare:
        master = "local[2]"

        def get(self, name, default=None):
            return default

        def getCheckpointDir(self):  # noqa: N802
            return None

        conf = sparkContext = property(lambda self: self)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Bare(), "x")


def test_shared_folder(spark):
    one, other = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one != other and one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_plain_table_taken_over(spark, table, feed_of, scenario, tmp_path):
    plain, empty = str(tmp_path / "plain"), tmp_path / "empty"
    empty.mkdir()
    assert read_if_present(spark, plain) is None and read_if_present(spark, str(empty)) is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_if_present(spark, str(tmp_path / "broken"))
    row_images(decode(feed_of(*scenario[:2]))).write.parquet(plain)
    table.replace(read_if_present(spark, plain))
    table.add_changes(changes(feed_of, *scenario), table.next_batch())
    assert rows_of(table) == EXPECTED


# The log


WIDE = T.StructType([*ORDER_IMAGE.fields, T.StructField("note", T.StringType())])


def test_log_gains_a_column(spark, feed_of, tmp_path):
    path = str(tmp_path / "log")
    append_log(decode(feed_of(event("c", None, image(1, 1, 1, 1, 1), 1.0))), path)
    row = {**image(2, 2, 2, 2, 2), "note": "n"}
    append_log(decode(feed_of(event("c", None, row, 1.0)), envelope(WIDE)), path)
    for log in (read_log(spark, path, log_schema(WIDE)), read_log(spark, path, merge_schema=True)):
        assert {r.order_id: r.note for r in row_images(log).collect()} == {1: None, 2: "n"}
        assert dict(log.dtypes)["date"] == "string"
    assert read_log(spark, path).select("after.*").columns == ORDER_IMAGE.names


def test_log_refuses_another_type(spark, feed_of, tmp_path):
    path = str(tmp_path / "log")
    append_log(decode(feed_of(event("c", None, image(1, 1, 1, 1, 1), 1.0))), path)
    other = T.StructType([T.StructField("price", T.StringType())])
    with pytest.raises(ValueError, match="after.price is int, not string"):
        append_log(decode(feed_of("{}"), envelope(other)), path)
    check_append(spark, path, envelope(WIDE))
    assert read_log(spark, path).count() == 1


def test_log_refuses_a_type_that_an_older_date_has(spark, feed_of, tmp_path):
    """Day 2 lacks the column whose type day 3 changes; a row without a date is there too."""
    path = str(tmp_path / "log")

    def kind(**fields):
        return envelope(T.StructType([T.StructField(name, k) for name, k in fields.items()]))

    with_x, without, other = kind(x=T.IntegerType()), kind(y=T.IntegerType()), kind(x=T.StringType())
    append_log(decode(feed_of("{}"), with_x, F.lit("2024-01-01").cast("date")), path)
    append_log(decode(feed_of("{}"), without, F.lit("2024-01-02").cast("date")), path)
    append_log(decode(feed_of("{}"), without, F.lit(None).cast("date")), path)
    with pytest.raises(ValueError, match="after.x is int, not string"):
        append_log(decode(feed_of("{}"), other, F.lit("2024-01-03").cast("date")), path)
    assert read_log(spark, path, merge_schema=True).count() == 3
    assert set(read_log(spark, path, merge_schema=True).schema["after"].dataType.names) == {"x", "y"}


def test_columns_of_a_log_without_notes_are_found(spark, feed_of, tmp_path):
    path = str(tmp_path / "log")
    decode(feed_of("{}"), clock=F.lit("2024-01-01").cast("date")).write.partitionBy("date").parquet(path)
    other = T.StructType([T.StructField("price", T.StringType())])
    with pytest.raises(ValueError, match="after.price is int, not string"):
        append_log(decode(feed_of("{}"), envelope(other)), path)
    append_log(decode(feed_of("{}")), path)
    assert read_log(spark, path).count() == 2


def test_rows_without_a_clock_or_date_are_not_lost(spark, feed_of, tmp_path):
    path = str(tmp_path / "log")
    append_log(decode(feed_of("{}", "{}", "{}"), clock=F.lit(None).cast("timestamp")), path)
    assert read_log(spark, path, since="2000-01-01").count() == 3
    other = str(tmp_path / "other")
    decode(feed_of("{}")).withColumn("date", F.lit(None).cast("string")).write.partitionBy("date").parquet(other)
    assert read_log(spark, other, since="2000-01-01", until="2000-01-02").count() == 1


# The batch job


@pytest.mark.parametrize("keys", ["order_id", "order_id,customer_id"])
def test_bronze(spark, feed_of, scenario, tmp_path, keys):
    log, backups = str(tmp_path / "log"), str(tmp_path / "backup")
    table = StateTable(spark, str(tmp_path / "state"), keys)
    append_log(decode(feed_of(*scenario), clock=F.lit("2024-01-01").cast("date")), log)
    for n in range(3):
        assert run_bronze(spark, log, table, backups, "2024-01-02") == n + 1
        assert rows_of(table) == EXPECTED
    late = [event("c", None, image(3, 3, 3, 3, 300), 11.0), event("d", image(1, 1, 1, 1, 100), None, 20.0)]
    append_log(decode(feed_of(*late), clock=F.lit("2024-01-03").cast("date")), log)
    run_bronze(spark, log, table, since="2024-01-03")
    assert rows_of(table) == EXPECTED[1:]
    run_bronze(spark, log, table)
    assert rows_of(table) == EXPECTED[1:]
    assert spark.read.parquet(f"{backups}/2024-01-02").filter("op <> 'd'").count() == 2


def test_failed_backup_stops_the_job(spark, feed_of, scenario, tmp_path):
    log = str(tmp_path / "log")
    table = StateTable(spark, str(tmp_path / "state"), "order_id")
    append_log(decode(feed_of(*scenario)), log)
    run_bronze(spark, log, table)
    (tmp_path / "file").write_text("in the way")
    with pytest.raises(Exception):
        run_bronze(spark, log, table, str(tmp_path / "file"))
    assert table.version() == 1 and rows_of(table) == EXPECTED


def test_bronze_by_images(spark, feed_of, scenario, tmp_path):
    log = str(tmp_path / "log")
    append_log(decode(feed_of(*scenario)).withColumn("op", F.lit("c")), log)
    literal, derived = (StateTable(spark, str(tmp_path / name), "order_id") for name in ("a", "b"))
    run_bronze(spark, log, literal)
    run_bronze(spark, log, derived, op_from="images")
    assert [r[1] for r in rows_of(literal)] == [1, 2, 3]
    assert [r[1] for r in rows_of(derived)] == [1, 2]


# Bucketed versions


def test_bucketed_state_is_merged_without_moving(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"), "k,m", buckets=6)
    schema = "k int, m string, op string, ts_ms double, note string"
    base = [(i, None if i % 5 == 0 else f"m{i % 3}", "c", 1.0, "old") for i in range(500)] + [(None, None, "c", 1.0, "old")]
    table.replace(spark.createDataFrame(base, schema))
    came = [(i, None if i % 5 == 0 else f"m{i % 3}", "u", 2.0, "new") for i in range(400, 600)]
    came.append((None, None, "d", 2.0, ""))
    table.add_changes(spark.createDataFrame(came, schema), table.next_batch())
    expected = {(k, m): note for k, m, op, ts, note in base + came if op != "d"}
    del expected[None, None]

    def found():
        return {(r.k, r.m): r.note for r in table.read().collect()}

    assert found() == expected and table.read().count() == 600
    text = table.rows()._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.count("FileScan") == 2  # only the changes move, once
    assert "Bucketed: true" in text and "REPARTITION_BY_NUM" in text
    assert table.fold() == 2 and found() == expected
    assert all(name.endswith(",n=6") for name in os.listdir(f"{folder(table)}/base"))
    table.add_changes(spark.createDataFrame(came, schema), 2)
    assert table.fold() == 3 and found() == expected
    newest = max(os.listdir(f"{folder(table)}/base"))
    files = [f for f in os.listdir(f"{folder(table)}/base/{newest}") if f.startswith("part")]
    assert len(files) <= 6  # one of each bucket
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("tidemark")] == []


def test_bucket_count_may_change(spark, tmp_path, feed_of, scenario):
    path = str(tmp_path / "state")
    for batch, buckets in enumerate([None, 3, 5, 5, None]):
        table = StateTable(spark, path, "order_id", buckets=buckets)
        table.add_changes(changes(feed_of, scenario[4 - batch]), batch)
        table.fold()
    assert rows_of(StateTable(spark, path, "order_id")) == EXPECTED


def test_failed_bucketed_write(spark, tmp_path, feed_of, scenario):
    table = StateTable(spark, str(tmp_path / "state"), "order_id", buckets=3)
    table.replace(changes(feed_of, *scenario))
    broken = table.rows().withColumn("op", F.when(F.col("order_id") == 2, F.raise_error(F.lit("lost"))).otherwise("x"))
    for _ in range(2):
        with pytest.raises(PySparkException):
            table.replace(broken.withColumn("op", F.col("op").cast("string")))
        assert table.version() == 1 and rows_of(table) == EXPECTED
    assert table.replace(table.rows()) == 2 and rows_of(table) == EXPECTED


def test_column_added_to_a_bucketed_state(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "it's here"), "order_id", buckets=3)
    old = "order_id int, quantity int, op string, ts_ms double"
    table.replace(spark.createDataFrame([(1, 1, "c", 1.0), (2, 1, "c", 1.0)], old))
    wide = "order_id int, quantity bigint, op string, ts_ms double, note string"
    table.add_changes(spark.createDataFrame([(1, 5 << 40, "u", 2.0, "x")], wide), 1)
    table.fold()
    assert {r.order_id: (r.quantity, r.note) for r in table.read().collect()} == {1: (5 << 40, "x"), 2: (1, None)}
