"""The append-only log of decoded events, partitioned by ingest date."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import log_schema
from .files import exists, folders, read_texts, write_text


def read_log(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    since: str | None = None,
    until: str | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """The log, or the ingest dates from ``since`` to ``until`` (both included), read from those partitions only.

    Rows without a date, which other writers may have left, belong to every range.
    Columns that older files lack read as null.  The default schema is the fixed one; ``merge_schema``
    finds it in the files instead, at the price of opening every one of them.
    """
    reader = spark.read.format(fmt)
    if fmt == "delta":
        log = reader.load(path)
    elif merge_schema:
        log = reader.option("mergeSchema", "true").load(path)
        log = log.withColumn("date", F.col("date").cast("string")) if "date" in log.columns else log
    else:
        schema = schema or log_schema()
        log = reader.schema(schema).load(path)
        if len(log.columns) > len(schema):  # folders of micro-batches
            log = log.select(*[f"`{c}`" for c in schema.names])
    if since is not None:
        log = log.filter((F.col("date") >= since) | F.col("date").isNull())
    if until is not None:
        log = log.filter((F.col("date") <= until) | F.col("date").isNull())
    return log


def stream_log(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet", **options
) -> DataFrame:
    """The log as a stream of the events appended to it."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader if fmt == "delta" else reader.schema(schema or log_schema())).load(path)


def append_log(events: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append decoded events as a batch; a log that a stream writes takes events from that stream only."""
    spark = events.sparkSession
    if fmt == "parquet":
        if exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
            raise ValueError(f"{path} is written by a stream, which would not list files added here")
        check_append(spark, path, events.schema)
    events.write.format(fmt).partitionBy("date").mode("append").option("mergeSchema", "true").save(path)


def check_stream(spark: SparkSession, path: str, checkpoint: str) -> None:
    """ValueError if the log was written under another checkpoint.

    The file sink numbers its commits as the checkpoint does, and takes a number it has seen
    before for a batch already written.
    """
    written = exists(spark, f"{path.rstrip('/')}/_spark_metadata")
    if written and not exists(spark, f"{checkpoint.rstrip('/')}/commits"):
        raise ValueError(f"{path} was written under another checkpoint than {checkpoint}")


def check_append(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """ValueError if ``schema`` gives a column a type that cannot hold what it has anywhere in the log.

    New columns and new struct fields are fine: older rows read null there.  So are wider numbers (INT, then BIGINT, then
    DECIMAL): ``noted_schema`` has the widest type of every column, with which Parquet reads the narrower files exactly.
    Any other change of type is refused, a narrower number too.  Parquet would take
    the conflicting files and fail only on reading.  The columns of the whole log are kept in a
    folder beside its dates, in a small file for each change, so no data is opened.  (A log that
    has no such folder yet is read for its columns once.)
    """
    path = path.rstrip("/")
    notes = _notes(spark, path)
    if not notes and any(name.startswith("date=") for name in folders(spark, path)):
        notes = [spark.read.option("mergeSchema", "true").parquet(path).drop("date").schema]
        _note(spark, path, notes[0])
    given = T.StructType([f for f in schema if f.name != "date"])
    held = reduce(_joined, notes) if notes else T.StructType()
    clash = _conflict(held, given)
    if clash:
        raise ValueError(f"cannot append to {path}: {clash}")
    if _joined(held, given) != held:
        _note(spark, path, given)


def noted_schema(spark: SparkSession, path: str) -> T.StructType:
    """The columns of the whole log in their widest types, and its ``date``, to be given to ``read_log``."""
    notes = _notes(spark, path.rstrip("/"))
    if not notes:
        raise ValueError(f"{path} has no notes of its columns")
    return T.StructType([*reduce(_joined, notes).fields, T.StructField("date", T.StringType())])


def _notes(spark: SparkSession, path: str) -> list[T.StructType]:
    return [T.StructType.fromJson(json.loads(text)) for text in read_texts(spark, f"{path}/_columns")]


def _note(spark: SparkSession, path: str, schema: T.StructType) -> None:
    write_text(spark, f"{path}/_columns/{uuid.uuid4().hex}.json", schema.json())


def _joined(held: T.DataType, given: T.DataType) -> T.DataType:
    """``held`` with the fields that only ``given`` has, and the wider of two numbers."""
    if not (isinstance(held, T.StructType) and isinstance(given, T.StructType)):
        return given if _widens(held, given) else held
    new = {f.name: f.dataType for f in given}
    fields = [T.StructField(f.name, _joined(f.dataType, new.pop(f.name, f.dataType))) for f in held]
    return T.StructType(fields + [T.StructField(name, kind) for name, kind in new.items()])


def _conflict(held: T.DataType, given: T.DataType, at: str = "") -> str | None:
    if isinstance(held, T.StructType) and isinstance(given, T.StructType):
        kinds = {f.name: f.dataType for f in held}
        found = (_conflict(kinds[f.name], f.dataType, f"{at}.{f.name}".lstrip(".")) for f in given if f.name in kinds)
        return next((text for text in found if text), None)
    same = held.simpleString() == given.simpleString()
    return None if same or _widens(held, given) else f"{at} is {held.simpleString()}, not {given.simpleString()}"


def _widens(held: T.DataType, given: T.DataType) -> bool:
    """Whether Parquet files of ``held`` can be read exactly as ``given``, a wider type."""
    whole = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    if isinstance(given, T.DecimalType):
        if isinstance(held, T.DecimalType):
            return held != given and given.scale >= held.scale and given.precision - given.scale >= held.precision - held.scale
        digits = {T.ByteType(): 10, T.ShortType(): 10, T.IntegerType(): 10, T.LongType(): 20}.get(held)
        return digits is not None and given.precision - given.scale >= digits
    if held in whole and given in whole:
        return whole.index(given) > whole.index(held)
    return isinstance(held, T.FloatType) and isinstance(given, T.DoubleType)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """A plain Parquet table, or None if there is none; any other failure is raised.

    ``StateTable.replace`` takes the result over as a first version.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_parquet(df: DataFrame, path: str) -> None:
    """Add the rows to a Parquet folder; a repeated run adds them again."""
    df.write.mode("append").parquet(path)
