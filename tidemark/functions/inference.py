"""Envelope schemas found from the messages themselves."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import as_text

#: Integers beyond BIGINT; JSON numbers of more digits than this are read as DOUBLE.
WIDE = T.DecimalType(38, 0)


def first_message_schema(feed: DataFrame) -> Column:
    """Schema expression of one sample message.

    Fields the sample lacks are lost and images that are null in it become text, so this suits
    feeds whose first message is complete; ``infer_schema`` has neither limit.
    """
    sample = feed.select(as_text().alias("value")).first()
    if sample is None or sample.value is None:
        raise ValueError("no sample message to infer a schema from")
    return F.schema_of_json(F.lit(sample.value))


def infer_schema(feed: DataFrame, images: tuple[str, str] = ("after", "before")) -> T.StructType:
    """Schema that fits every message of the feed, in one map-side combined aggregate.

    Only the merged type reaches the driver; it grows with the number of different field names, so
    objects whose names are data should be given a schema with a MAP or STRING instead.  Messages that
    are not JSON objects are passed over.  Integers become BIGINT, or DECIMAL(38,0) where one is too wide
    for that, other numbers DOUBLE, fields that are null everywhere or change type STRING.  The two images
    describe the same table, so they get the same fields.
    """
    return plain_schema(found_schema(feed, images))


def found_schema(feed: DataFrame, images: tuple[str, str] = ("after", "before")) -> T.StructType:
    """The types of ``infer_schema`` before columns are made of them, which those of more messages can be merged into."""
    text = as_text()
    objects = feed.filter(F.ltrim(text, F.lit(" \t\r\n")).startswith("{"))
    with _repeated_names(feed.sparkSession):
        found = objects.select(F.schema_of_variant_agg(F.try_parse_json(text)).alias("kind")).first().kind
    if not found.startswith("OBJECT<"):
        raise ValueError("no JSON object to infer a schema from")
    return _alike(T.DataType.fromDDL(_as_struct(found)), images)


@contextmanager
def _repeated_names(spark: SparkSession) -> Iterator[None]:
    """Objects that repeat a field name are read, as ``from_json`` does, within the block."""
    name = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def wider_schema(one: T.StructType, other: T.StructType, images: tuple[str, str] = ("after", "before")) -> T.StructType:
    """Types of the messages of two feeds together, each as ``found_schema`` gives it."""
    return _alike(_wider(one, other), images)


def _alike(kind: T.StructType, images: tuple[str, str]) -> T.StructType:
    """Fields by name, both images with the same ones."""
    kinds = {f.name: f.dataType for f in kind}
    shapes = [kinds[name] for name in images if isinstance(kinds.get(name), T.StructType)]
    if shapes:
        kinds.update(dict.fromkeys(images, reduce(_wider, shapes)))
    return T.StructType([T.StructField(name, kinds[name]) for name in sorted(kinds)])


def plain_schema(kind: T.StructType) -> T.StructType:
    """The types that columns get: STRING where nothing but null was found, and one kind of wide integer."""
    return _plain(kind)


def _as_struct(kind: str) -> str:
    """The type with OBJECT as STRUCT, but for field names, which stand in backquotes where they hold such text."""
    return re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], kind)


def _wider(one: T.DataType, other: T.DataType) -> T.DataType:
    """Type that holds both."""
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        kinds = {f.name: f.dataType for f in one}
        for f in other:
            kinds[f.name] = _wider(kinds.get(f.name, T.NullType()), f.dataType)
        return T.StructType([T.StructField(name, kinds[name]) for name in sorted(kinds)])
    if _whole(one) and _whole(other):
        return WIDE
    if isinstance(one, T.NumericType) and isinstance(other, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def _whole(kind: T.DataType) -> bool:
    return isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale == 0


def _plain(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, T.DecimalType) and kind.scale == 0:
        return WIDE
    if isinstance(kind, (T.DecimalType, T.FloatType)):
        return T.DoubleType()
    if isinstance(kind, (T.NullType, T.VariantType)):
        return T.StringType()
    return kind
