"""The row each change event stands for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SOURCE


def log_position(source: T.StructType = SOURCE) -> Column:
    """Place of the event in the source's log.

    Files are numbered at the end of their names, and ``pos`` and ``row`` come as text; all three must compare as
    numbers.  Rows of one log event share ``pos`` and are told apart by ``row``, if the source has it.
    """
    file = F.col("source.file")
    series = F.rtrim(file, F.lit("0123456789"))
    parts = [
        F.col("source.ts_ms").alias("ts_ms"),
        series.alias("series"),
        F.substring(file, F.length(series) + 1, F.length(file)).try_cast("bigint").alias("number"),
        file.alias("file"),
        F.col("source.pos").try_cast("bigint").alias("pos"),
    ]
    row = F.col("source.row") if "row" in source.names else F.lit(None).cast("string")
    return F.struct(*parts, row.try_cast("bigint").alias("row"))


def has_position(log: DataFrame) -> bool:
    """Whether the log carries what ``log_position`` reads."""
    kind = next((f.dataType for f in log.schema if f.name == "source"), None)
    return isinstance(kind, T.StructType) and {"ts_ms", "file", "pos"} <= set(kind.names)


def row_images(log: DataFrame, op_from: str = "op", position: bool = False) -> DataFrame:
    """``after`` where present, else ``before``, with ``op`` and ``ts_ms``; events with neither drop out.

    One scan of the log.  The choice is made field by field, so a caller that needs few fields
    reads only those from storage.  ``op_from="images"`` derives c, u and d from which images are
    there, for producers whose ``op`` cannot be trusted.  ``position`` adds ``_position``, by which
    events of the same ``ts_ms`` are told apart.
    """
    new, old = F.col("after"), F.col("before")
    names = log.schema["after"].dataType.names
    fields = [F.when(new.isNotNull(), new[name]).otherwise(old[name]).alias(name) for name in names]
    if op_from == "images":
        op = F.when(new.isNull(), "d").when(old.isNull(), "c").otherwise("u").alias("op")
    elif op_from == "op":
        op = F.col("op")
    else:
        raise ValueError(f"op_from is 'op' or 'images', not {op_from!r}")
    if position and "_position" in [name.lower() for name in names]:
        raise ValueError("a table with a column _position cannot be ranked by position; rename the column")
    extra = [log_position(log.schema["source"].dataType).alias("_position")] if position else []
    return log.filter(new.isNotNull() | old.isNotNull()).select(*fields, op, "ts_ms", *extra)
