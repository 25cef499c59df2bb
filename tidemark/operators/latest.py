"""Newest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import free_name, key_columns


def precedence(schema: T.StructType, keys: list[str], order_by: str | list[str]) -> list[Column]:
    """What decides which row of a key wins, most significant first.

    ``order_by`` leads, then the log position, then whether the row is a delete, then everything else
    that can be compared, by name.  That makes the order total: which of several copies or ties wins
    depends neither on how rows were split over tasks, files or batches nor on the order of columns.
    """
    first = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = sorted(f.name for f in schema if f.name not in first and f.name not in keys and comparable(f.dataType))
    columns = {name: F.col(f"`{name}`") for name in first + rest}
    position = [columns.pop(name) for name in ("_position",) if name in rest]
    deletes = [columns["op"].eqNullSafe("d")] if "op" in rest and schema["op"].dataType == T.StringType() else []
    return [columns.pop(name) for name in first] + position + deletes + list(columns.values())


def latest_per_key(df: DataFrame, keys: str | list[str], order_by: str | list[str] = "ts_ms") -> DataFrame:
    """The row with the greatest ``order_by`` for each key; nulls lose, null keys are a key of their own.

    Spark ranks within each map task first and ships only that task's winners, so a key that owns
    a large part of the rows costs its reducer one row per map task.
    """
    keys = key_columns(keys)
    newest_first = [c.desc_nulls_last() for c in precedence(df.schema, keys, order_by)]
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*newest_first)
    rank = free_name(df, "_rank")
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def comparable(kind: T.DataType) -> bool:
    """Whether values of the type have an order."""
    if isinstance(kind, T.StructType):
        return all(comparable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return comparable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))
