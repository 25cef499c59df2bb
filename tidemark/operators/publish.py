"""Publish rows of a table as change messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import encode_json, key_columns
from ..schemas import SOURCE


def source_struct(**given: Column | str | int | float | None) -> Column:
    """Source metadata of an event, null where nothing is given; fields in the order of the schema."""
    unknown = set(given) - set(SOURCE.names)
    if unknown:
        raise ValueError(f"no such source field: {sorted(unknown)}")
    fields = []
    for field in SOURCE:
        value = given.get(field.name)
        if value is None:
            value = F.lit(None).cast(field.dataType)
        fields.append((value if isinstance(value, Column) else F.lit(value)).alias(field.name))
    return F.struct(*fields)


def to_change_feed(
    rows: DataFrame,
    keys: str | list[str],
    op: str | Column,
    ts_ms: str | Column,
    before: str | Column | None = None,
    after: str | Column | None = None,
    source: Column | None = None,
    transaction: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One ``key``/``value`` JSON message per row of ``rows``, plus the columns named in ``keep``.

    ``before`` and ``after`` are struct columns; with neither, all columns of ``rows`` are the new
    image, or the old one where ``op`` is ``"d"``.  The key is taken from whichever image is there.
    A null ``op`` makes a tombstone: the key without a value.  Without ``source`` its metadata is null.
    """
    if before is None and after is None:
        image = F.struct(*[f"`{c}`" for c in rows.columns])
        before, after = (image, None) if isinstance(op, str) and op == "d" else (None, image)
    before, after = _column(before), _column(after)
    image = before if after is None else after if before is None else F.coalesce(after, before)
    if after is None:
        after = F.lit(None).cast("string")
    if before is None:
        before = F.lit(None).cast("string")
    op = F.lit(op) if isinstance(op, str) else op
    value = encode_json(
        before.alias("before"),
        after.alias("after"),
        (F.lit(None).cast(SOURCE) if source is None else source).alias("source"),
        op.alias("op"),
        _column(ts_ms).alias("ts_ms"),
        (F.lit(None).cast("string") if transaction is None else transaction).alias("transaction"),
    )
    key = encode_json(*[image[k].alias(k) for k in key_columns(keys)])
    return rows.select(key.alias("key"), F.when(op.isNotNull(), value).alias("value"), *keep)


def _column(column: str | Column | None) -> Column | None:
    return F.col(column) if isinstance(column, str) else column
