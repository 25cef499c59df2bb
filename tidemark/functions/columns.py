"""Column functions used by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_text(column: str = "value") -> Column:
    """Message bytes as text; text stays as it is."""
    return F.col(column).cast("string")


def decode_json(column: str | Column, schema: T.StructType | Column) -> Column:
    """Parse JSON text permissively: what does not fit the schema becomes null, the row stays."""
    return F.from_json(column, schema)


def encode_json(*columns: Column) -> Column:
    """JSON object of the columns with nulls written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def ingest_date(clock: str | Column | None = None) -> Column:
    """Day of ``clock`` as yyyy-MM-dd text; the processing day in the session time zone where there is none."""
    today = F.date_format(F.current_timestamp(), "yyyy-MM-dd")
    return today if clock is None else F.coalesce(F.date_format(clock, "yyyy-MM-dd"), today)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def key_columns(keys: str | list[str] | tuple[str, ...]) -> list[str]:
    """Key columns from a list or from comma-separated text, which is taken literally (no trimming)."""
    names = keys.split(",") if isinstance(keys, str) else list(keys)
    if not names or not all(names):
        raise ValueError(f"empty key column in {keys!r}")
    return names
