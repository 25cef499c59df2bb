"""The events of single keys, found without reading the whole log."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import key_columns


def write_history(
    log: DataFrame, path: str, keys: str | list[str], group_bytes: int = 32 << 20, distinct_keys: int = 1_000_000, mode: str = "append"
) -> None:
    """Write the log's events that have an image with their key in front, partitioned by date and sorted by key within.

    Rows are dealt by ranges of date and key, so a key of one date is in few neighbouring files whatever its share
    of the rows.  Row groups of ``group_bytes`` have Parquet Bloom filters on the key columns, made for up to
    ``distinct_keys`` values.  A log's new dates are appended; ``read_history`` then opens few row groups.
    """
    keys = key_columns(keys)
    clash = [k for k in keys if k in log.columns]
    if clash:
        raise ValueError(f"the log has columns {clash} beside its images")
    image = [F.coalesce(F.col("after")[k], F.col("before")[k]).alias(k) for k in keys]
    events = log.filter(F.col("after").isNotNull() | F.col("before").isNotNull()).select(*image, *[f"`{c}`" for c in log.columns])
    options = {"parquet.block.size": group_bytes}
    for k in keys:
        options |= {f"parquet.bloom.filter.enabled#{k}": "true", f"parquet.bloom.filter.expected.ndv#{k}": distinct_keys}
    order = ["date", *[f"`{k}`" for k in keys]]
    # ties on the key are dealt to several files where one key has very many events
    ordered = events.repartitionByRange(*order, "ts_ms").sortWithinPartitions(*order, "ts_ms")
    ordered.write.mode(mode).options(**options).partitionBy("date").parquet(path)


def read_history(spark: SparkSession, path: str, wanted: list[dict], since: str | None = None, until: str | None = None) -> DataFrame:
    """The events of the keys in ``wanted``, a short list of dicts of key columns, from the dates given.

    The keys go to Parquet as filters: row groups whose least and greatest key, or whose Bloom filter, leave them out
    are not read.  A null stands for a key without a value.
    """
    rows = spark.read.parquet(path)
    rows = rows.withColumn("date", F.col("date").cast("string"))
    if since is not None:
        rows = rows.filter(F.col("date") >= since)
    if until is not None:
        rows = rows.filter(F.col("date") <= until)
    if not wanted:
        return rows.limit(0)
    each = [reduce(and_, [F.col(f"`{k}`").isNull() if v is None else F.col(f"`{k}`") == v for k, v in one.items()]) for one in wanted]
    # column by column too, which is what Bloom filters can answer
    found = rows.filter(reduce(or_, each))
    for k in wanted[0]:
        values = {one[k] for one in wanted}
        if None not in values:
            found = found.filter(F.col(f"`{k}`").isin(*values))
    return found
