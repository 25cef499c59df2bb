"""Stream a feed whose schema is found on the way."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import as_text, decode_json, found_schema, ingest_date, plain_schema, wider_schema
from ..sources.files import exists, names, read_text, write_text
from .ingest import check_split
from .trigger import triggered


def run_inferring_ingest(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    clock: str | Column | None = None,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Append the columns of every message to ``path``, with the schema found in the messages so far.

    The type of each micro-batch, one aggregate over it, is merged into that of all before it and noted under the number of
    the micro-batch before its rows are written to ``batch=N/date=...``.  A restart goes on from the notes; a micro-batch
    that is run again finds its own note and writes the same rows under the same name.  ``read_inferred`` reads
    all of them in the widest types.  Messages that are not JSON objects become rows of nulls; a micro-batch
    without any object has the columns of those before it, and is left out where there are none yet.
    """
    spark, path = feed.sparkSession, path.rstrip("/")
    check_split(spark, path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch={batch_id}"
        if exists(spark, f"{target}/_SUCCESS"):
            return
        batch = batch.persist()
        try:
            schema = _schema_for(spark, path, batch, batch_id)
            if schema is not None:
                rows = batch.select(F.inline(F.array(decode_json(as_text(), plain_schema(schema)))), ingest_date(clock).alias("date"))
                rows.write.mode("overwrite").partitionBy("date").parquet(target)
        finally:
            batch.unpersist()

    writer = feed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return triggered(writer, available_now, every).start()


def _schema_for(spark: SparkSession, path: str, batch: DataFrame, batch_id: int) -> T.StructType | None:
    known = noted(spark, path)
    if batch_id in known:
        return known[batch_id]
    found = [known[max(known)]] if known else []
    try:
        found.append(found_schema(batch))
    except ValueError:  # no object
        if not found:
            return None
    schema = reduce(wider_schema, found)
    write_text(spark, f"{path}/_types/{batch_id}.json", schema.json())
    return schema


def noted(spark: SparkSession, path: str) -> dict[int, T.StructType]:
    """The schema of every micro-batch; a note that was never finished counts for nothing."""
    out = {}
    for name in names(spark, f"{path}/_types"):
        if name.endswith(".json"):
            try:
                out[int(name.removesuffix(".json"))] = T.StructType.fromJson(json.loads(read_text(spark, f"{path}/_types/{name}")))
            except ValueError:
                continue
    return out


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """All rows, every column in the widest type it has had, and ``date``; what older micro-batches lack is null.

    Micro-batches of one schema are read together; there are as many groups as there were changes of it.
    """
    path = path.rstrip("/")
    known = {n: schema for n, schema in noted(spark, path).items() if exists(spark, f"{path}/batch={n}/_SUCCESS")}
    if not known:
        raise FileNotFoundError(f"nothing at {path}")
    last, groups = plain_schema(known[max(known)]), {}
    for number, schema in sorted(known.items()):
        schema = plain_schema(schema)
        groups.setdefault(schema.json(), (schema, []))[1].append(f"{path}/batch={number}")
    date = T.StructField("date", T.StringType())
    parts = []
    for schema, paths in groups.values():
        rows = spark.read.schema(T.StructType([*schema.fields, date])).option("basePath", path).parquet(*paths)
        parts.append(rows.select(*[_as(f, schema) for f in last], "date"))
    return reduce(DataFrame.unionByName, parts)


def _as(field: T.StructField, held: T.StructType) -> Column:
    """The column in its last type; numbers and objects that became text are written as JSON."""
    own = next((f.dataType for f in held if f.name == field.name), None)
    if own is None:
        return F.lit(None).cast(field.dataType).alias(field.name)
    return _fitted(F.col(f"`{field.name}`"), own, field.dataType).alias(field.name)


def _fitted(column: Column, own: T.DataType, kind: T.DataType) -> Column:
    if own == kind:
        return column
    if isinstance(own, T.StructType) and isinstance(kind, T.StructType):
        kinds = {f.name: f.dataType for f in own}
        fields = [
            (_fitted(column[f.name], kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name) for f in kind
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.StringType) and isinstance(own, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column)
    return column.cast(kind)
