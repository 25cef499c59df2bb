"""Helpers of the operators: stored tables, free column names, joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import remove, shared_folder

#: At most so many groups hold more than this share of the rows each, so they may be broadcast.
HOT_GROUPS = 1000
#: A group of at most so many rows is no burden for a task.
HOT_ROWS = 1000
#: Files of a stored table for each core of the cluster, at most, while the table is small; many small ones cost more than they help.
FILES_PER_CORE = 4
#: Bytes of a table, by Spark's estimate, for each file beyond that.
FILE_BYTES = 128 << 20
#: Spark's own sizes of a batch for Python, and the ones set in their place: whole texts are large rows.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m"),
}
#: Folders of the tables stored by this process that may still be there.
_MADE: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Bound what the JVM and a Python worker hold of a table of texts at once, unless the session has its own sizes."""
    for name, (own, shorter) in BATCHES.items():
        if spark.conf.get(name, own) == own:
            spark.conf.set(name, shorter)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the folder all executors share and read from there.

    Later jobs read the files, so neither a lost executor nor a second use runs the plan above again.
    """
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stored``, with the folder, for tables that are dropped before the query ends."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    _MADE.append(path)
    df = df.coalesce(max(FILES_PER_CORE * spark.sparkContext.defaultParallelism, estimated_bytes(df) // FILE_BYTES))
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored_alone(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` gives, stored; the tables that it stored on the way are removed then."""
    before = len(_MADE)
    df = make()
    out, path = stored_at(df, name)
    drop(df.sparkSession, *(other for other in _MADE[before:] if other != path))
    _MADE[before:] = [path]
    return out


def estimated_bytes(df: DataFrame) -> int:
    """What Spark expects the rows to take, cut at what a number of files can be."""
    return min(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())), FILE_BYTES << 24)


def drop(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        remove(spark, path)


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """A column by its plain name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_group(rows: DataFrame, groups: DataFrame, key: list[str], size: str) -> DataFrame:
    """Each row with the columns of its group; rows without a group go.

    ``groups`` has one row per key and in ``size`` the number of its rows.  Groups above a
    thousandth of all rows are fewer than a thousand, whatever the input; they are broadcast, so
    that no task gets all rows of one.  The others, and all where the largest has no more than a thousand rows, are
    joined by key.
    """
    total, most = groups.agg(F.sum(size), F.max(size)).first()
    least = max((total or 0) / HOT_GROUPS, HOT_ROWS)
    if (most or 0) <= least:
        return rows.join(groups, key)
    hot = quoted(size) > least
    often, seldom = F.broadcast(groups.filter(hot)), groups.filter(~hot)
    return rows.join(often, key).unionByName(rows.join(often, key, "left_anti").join(seldom, key))
