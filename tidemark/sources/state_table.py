"""A current-state table on Parquet that is never overwritten in place."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ingest_date, key_columns
from ..operators import fold_changes, latest_per_key, live_rows, merge_state
from . import files


class StateTable:
    """Whole versions of the state, and the change batches that came after the newest version.

    ``base/v=N,...`` holds one row per key with every batch below ``N`` folded in; ``changes/b=N,...``
    holds the newest row per key of batch ``N``.  Deleted rows are kept, so that an event older than
    the delete cannot bring its row back.  Every write takes a folder of its own, which counts only
    with its ``_SUCCESS`` marker: a failed, repeated or simultaneous write leaves what readers see as
    it was.

    With ``buckets`` the versions are written bucketed by the keys: merging batches then shuffles only
    the batches, whatever their size, and the state stays where it is.  This needs a database in
    which tables can be created; they are dropped at once, and the folder is all that stays.

    Without, the state is shuffled once for a merge.

    A version that has been superseded stays for ``retain_hours``, so that whoever reads it can finish.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: str | list[str],
        order_by: str | list[str] = "ts_ms",
        buckets: int | None = None,
        retain_hours: float = 24.0,
    ):
        if retain_hours < 0:
            raise ValueError("retain_hours cannot be negative")
        self.spark = spark
        self.path = files.qualified(spark, path)
        self.keys = key_columns(keys)
        self.order_by = order_by
        self.buckets = buckets
        self.retain_hours = retain_hours
        self._whole: set[str] = set()

    # What is there

    def versions(self) -> list[int]:
        return sorted(self._committed("base"))

    def version(self) -> int | None:
        return max(self._committed("base"), default=None)

    def pending(self) -> list[int]:
        """Batches the newest version does not hold yet."""
        version = self.version() or 0
        return sorted(batch for batch in self._committed("changes") if batch >= version)

    def next_batch(self) -> int:
        return max([self.version() or 0, *[batch + 1 for batch in self.pending()]])

    # Reading

    def read(self) -> DataFrame:
        """Live rows; FileNotFoundError if nothing was written yet."""
        rows = self.rows()
        if rows is None:
            raise FileNotFoundError(f"no state at {self.path}")
        return live_rows(rows).drop("_position")

    def rows(self) -> DataFrame | None:
        """One row per key, deleted ones included; None if nothing was written yet."""
        return self._merged(self.pending())

    def read_version(self, version: int) -> DataFrame:
        """All rows of a version that is still kept, without batches that came later."""
        bases = self._committed("base")
        if version not in bases:
            raise FileNotFoundError(f"no version {version} at {self.path}")
        return self._read(bases[version])

    def _merged(self, pending: list[int], changes: DataFrame | None = None) -> DataFrame | None:
        """The newest version with the batches, and changes that are not stored, folded in."""
        path = self._newest_base()
        base = self._read(path) if path else None
        since = _watermark(path) if path else None
        came = ([self._read_changes(pending)] if pending else []) + ([] if changes is None else [changes])
        if not came:
            return base
        came = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), came)
        if since is not None:
            came = came.filter(self._not_before(since))
        if base is None:
            return latest_per_key(came, self.keys, self.order_by)
        buckets = _buckets(path)
        if buckets is None:
            return fold_changes(base, came, self.keys, self.order_by)
        # Sent to the buckets, ranked there, and merged there.  The changes come first in the union: a table's
        # columns carry its name, which hides from Spark that both sides are partitioned alike.
        came = latest_per_key(came.repartition(buckets, *[f"`{k}`" for k in self.keys]), self.keys, self.order_by)
        merged = merge_state(came, base, self.keys, self.order_by, keep_deletes=True)
        columns = base.columns + [c for c in merged.columns if c not in base.columns]
        return merged.select(*[f"`{c}`" for c in columns])

    # Writing

    def replace(self, rows: DataFrame) -> int:
        """Make ``rows`` (one per key, deletes included) the newest version, in place of all before it.

        On a table fed by a stream, do this while the stream is stopped.
        """
        version = self._next_version()
        # A stream counts batches on its own, so there the same version may get another revision.
        base = self._committed("base").get(version)
        self._write_base(_checked(rows), version, revision=0 if base is None else _revision(base) + 1)
        return version

    def apply(self, changes: DataFrame, forget_before: float | None = None) -> int:
        """Fold changes, any number per key, and what is pending into a new version, in one job."""
        path, version = self._newest_base(), self._next_version()
        in_place = path is not None and _buckets(path) == self.buckets
        self._write_base(self._merged(self.pending(), _checked(changes)), version, in_place, forget_before=forget_before)
        return version

    def _next_version(self) -> int:
        version = self.next_batch()
        return version if self.checkpoint() else max(version, (self.version() or 0) + 1)

    def add_changes(self, newest: DataFrame, batch: int) -> None:
        """Store the newest row per key of a batch; does nothing if that batch is there or folded in already."""
        if batch >= (self.version() or 0) and batch not in self._committed("changes"):
            self._write(_checked(newest).write, f"{self.path}/changes/b={batch},a={_attempt()}")

    def fold(self, forget_before: float | None = None) -> int | None:
        """Write a version that holds all pending batches; returns the newest version.

        With ``forget_before``, a value of the column that orders events, deletes older than it are dropped.  It
        becomes the table's watermark, which never goes back: events older than it that still arrive, or that have no
        time, are passed over from then on, so none of them can bring a forgotten row back.  A stream may feed the
        table meanwhile.
        """
        pending, path = self.pending(), self._newest_base()
        further = forget_before is not None and path is not None and forget_before > (self.watermark() or float("-inf"))
        if pending:
            in_place = path is not None and _buckets(path) == self.buckets
            self._write_base(self._merged(pending), max(pending) + 1, in_place, forget_before=forget_before)
        elif further:
            in_place = _buckets(path) == self.buckets
            self._write_base(self._read(path), self.version(), in_place, _revision(path) + 1, forget_before)
        return self.version()

    def watermark(self) -> float | None:
        """The time before which events are passed over; None while nothing was forgotten."""
        path = self._newest_base()
        return _watermark(path) if path else None

    def _not_before(self, since: float) -> Column:
        """Events as new as the watermark; NaN is newest, and one without a time oldest."""
        first = self.order_by if isinstance(self.order_by, str) else self.order_by[0]
        return F.coalesce(F.col(f"`{first}`") >= since, F.lit(False))

    def backup(self, root: str, day: str | None = None) -> str | None:
        """Copy the state to ``root/day``, by default today in the session time zone.

        A second copy on one day takes the place of the first once it is whole.
        """
        rows = self.rows()
        if rows is None:
            return None
        day = day or self.spark.range(1).select(ingest_date()).first()[0]
        target = files.qualified(self.spark, f"{root.rstrip('/')}/{day}")
        attempt, old = (f"{target}.{name}-{_attempt()}" for name in ("new", "old"))
        try:
            rows.write.parquet(attempt)
        except Exception:
            files.remove(self.spark, attempt)
            raise
        if files.exists(self.spark, target):
            files.rename(self.spark, target, old)
        files.rename(self.spark, attempt, target)
        files.remove(self.spark, old)
        return target

    # Feeding from a stream

    def checkpoint(self) -> tuple[str, int] | None:
        """Checkpoint of the stream that feeds the table, and the batch its first micro-batch became."""
        names = [name for name in files.folders(self.spark, self.path) if name.startswith("checkpoint=")]
        return (f"{self.path}/{names[0]}", int(names[0].removeprefix("checkpoint="))) if names else None

    def open_checkpoint(self) -> tuple[str, int]:
        """The stream's checkpoint; a new one goes on after the batches that are already here."""
        first = self.next_batch()
        return self.checkpoint() or (f"{self.path}/checkpoint={first}", first)

    # Folders

    def _folders(self, kind: str) -> list[tuple[int, str]]:
        """Number and path of every version or batch, whole or not; later revisions first, then by name."""
        root = f"{self.path}/{kind}"
        paths = [f"{root}/{name}" for name in sorted(files.folders(self.spark, root))]
        paths.sort(key=_revision, reverse=True)
        return [(int(path.rsplit("/", 1)[1].split(",")[0].split("=")[1]), path) for path in paths]

    def _committed(self, kind: str) -> dict[int, str]:
        """Path of each number; of several written whole, the last revision, whose copies are equal."""
        found: dict[int, str] = {}
        for number, path in self._folders(kind):
            if number not in found and self._is_whole(path):
                found[number] = path
        return found

    def _is_whole(self, path: str) -> bool:
        """Whether the folder is committed; asked of the file system until it is."""
        if path not in self._whole and files.exists(self.spark, f"{path}/_SUCCESS"):
            self._whole.add(path)
        return path in self._whole

    def _newest_base(self) -> str | None:
        bases = self._committed("base")
        return bases[max(bases)] if bases else None

    def _read(self, path: str) -> DataFrame:
        buckets = _buckets(path)
        if buckets is None:
            return self.spark.read.parquet(path)
        if files.exists(self.spark, f"{path}/_columns.json"):
            schema = T.StructType.fromJson(json.loads(files.read_text(self.spark, f"{path}/_columns.json")))
        else:
            schema = self.spark.read.parquet(path).schema
        keys = ", ".join(f"`{k}`" for k in self.keys)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        with self._table_name() as name:
            self.spark.sql(
                f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet"
                f" CLUSTERED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{place}'"
            )
            return self.spark.table(name)

    def _read_changes(self, batches: list[int]) -> DataFrame:
        """Rows of the batches, which may differ in columns after the source table changed."""
        changes = self._committed("changes")
        paths = [changes[batch] for batch in batches]
        try:
            return self.spark.read.option("mergeSchema", "true").parquet(*paths)
        except Exception as error:  # a bare Java error, without a condition to ask for
            if "CANNOT_MERGE_SCHEMAS" not in str(error):
                raise
        # A column changed its type: widen it, batch by batch.
        one_by_one = [self.spark.read.parquet(path) for path in paths]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_by_one)

    def _write_base(
        self, rows: DataFrame, version: int, in_place: bool = False, revision: int = 0, forget_before: float | None = None
    ) -> None:
        """Write a version; ``in_place`` says that each task already holds rows of one bucket."""
        path = f"{self.path}/base/v={version},r={revision},a={_attempt()}"
        marks = [m for m in (self.watermark(), forget_before) if m is not None]
        if marks:
            since = float(max(marks))
            rows = rows.filter(~F.col("op").eqNullSafe("d") | self._not_before(since))
            path += f",w={since!r}"
        if self.buckets is None:
            self._write(rows.write, path)
        else:
            if not in_place:
                rows = rows.repartition(self.buckets, *[f"`{k}`" for k in self.keys])
            bucketed = rows.write.bucketBy(self.buckets, self.keys)
            path += f",n={self.buckets}"
            self._write(bucketed, path, as_table=True)
            # buckets without rows have no file that tells the columns
            files.write_text(self.spark, f"{path}/_columns.json", rows.schema.json())
        self._clean_up()

    def _write(self, writer: DataFrameWriter, path: str, as_table: bool = False) -> None:
        writer = writer.format("parquet")
        if as_table:
            with self._table_name() as name:
                writer.option("path", path).saveAsTable(name)
        else:
            writer.save(path)
        if not self._is_whole(path):
            raise OSError(f"{path} has no _SUCCESS marker; leave mapreduce.fileoutputcommitter.marksuccessfuljobs on")

    @contextmanager
    def _table_name(self) -> Iterator[str]:
        """Name for a table over a folder; the entry goes at the end of the block, the folder stays."""
        name = f"tidemark_{uuid.uuid4().hex}"
        try:
            yield name
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def vacuum(self, retain_hours: float | None = None) -> None:
        """Remove versions superseded longer ago than ``retain_hours``, and the batches folded into them."""
        hours = self.retain_hours if retain_hours is None else retain_hours
        since = time.time() * 1000 - hours * 3_600_000
        bases = sorted(self._committed("base").items())
        kept = [
            number
            for (number, _), (_, newer) in zip(bases, bases[1:])
            if files.modified(self.spark, f"{newer}/_SUCCESS") > since
        ]
        oldest = min(kept + [number for number, _ in bases[-1:]], default=0)
        for kind in ("base", "changes"):
            for number, path in self._folders(kind):
                if number < oldest:
                    files.remove(self.spark, path)

    def _clean_up(self) -> None:
        self.vacuum()


def _checked(rows: DataFrame) -> DataFrame:
    """The rows; ValueError if they have a column of their own by the name the log position is stored under."""
    kinds = {f.name.lower(): f.dataType for f in rows.schema}
    kind = kinds.get("_position")
    if kind is not None and not (isinstance(kind, T.StructType) and {"ts_ms", "file", "pos"} <= set(kind.names)):
        raise ValueError("a state table keeps the log position in _position; rename the column of that name")
    return rows


def _attempt() -> str:
    return uuid.uuid4().hex[:12]


def _revision(path: str) -> int:
    """Revision of a version, from the name of its folder; 0 for a batch."""
    found = re.search(r",r=(\d+),", path.rsplit("/", 1)[-1])
    return int(found[1]) if found else 0


def _watermark(path: str) -> float | None:
    """Watermark of a version, from the name of its folder."""
    found = re.search(r",w=([^,]+)", path.rsplit("/", 1)[-1])
    return float(found[1]) if found else None


def _buckets(path: str) -> int | None:
    """Number of buckets of a version, from the name of its folder."""
    name = path.rsplit("/", 1)[-1]
    return int(name.split(",n=")[1]) if ",n=" in name else None
