"""A current-state table in hash partitions, of which a merge rewrites only those that have changes."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import free_name, key_columns
from ..operators import latest_per_key, live_rows, merge_state
from . import files


class PartitionedState:
    """One row per key, deleted ones included, in ``parts`` folders by a hash of the key.

    A merge ranks the changes, finds the parts they fall into, reads these parts alone, and writes them anew under a folder of
    its own (``data/w=...``).  A version is a small file that names for each part the write it is in, so a
    version consists of folders of several writes, and parts without changes are neither read nor copied.  Versions
    are numbered; two merges at once cannot both make the same one, and the second fails without a trace.

    ``parts`` is fixed when the table is made; about 1 GB of Parquet in each suits.  Superseded versions are
    kept for ``retain_hours``, so that whoever reads one can finish, and so that one can serve as a backup or be
    compared with the newest (``read_version``).
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: str | list[str],
        order_by: str | list[str] = "ts_ms",
        parts: int = 64,
        retain_hours: float = 24.0,
    ):
        if parts < 1 or retain_hours < 0:
            raise ValueError("parts must be 1 at least, retain_hours not negative")
        self.spark = spark
        self.path = files.qualified(spark, path)
        self.keys = key_columns(keys)
        self.order_by = order_by
        self.retain_hours = retain_hours
        made = self._committed()
        self.parts = made[max(made)]["parts"] if made else parts

    # Reading

    def versions(self) -> list[int]:
        return sorted(self._committed())

    def version(self) -> int | None:
        return max(self._committed(), default=None)

    def read(self) -> DataFrame:
        """Live rows; FileNotFoundError if nothing was written yet."""
        rows = self.rows()
        if rows is None:
            raise FileNotFoundError(f"no state at {self.path}")
        return live_rows(rows).drop("_position")

    def rows(self) -> DataFrame | None:
        """One row per key, deleted ones included; None if nothing was written yet."""
        newest = self.version()
        return None if newest is None else self.read_version(newest)

    def read_version(self, version: int) -> DataFrame:
        """All rows as of a version that is still kept."""
        made = self._committed()
        if version not in made:
            raise FileNotFoundError(f"no version {version} at {self.path}")
        return self._read(made[version], made[version]["writes"])

    # Writing

    def merge(self, changes: DataFrame) -> list[int]:
        """Fold changes, any number per key, into a new version; returns the parts that were rewritten.

        The changes are ranked once and stored, as both the list of parts and the merge need them.  Of the state only
        the parts in that list are shuffled, by part, and each is written by one task.
        """
        made = self._committed()
        newest = max(made, default=None)
        last = made[newest] if made else {"writes": {}}
        before = last["writes"]
        part, folder = free_name(changes, "_part"), "part"
        if folder in (c.lower() for c in changes.columns):
            raise ValueError("a partitioned state has its parts in a column part; rename the column of that name")
        write = uuid.uuid4().hex
        staged, target = f"{self.path}/staged/{write}", f"{self.path}/data/w={write}"
        try:
            latest_per_key(changes, self.keys, self.order_by).withColumn(part, self._part()).write.parquet(staged)
            came = self.spark.read.parquet(staged)
            touched = sorted(r[0] for r in came.select(part).distinct().collect())  # at most ``parts``
            if not touched:
                return []
            old = {str(k): before[str(k)] for k in touched if str(k) in before}
            came = came.repartition(part)
            if old:
                held = self._read(last, old).withColumn(part, self._part()).repartition(part)
                came = merge_state(held, came, [part, *self.keys], self.order_by, keep_deletes=True)
            elif before:  # the columns of the parts that stay
                came = came.unionByName(self._read(last, before).limit(0), allowMissingColumns=True)
            came.withColumnRenamed(part, folder).write.partitionBy(folder).parquet(target)
            self._commit(newest, came.drop(part).schema, before | {str(k): write for k in touched})
        except Exception:
            files.remove(self.spark, target)
            raise
        finally:
            files.remove(self.spark, staged)
        self.vacuum()
        return touched

    def vacuum(self, retain_hours: float | None = None) -> None:
        """Remove versions superseded longer ago than ``retain_hours``, and the parts that no other version names."""
        hours = self.retain_hours if retain_hours is None else retain_hours
        known = self._committed()
        numbers = sorted(known)
        gone = [v for v, newer in zip(numbers, numbers[1:]) if known[newer]["at"] < time.time() - hours * 3600]
        if not gone:
            return
        kept = {item for v in numbers if v not in gone for item in known[v]["writes"].items()}
        for item in {item for v in gone for item in known[v]["writes"].items()} - kept:
            files.remove(self.spark, f"{self.path}/data/w={item[1]}/part={item[0]}")
        for v in gone:
            files.remove(self.spark, f"{self.path}/versions/v={v}.json")

    # Folders

    def _part(self) -> Column:
        """The part of a row; keys hash by their text, so that a widened type changes nothing."""
        hashed = F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in self.keys])
        return F.pmod(hashed, F.lit(self.parts)).cast("int")

    def _numbers(self) -> list[int]:
        """Numbers of all versions, those too whose file was never finished."""
        return sorted(int(name[2:-5]) for name in files.names(self.spark, f"{self.path}/versions") if name.endswith(".json"))

    def _committed(self) -> dict[int, dict]:
        """Versions by number; a file that its writer did not finish counts for nothing."""
        found = {}
        for number in self._numbers():
            try:
                found[number] = json.loads(files.read_text(self.spark, f"{self.path}/versions/v={number}.json"))
            except ValueError:
                continue
        return found

    def _commit(self, newest: int | None, schema: T.StructType, writes: dict[str, str]) -> None:
        """Make a version that follows ``newest``; of several at once one can create the file."""
        number = max(self._numbers(), default=-1) + 1
        if self.version() != newest:
            raise RuntimeError(f"another merge made a version of {self.path} meanwhile")
        found = {"parts": self.parts, "schema": schema.jsonValue(), "writes": writes, "at": time.time()}
        files.write_text(self.spark, f"{self.path}/versions/v={number}.json", json.dumps(found))

    def _read(self, version: dict, writes: dict) -> DataFrame:
        """The rows of some parts; columns that older parts lack are null there, and narrower ones are widened."""
        paths = [f"{self.path}/data/w={write}/part={part}" for part, write in writes.items()]
        schema = T.StructType.fromJson(version["schema"])
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)
