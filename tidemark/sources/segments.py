"""A feed in numbered segments that expire, as a streaming source with offsets."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..schemas import feed_schema
from . import files

_PREFIX = "segment="
#: Batches that Spark may have run without having told the source that they are done.
_UNTOLD = 2


def append_segment(feed: DataFrame, path: str) -> int:
    """Add the messages as the next segment, which readers see whole or not at all; returns its number."""
    spark = feed.sparkSession
    path = files.qualified(spark, path)
    number = max(_numbers(files.folders(spark, path)), default=-1) + 1
    written = f"{path}/_new-{uuid.uuid4().hex}"
    feed.select(*[f.name for f in feed_schema()]).write.parquet(written)
    target = f"{path}/{_PREFIX}{number:012d}"
    if files.exists(spark, target):
        files.remove(spark, written)
        raise RuntimeError(f"another writer added {target}")
    files.rename(spark, written, target)
    return number


def expire_segments(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Remove all segments but the newest ``keep``, at least one; returns the numbers that went."""
    path = files.qualified(spark, path)
    gone = _numbers(files.folders(spark, path))[: -max(keep, 1)]
    for number in gone:
        files.remove(spark, f"{path}/{_PREFIX}{number:012d}")
    return gone


def _numbers(names: list[str]) -> list[int]:
    return sorted(int(name.removeprefix(_PREFIX)) for name in names if name.startswith(_PREFIX))


class SegmentFeed(DataSource):
    """``spark.readStream.format("segments")`` over a folder that ``append_segment`` fills.

    Options: ``path``; ``startingOffsets``, ``earliest`` (the default) or ``latest``, for a stream without a checkpoint;
    ``failOnDataLoss``, whether a stream that finds segments gone which it has not read fails (the default) or goes
    on behind them; ``maxSegmentsPerTrigger``, the segments of a micro-batch at most, which needs ``progress``, a folder
    where the source notes how far it came.  Spark does not tell a source of this kind where it stands after a
    restart, so the first micro-batch may then hold up to three times as many.
    """

    @classmethod
    def name(cls) -> str:
        return "segments"

    def schema(self) -> T.StructType:
        return feed_schema()

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return SegmentReader(self.options, schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:  # noqa: N802
        return SegmentStream(self.options, schema)


class _Folder:
    """A folder by its URI, for driver and executors alike."""

    def __init__(self, uri: str):
        from pyarrow import fs

        if uri.startswith("file:"):
            uri = "/" + uri.removeprefix("file:").lstrip("/")
        self.fs, self.path = fs.FileSystem.from_uri(uri)

    def names(self, under: str = "", files: bool = False) -> list[str]:
        from pyarrow import fs

        kind = fs.FileType.File if files else fs.FileType.Directory
        found = self.fs.get_file_info(fs.FileSelector(f"{self.path}/{under}".rstrip("/"), allow_not_found=True))
        return sorted(x.base_name for x in found if x.type == kind)


class _File(InputPartition):
    def __init__(self, segment: int, name: str):
        self.segment, self.name = segment, name


class _Reading:
    """What batch and stream have in common."""

    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.uri, self.columns = options["path"].rstrip("/"), schema.names
        self.fail = options.get("failOnDataLoss", "true").lower() == "true"

    def segments(self) -> list[int]:
        return _numbers(_Folder(self.uri).names())

    def files_of(self, segments: list[int]) -> list[_File]:
        folder = _Folder(self.uri)
        return [
            _File(n, name) for n in segments for name in folder.names(f"{_PREFIX}{n:012d}", files=True) if name.endswith(".parquet")
        ]

    def read(self, partition: _File) -> Iterator:
        """Batches of one file; a file that expired meanwhile is lost data too."""
        import pyarrow.parquet as pq

        folder = _Folder(self.uri)
        try:
            source = folder.fs.open_input_file(f"{folder.path}/{_PREFIX}{partition.segment:012d}/{partition.name}")
        except FileNotFoundError:
            if self.fail:
                raise
            return
        with source:
            yield from pq.ParquetFile(source).iter_batches(batch_size=4096, columns=self.columns)


class SegmentReader(_Reading, DataSourceReader):
    def partitions(self) -> list[_File]:
        return self.files_of(self.segments())


class SegmentStream(_Reading, DataSourceStreamReader):
    """Offsets are the number of the next segment to read."""

    def __init__(self, options: dict[str, str], schema: T.StructType):
        super().__init__(options, schema)
        self.latest_first = options.get("startingOffsets", "earliest") == "latest"
        self.limit = int(options.get("maxSegmentsPerTrigger", 0))
        self.progress = options.get("progress")
        if self.limit and not self.progress:
            raise ValueError("maxSegmentsPerTrigger needs a progress folder")
        self.next: int | None = None

    def initialOffset(self) -> dict:  # noqa: N802
        first = self._first(self.segments())
        self.next = first if self.next is None else self.next  # Spark may have asked for the latest before
        return {"next": first}

    def _first(self, there: list[int]) -> int:
        return 0 if not there else there[-1] + 1 if self.latest_first else there[0]

    def latestOffset(self) -> dict:  # noqa: N802
        there = self.segments()
        end = there[-1] + 1 if there else self.next or 0
        if self.limit and there:
            begin, limit = self.next, self.limit
            if begin is None:
                noted = self._noted()
                begin, limit = (self._first(there), limit) if noted is None else (noted, limit * (1 + _UNTOLD))
            # segments that are gone count for nothing
            end = min(end, max(begin, there[0]) + limit)
        self.next = max(end, self.next or 0)
        return {"next": self.next}

    def partitions(self, start: dict, end: dict) -> list[_File]:
        there = self.segments()
        wanted = range(start["next"], end["next"])
        lost = sorted(set(wanted) - set(there))
        if lost and self.fail:
            raise RuntimeError(
                f"segments {lost[0]} to {lost[-1]} of {self.uri} expired before they were read; failOnDataLoss=false goes on behind them"
            )
        return self.files_of([n for n in wanted if n in set(there)])

    def commit(self, end: dict) -> None:
        if self.progress:
            folder = _Folder(self.progress)
            folder.fs.create_dir(folder.path, recursive=True)
            with folder.fs.open_output_stream(f"{folder.path}/{end['next']:012d}") as out:
                out.write(b"")
            for name in folder.names(files=True):
                if name.isdigit() and int(name) < end["next"]:
                    folder.fs.delete_file(f"{folder.path}/{name}")

    def _noted(self) -> int | None:
        """How far the source came before, at least; None if it never ran."""
        return max((int(name) for name in _Folder(self.progress).names(files=True) if name.isdigit()), default=None)


def stream_segments(
    spark: SparkSession, path: str, fail_on_data_loss: bool = False, max_segments: int | None = None, progress: str | None = None, **options
) -> DataFrame:
    """The feed in segments as a stream; as with Kafka, expired segments are passed over unless ``fail_on_data_loss``."""
    spark.dataSource.register(SegmentFeed)
    given = {"path": files.qualified(spark, path), "failOnDataLoss": str(fail_on_data_loss).lower(), **options}
    if max_segments:
        given |= {"maxSegmentsPerTrigger": str(max_segments), "progress": files.qualified(spark, progress)}
    return spark.readStream.format("segments").options(**given).load()


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """All segments that are there, as a bounded DataFrame."""
    spark.dataSource.register(SegmentFeed)
    return spark.read.format("segments").options(path=files.qualified(spark, path), failOnDataLoss="false").load()
